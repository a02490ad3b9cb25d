"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.clustering import DistributedLDAModel
from pyspark.ml.feature import Word2VecModel


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def _load(cls, what: str, path: str):
    try:
        return cls.load(path)
    except AnalysisException as e:
        raise FileNotFoundError(f"no {what} model at {path}") from e


def load_word2vec(path: str) -> Word2VecModel:
    return _load(Word2VecModel, "Word2Vec", path)


def load_lda(path: str) -> DistributedLDAModel:
    return _load(DistributedLDAModel, "LDA", path)
