"""TF-IDF vectors made where the sentences lie."""

import pytest
from pyspark.sql import functions as F

from quillon.operators import joins, segment, tfidf

KEYS = tfidf.SENTENCE


def _rows(vectors):
    flat = vectors.select(*KEYS, F.transform("vector", lambda c: F.concat(c["lemma"], F.lit(":"), F.round(c["tfidf"], 9))).alias("v"))
    return sorted((r["doc_id"], r["sent_no"], tuple(r["v"])) for r in flat.collect())


@pytest.fixture(scope="module")
def sentences(spark, corpus):
    odd = [(4, ""), (5, None), (6, "index list. queue list. list."), (7, "é É z ~ a A a."), (8, "one two " * 30_000)]
    return segment.annotate(corpus.unionByName(spark.createDataFrame(odd, corpus.schema)))


@pytest.mark.parametrize("held", [2_000_000, 12, 0])
def test_the_same_vectors_whatever_is_held(spark, sentences, monkeypatch, held):
    weights = tfidf.idf(sentences)
    wanted = _rows(tfidf.tfidf_vectors(tfidf.tfidf(tfidf.term_freq(sentences, KEYS), weights, KEYS), KEYS))
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", held)
    monkeypatch.setattr(tfidf, "is_small", lambda df: df.count() <= held)
    common, rare = tfidf.common_and_rare(weights)
    assert (rare is None) == (held > 100) and common.count() <= held
    for ruled in (True, False):
        assert _rows(tfidf.vectors_in_place(sentences, weights, KEYS, ruled)) == wanted


def test_no_vector_is_shuffled_where_all_words_are_held(spark, sentences):
    weights = tfidf.idf(sentences)
    made = tfidf.vectors_in_place(sentences, weights, KEYS, ruled=True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
