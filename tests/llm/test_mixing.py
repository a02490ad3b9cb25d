import pytest
from pyspark.sql import functions as F

from quillon.llm import mixing

TABLE = "/root/testdata/sf0.01/documents.parquet"


def test_marginals_meet_their_targets(spark):
    table = spark.read.parquet(TABLE)
    given = {"lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}
    cells = mixing.raked_cells(mixing.described(table), given, fraction=0.1, rounds=25).toPandas()
    assert cells["weight"].sum() == pytest.approx(1)
    assert cells.groupby("__mix_lang")["weight"].sum().to_dict() == pytest.approx(given["lang"], abs=1e-3)
    tokens = cells.groupby("__mix_source")["tokens"].sum() ** mixing.TEMPER
    got = cells.groupby("__mix_source")["weight"].sum()
    assert (got - tokens / tokens.sum()).abs().max() < 1e-3
    expected = cells["probability"] * cells["tokens"]
    assert expected.sum() == pytest.approx(0.1 * cells["tokens"].sum(), rel=1e-3)


def test_probabilities_are_bounded_and_draws_follow_them(spark):
    rows = mixing.mixed(spark.read.parquet(TABLE)).toPandas()
    assert len(rows) == 1000 and rows["probability"].between(0, 1).all()
    assert abs(rows["kept"].sum() - rows["probability"].sum()) < 60


def test_cases(spark, docs):
    rows = [(1, "a b c", None, "s"), (1, "a b c", None, "s"), (None, "d e", "en", None), (2, None, "en", "s")]
    got = mixing.mixed(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.source, r.lang, r.n_tokens) for r in got) == [
        (0, "", "en", 2), (1, "s", "", 3), (1, "s", "", 3), (2, "s", "en", 0),
    ]
    assert mixing.mixed(docs([])).count() == 0
    frame = docs(rows).withColumn("topic", F.lit("own")).withColumn("tokens", F.lit(1))
    sampled = mixing.sample_to_targets(frame)
    assert sampled.columns == frame.columns
    none = mixing.mixed(docs(rows), targets={"source": {"other": 1.0}})
    assert not any(r.kept for r in none.collect())
