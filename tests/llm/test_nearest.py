import numpy as np

from quillon.llm import nearest

SCHEMA = "vec_id bigint, embedding array<float>, rank string"


def _brute(rows, queries, k):
    ok = {}
    for i, v, _ in sorted((r for r in rows if r[0] is not None and r[1]), key=repr):
        if all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        if q in ok:
            scored = sorted(
                (-float(v @ ok[q]) / float(np.linalg.norm(v) * np.linalg.norm(ok[q])), i)
                for i, v in ok.items()
                if i != q and len(v) == len(ok[q])
            )
            out[q] = [(i, round(-s, 9)) for s, i in scored[:k]]
    return out


def _result(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert r.rank == len(out[r.query_id])
    return out


def test_cases_are_exact_when_all_are_candidates(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist(), "x") for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], "x") for i in range(30)]
    rows += [(200, None, "x"), (201, [0.0] * 6, "x"), (202, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (None, [1.0] * 6, "x")]
    rows += [(203, [float("nan")] * 6, "x"), (204, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0], "x"), (205, [], "x")]
    rows += [(5, rows[5][1], "x"), (300, [1.0, 2.0], "x"), (350, [2.0, 1.0], "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    queries = [0, 50, 100, 150, 200, 300, 350]
    asked = frame.where(frame.vec_id.isin(queries))
    for blocks in ({}, {"data_block": 20, "query_block": 2}):
        assert _result(nearest.nearest(frame, asked, share=1.0, **blocks)) == _brute(rows, queries, 5)
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest.nearest(empty, empty).count() == 0


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    ids = np.array([r.vec_id for r in rows])
    unit = np.array([r.embedding for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = _result(nearest.nearest(table, table.where("vec_id % 50 = 0")))
    found = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[q]
        scores[q] = -2
        true = set(ids[np.argsort(-scores)[:5]].tolist())
        found += len(true & {i for i, _ in got[ids[q]]})
    assert len(got) == (ids % 50 == 0).sum()
    assert found / (5 * len(got)) >= 0.9


def test_forest_finds_the_longest_prefixes_first():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((500, 8))
    forest = nearest.Forest(vectors, trees=4, bits=10)
    for row, mask in enumerate(forest.candidates(vectors[:50], 20)):
        assert mask[row] and mask.sum() >= 20
    assert next(forest.candidates(vectors[:1], 500)).all()


def test_same_id_with_two_lengths(spark):
    """The shorter vector stands, among candidates and queries alike."""
    rows = [(0, [1.0, 2.0], "x"), (0, [1.0, 2.0, 3.0], "x"), (0, [0.5, 9.0], "x"), (1, [1.0, 1.0], "x"), (2, [1.0, 1.0, 1.0], "x"), (3, [2.0, 0.5], "x"), (4, [0.0, 1.0, 1.0], "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = _result(nearest.nearest(frame, frame, share=1.0))
    assert [i for i, _ in got[0]] == [1, 3]
    assert [i for i, _ in got[2]] == [4]
    assert all(0 not in [i for i, _ in got[q]] for q in (2, 4))
