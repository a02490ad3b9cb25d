import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quillon.llm import quality

SF = "/root/testdata/sf0.01"


def _brute_features(text):
    """Bucket -> value, word by word."""
    words = re.findall(b"[^\x20\x09-\x0d]+", text)
    shape = re.sub(rb"[\x80-\xff]", b"a", re.sub(rb"[0-9]", b"0", re.sub(rb"[a-z]", b"a", re.sub(rb"[A-Z]", b"A", text))))
    shape = re.sub(rb"([Aa0])\1+", rb"\1", shape)
    found = Counter({quality.INTERCEPT: 1.0})
    for at, tokens in enumerate((words, re.findall(b"[^\x20\x09-\x0d]+", shape))):
        ids = [zlib.crc32(t) for t in tokens]
        for size, numbers in enumerate((ids, [a << 32 | b for a, b in zip(ids, ids[1:], strict=False)])):
            buckets = Counter(int(quality._buckets(np.array([x], np.uint64), 2 * at + size)[0]) for x in numbers)
            norm = math.sqrt(sum(buckets.values()))
            for bucket, n in buckets.items():
                found[bucket] += 0.5 * math.sqrt(n) / norm
    return found


def test_features_equal_brute_force():
    for text in ("", "one", "The THE the!! 12,5 été\tété", "a b a b a\n\x0bb c", "漢字 x-y AAb1"):
        found = Counter()
        places, values = quality.features(text.encode())
        assert len(set(places.tolist())) == len(places)
        for place, value in zip(places, values, strict=True):
            found[int(place)] += value
        expected = _brute_features(text.encode())
        assert found.keys() == expected.keys()
        assert all(abs(found[k] - expected[k]) < 1e-12 for k in expected)


def _brute_leader(examples):
    """The update rule, one coordinate at a time."""
    z, n, w = Counter(), Counter(), {}

    def weight(i):
        penalty = 0.0 if i == quality.INTERCEPT else quality.L1
        if abs(z[i]) <= penalty:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * penalty) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for features, label in examples:
        w = {i: weight(i) for i in features}
        p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in features.items())))
        for i, x in features.items():
            g = (p - label) * x
            step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
            z[i] += g - step * w[i]
            n[i] += g * g
    return {i: weight(i) for i in n}


def test_updates_equal_brute_force():
    texts = [("good plain words", 1), ("BAD!! BAD!!", 0), ("good words", 1), ("BAD!! words", 0)] * 5
    leader = quality.Leader()
    for text, label in texts:
        leader.learn(*quality.features(text.encode()), label)
    found = leader.weights(np.arange(quality.BUCKETS))
    expected = _brute_leader([(_brute_features(t.encode()), y) for t, y in texts])
    for place, weight in expected.items():
        assert found[place] == pytest.approx(weight, abs=1e-9)
    assert np.count_nonzero(found) == sum(w != 0 for w in expected.values())


def test_held_out_accuracy_and_fold(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality_scores(documents, labels).collect()}
    assert len(got) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    known = {r.doc_id: r.quality for r in labels.collect()}
    fold = [(known[i], r) for i, r in got.items() if r.held_out and i in known]
    assert sum(r.predicted == y for y, r in fold) / len(fold) > 0.95
    ones, zeros = [r.score for y, r in fold if y], [r.score for y, r in fold if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    assert pairs / (len(ones) * len(zeros)) > 0.98


def test_held_out_labels_change_nothing(spark, docs):
    texts = docs([(i, "plain words here" if i % 2 else "LOUD!! NOISE!!") for i in range(60)])
    schema = "doc_id bigint, quality int, toxic int"
    right = [(i, i % 2, 0) for i in range(60)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in right]
    one, two = (
        {r.doc_id: r.score for r in quality.quality_scores(texts, spark.createDataFrame(rows, schema)).collect()}
        for rows in (right, wrong)
    )
    assert one == two
    assert all((score > 0.5) == bool(i % 2) for i, score in one.items())


def test_cases(spark, docs):
    schema = "doc_id bigint, quality int, score string, held_out string"
    labels = [(1, 1, "x", "x"), (1, 0, "x", "x"), (None, 1, "x", "x"), (3, None, "x", "x"), (4, 7, "x", "x"), (99, 1, "x", "x")]
    labels = spark.createDataFrame(labels, schema)
    rows = [(1, "one two"), (1, "one two"), (None, "one"), (3, None), (4, ""), (5, "w " * 300_000)]
    got = quality.quality_scores(docs(rows), labels).collect()
    assert len(got) == 6
    assert not any(r.held_out for r in got if r.doc_id is None)
    empty = {r.score for r in got if r.doc_id in (3, 4)}
    assert len(empty) == 1
    none = quality.quality_scores(docs(rows), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert quality.quality_scores(docs([]), labels).count() == 0


def test_sample_is_bounded(spark, docs):
    rows = docs([(i, "w") for i in range(100)])
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id bigint, quality int")
    assert quality.training_rows(rows, labels, 10).select("doc_id").distinct().count() == 10
