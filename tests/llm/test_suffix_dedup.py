import hashlib
import random

import numpy as np
import pyarrow as pa

from quillon.llm import suffix_dedup
from quillon.operators import joins


def _brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        covered = np.zeros(len(data), bool)
        for start in range(len(data) - 99):
            string = data[start : start + 100]
            if string in seen:
                covered[start : start + 100] = True
            seen.add(string)
        edges = np.diff(np.pad(covered, 1).astype(int))
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        out[doc_id] = (len(data), int(covered.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def _result(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


def _texts(seed, count):
    rng = random.Random(seed)
    words = ["aa", "b", "the", "ünd", "xyz", "q"]
    base = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(5)]

    def part():
        cut = rng.choice(base)[rng.randint(0, 80) : rng.randint(90, 250)]
        return cut + rng.choice(["", "x" * rng.randint(0, 150), "\n", "ab" * rng.randint(0, 90)])

    return [(i * 3, "".join(part() for _ in range(rng.randint(0, 5)))) for i in range(count)]


def test_equals_brute_force(docs):
    rows = _texts(3, 80) + [(1, None), (2, ""), (4, "x" * 99), (5, "y" * 100), (500, "y" * 3000)]
    assert _result(suffix_dedup.removed_repeats(docs(rows))) == _brute(rows)


def test_anchors_of_many_segments_are_split(docs):
    rows = _texts(4, 60)
    assert _result(suffix_dedup.removed_repeats(docs(rows), hot=2)) == _brute(rows)


def _segment_batches(rows, size):
    for start in range(0, len(rows), size):
        columns = zip(*rows[start : start + size], strict=True)
        yield pa.record_batch([pa.array(list(c)) for c in columns], suffix_dedup._NAMES)


def test_segments_are_compared_in_a_stream():
    # A common anchor of 50,000 segments, each content twice.
    rows = [(7, i // 2, i, 128, False) for i in range(50_000)]
    taken, given, most = 0, 0, 0

    def feed():
        nonlocal taken
        for batch in _segment_batches(rows, 1_000):
            taken += batch.num_rows
            yield batch

    for batch in suffix_dedup._compared(feed()):
        given += batch.num_rows
        most = max(most, taken - given)
    assert given == 50_000 and most <= 1_001


def test_batch_borders_do_not_change_what_is_compared():
    rng = random.Random(8)
    rows = sorted(
        (rng.randint(0, 12), rng.randint(0, 3), rng.randint(0, 9), 128 * rng.randint(1, 2), False) for _ in range(120)
    )
    marked = [(*row[:4], rng.random() < 0.2 and i > 0 and row[:2] == rows[i - 1][:2]) for i, row in enumerate(rows)]
    contents = {}
    for anchor, content, *_ in rows:
        contents.setdefault(anchor, set()).add(content)
    begun, expected = {}, []
    for anchor, content, doc, at, known in marked:
        if known:
            expected.append((anchor, doc, at, True))
        elif (anchor, content) not in begun:
            begun[anchor, content] = doc, at
            if len(contents[anchor]) > 1:
                expected.append((anchor, doc, at, False))
        elif begun[anchor, content] != (doc, at):
            expected.append((anchor, doc, at, True))
    for size in (1, 2, 3, 7, 50, 200):
        found = [
            tuple(row[name] for name in suffix_dedup._KEPT)
            for batch in suffix_dedup._compared(_segment_batches(marked, size))
            for row in batch.to_pylist()
        ]
        assert sorted(found) == sorted(expected)


def test_strings_of_common_anchors_join_with_a_salt(docs, monkeypatch):
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    rows = [(i, "xyz " * 5 + "the same passage of text in many documents " * 3 + f"{i:03}" * 30) for i in range(40)]
    assert _result(suffix_dedup.removed_repeats(docs(rows), hot=2)) == _brute(rows)
    pieces = docs([(1, "a")]).selectExpr("1L as anchor", "doc_id", "0L as at", "cast(repeat('ab', 60) as binary) as piece")
    plan = suffix_dedup._group_strings(pieces)._jdf.queryExecution().toString()
    assert "salt" in plan


def test_long_texts_are_looked_at_in_overlapping_pieces(docs, monkeypatch):
    rng = random.Random(6)
    piece = "".join(rng.choice("abcdefgh") for _ in range(400))
    long = "".join(rng.choice("abcdefgh ") for _ in range(suffix_dedup.PIECE - 200)) + piece
    long += "".join(rng.choice("abcdefgh ") for _ in range(2_000))
    rows = [(1, piece), (2, long)]
    assert _result(suffix_dedup.removed_repeats(docs(rows))) == _brute(rows)


def test_cases(docs):
    rows = [(None, "z" * 300), (None, "z" * 300), (1, "w" * 10), (1, "v" * 5), (2, "z" * 100)]
    got = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.removed_repeats(docs(rows)).collect()))
    assert got == [(0, 300, 0), (0, 300, 0), (1, 10, 0), (2, 100, 0)]
    assert suffix_dedup.removed_repeats(docs([])).count() == 0
