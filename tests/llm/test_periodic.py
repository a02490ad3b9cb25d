import hashlib
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillon.llm import periodic


def _smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def _brute_runs(words):
    """Every maximal stretch of each period, tried one by one."""
    found, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(12, 2 * q) and _smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def _brute_row(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id,
        len(runs),
        *(longest or (None,) * 3),
        1000 * longest[1] // longest[2] if longest else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(rest.encode()).hexdigest(),
    )


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 4), st.integers(0, 90))
def test_runs_equal_brute_force(seed, letters, size):
    rng = random.Random(seed)
    words = []
    while len(words) < size:
        piece = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 9))]
        words += piece * rng.choice([1, 1, 2, 3, 5])
    assert periodic.runs_of(words) == _brute_runs(words)
    symbols = [int(w) for w in words]
    assert periodic.automaton_runs(symbols) == _brute_runs(words)


def test_cuts_touch_no_run():
    rng = random.Random(3)
    words = [b"%d" % rng.randrange(10**9) for _ in range(300)]
    words[100:140] = words[60:80] * 2
    words[250:262] = [b"x"] * 12
    assert periodic.runs_of(words) == _brute_runs(words)
    assert (60, 40, 20) not in periodic.runs_of(words)
    assert {(100, 40, 20), (250, 12, 1)} <= set(periodic.runs_of(words))


def test_rows_equal_brute_force(spark):
    """All documents of the smallest tables, planted as the contract says."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 6000")
    expected = sorted(_brute_row(r.doc_id, r.text) for r in table.collect())
    got = sorted(tuple(r) for r in periodic.periodic_runs(table, plant=True).collect())
    assert got == expected
    assert sum(r[1] > 0 for r in got) > 10


@pytest.mark.parametrize(
    ("text", "run"),
    [
        (None, None),
        ("", None),
        (" \t\n", None),
        ("a " * 11, None),
        ("a " * 12, (0, 12, 1)),
        ("a b c d e f " * 2, (0, 12, 6)),
        ("x " + "a b c d e f g " * 2 + "a z", (1, 15, 7)),
        # A no-break space is part of a word.
        ("a b " * 13, (0, 13, 1)),
        ("é 漢 " * 10, (0, 20, 2)),
    ],
)
def test_cases(docs, text, run):
    row = periodic.periodic_runs(docs([(1, text), (1, text), (None, text)])).collect()
    assert len(row) == 3
    for r in row:
        assert (r.start, r.length, r.period) == (run or (None,) * 3)
        assert r.n_runs == (run is not None)
        assert (r.exponent_milli is None) == (run is None)


def test_ties_take_the_smaller_start(docs):
    piece = "a b c d e f "
    row = periodic.periodic_runs(docs([(1, piece * 2 + "x y z " + piece * 2)])).first()
    assert (row.n_runs, row.start, row.exponent_milli) == (2, 0, 2000)


def test_extra_columns_and_empty_table(spark, docs):
    assert periodic.periodic_runs(docs([])).count() == 0
    clashing = spark.createDataFrame([(1, "a " * 12, 5, 6)], "doc_id int, text string, start int, n_runs int")
    assert periodic.periodic_runs(clashing).first().length == 12


def test_very_long_texts():
    began = time.time()
    assert periodic.runs_of([b"a", b"b", b"c"] * 50_000) == [(0, 150_000, 3)]
    plain = [b"%d" % (i * i % 1_000_003) for i in range(400_000)]
    assert periodic.runs_of(plain) == []
    assert time.time() - began < 60
