import random
import re

import numpy as np
import pytest

from quillon.llm import near_dedup
from quillon.llm.components import components


def _shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    size = min(4, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _brute(rows):
    sets = [(doc_id, _shingles(text)) for doc_id, text in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for at, (i, one) in enumerate(sets):
        for j, two in sets[:at]:
            if one and two and 100 * len(one & two) >= 80 * len(one | two):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def _result(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


def _near_copies(rng, groups, copies):
    rows = []
    for _ in range(groups):
        words = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 60)) for _ in range(120)]
        for _ in range(copies):
            edited = list(words)
            for _ in range(rng.randint(0, 9)):
                edited[rng.randrange(len(edited))] = f"new{rng.randint(0, 999)}"
            rows.append((len(rows) * 2 + 1, " ".join(edited)))
    return rows


def test_components_equal_brute_force(docs):
    rng = random.Random(5)
    rows = _near_copies(rng, 6, 14)
    rows += [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE\ttwo"), (1004, "one"), (1005, "É b c d"),
             (1006, "é b c d"), (1007, "w " * 30_000)]
    rng.shuffle(rows)
    for block in (near_dedup.BLOCK, 3):
        assert _result(near_dedup.near_groups(docs(rows), block)) == _brute(rows)


def test_cases(docs):
    rows = [(None, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (7, "v w x y z"), (7, "a b c d e")]
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in near_dedup.near_groups(docs(rows)).collect()), key=repr)
    assert got == sorted([(0, None, True), (2, 2, True), (2, 2, True), (7, 2, False), (7, 2, False)], key=repr)
    assert near_dedup.near_groups(docs([])).count() == 0
    kept = near_dedup.keep_one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns and kept.count() == 3


def test_pigeonhole_keys_meet_up_to_the_guaranteed_distance(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 65536, near_dedup.VALUES, dtype=np.uint16)
    rows = [(0, base.tobytes())]
    for number in range(1, 60):
        other = base.copy()
        places = rng.choice(near_dedup.VALUES, near_dedup.CHUNKS * (near_dedup.ERRORS + 1) - 1, replace=False)
        other[places] ^= np.uint16(1)
        rows.append((number, other.tobytes()))
    keys = near_dedup.index_keys(spark.createDataFrame(rows, "rep bigint, sig binary")).collect()
    by_rep = {}
    for r in keys:
        by_rep.setdefault(r.rep, set()).add(r.key)
    assert len(by_rep[0]) == near_dedup.CHUNKS * near_dedup.WIDTH
    assert all(by_rep[0] & by_rep[number] for number in range(1, 60))


@pytest.mark.parametrize("together", [500_000, 20])
def test_chains_and_stars_become_components(spark, monkeypatch, together):
    monkeypatch.setattr("quillon.llm.components.LINKS_TOGETHER", together)
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (900, 901)]
    random.Random(1).shuffle(links)
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    expected = {i: 0 for i in range(1, 41)} | {200 + i: 100 for i in range(50)} | {901: 900}
    assert got == expected
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_words_made_to_collide_are_told_apart(docs):
    """Thue-Morse words, equal under any polynomial modulo 2^64 with an odd base."""
    order = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in order) for flip in (0, 1))
    rest = " ".join(f"w{i}" for i in range(2))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs(rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_long_texts_of_distinct_shingles(docs):
    words = [f"w{i * 7919 % 1_000_003}" for i in range(200_000)]
    edited = words[:]
    edited[::100] = ["x"] * len(edited[::100])
    far = words[:]
    far[::10] = ["x"] * len(far[::10])
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(far))]
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dedup.near_groups(docs(rows)).collect()}
    assert got[1] == (1, 199_997) and got[2][0] == 1 and got[3][0] == 3
