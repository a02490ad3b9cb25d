import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from quillon.llm import manifest, oracles

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, root string, tree int"


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(nodes):
    """All levels of a tree, lowest first."""
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([_hash(*found[-1][i : i + 8]) for i in range(0, len(found[-1]), 8)])
    return found


def _path(levels, place):
    """(left siblings, right siblings) on each level below the root."""
    for nodes in levels[:-1]:
        first = place // 8 * 8
        yield nodes[first:place], nodes[place + 1 : first + 8]
        place //= 8


def _brute(rows):
    by_lang = defaultdict(list)
    for row in rows:
        row = {**row, "leaf": _leaf(row, row["text"])}
        by_lang[row["lang"]].append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        trees[lang] = _levels([r["leaf"] for r in by_lang[lang]])
    top = _levels([trees[lang][-1][0] for lang in langs])
    root, found = top[-1][0], []
    for at, lang in enumerate(langs):
        for place, row in enumerate(by_lang[lang]):
            path = [*_path(trees[lang], place), *_path(top, at)]
            text, number = row["text"], zlib.crc32(str(row["doc_id"]).encode())
            if row["doc_id"] is not None and number % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = _leaf(row, text)
            for left, right in path:
                node = _hash(*left, node, *right)
            proof = _hash(*(x for left, right in path for x in left + right))
            found.append((row["doc_id"], row["leaf"], trees[lang][-1][0], root, proof, node, node == root))
    return found


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def _rows(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for lang, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "Plain Text", "no capitals", "É ß 漢 A"]) if size > 3 else "Abc"
            rows.append((rng.randrange(10**6), rng.choice(["s", None, ""]), lang, len(text or "") or None, text, "r", 0))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"en": 1},
        {None: 1, "": 1, "b": 1},
        {"en": 8},
        {"en": 9, None: 64},
        {"en": 65, "de": 1, "é": 7, "z": 3, "Z": 2},
        {f"l{i}": 1 for i in range(70)},
        {"en": 1300, "fr": 513, "x": 512, None: 30},
    ],
)
def test_rows_equal_brute_force(spark, sizes):
    frame = spark.createDataFrame(_rows(sizes), SCHEMA)
    expected = _sorted(_brute([r.asDict() for r in frame.collect()]))
    got = _sorted(tuple(r) for r in manifest.manifest(frame).collect())
    assert got == expected
    assert all(r[6] for r in got if r[0] % 1 == 0 and r[5] == r[3])


def test_several_rounds(spark):
    """Trees of four rounds of blocks, also over the languages."""
    sizes = {"en": 700, "fr": 64, "x": 65, None: 1, **{f"l{i}": 1 for i in range(20)}}
    frame = spark.createDataFrame(_rows(sizes), SCHEMA)
    expected = _sorted(_brute([r.asDict() for r in frame.collect()]))
    assert _sorted(tuple(r) for r in manifest.manifest(frame, levels=1).collect()) == expected


def test_repeated_and_null_ids(spark):
    rows = [(None, "s", "en", 1, "Aa"), (None, "s", "en", 1, "Aa"), (4, "s", "en", 1, "b"), (4, "s", "en", 1, "b"), (4, None, None, None, None)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = _sorted(tuple(r) for r in manifest.manifest(frame).collect())
    assert got == _sorted(_brute([r.asDict() for r in frame.collect()]))
    assert manifest.manifest(frame.limit(0)).count() == 0


def test_long_texts_and_capitals(spark):
    rows = [(i, "s", "en", 5, ("Word " if i % 2 else "word ") * 400_000, "x", 1) for i in range(12)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.verified for r in manifest.manifest(frame).collect()}
    assert got == {i: not (zlib.crc32(str(i).encode()) % 3 == 0 and i % 2) for i in range(12)}
    assert False in got.values()


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 700])
def test_appended_witnesses_grow_at_their_end(size):
    tree, seen = manifest.Appender(), {}
    leaves = [_hash(str(i)) for i in range(size)]
    for leaf in leaves:
        tree.append(leaf)
        for i, witness in enumerate(tree.witnesses[:3]):
            assert witness[: len(seen.get(i, []))] == seen.get(i, [])
            seen[i] = list(witness)
    root = tree.finish()
    assert root == _levels(leaves)[-1][0]
    assert {manifest.folded(leaf, w) for leaf, w in zip(leaves, tree.witnesses, strict=True)} == {root}


def test_sql_equals_operator_beside_ties(spark):
    frame = spark.createDataFrame(_rows({"en": 600, None: 9, "fr": 1, "é": 70}), SCHEMA)
    con = duckdb.connect()
    con.register("documents", frame.toPandas().astype({"n_chars": "Int64"}))
    theirs = con.sql(oracles.MERKLE_MANIFEST).fetchall()
    names = [c[0] for c in con.sql(oracles.MERKLE_MANIFEST).description]
    ours = manifest.manifest(frame).select(*names).collect()
    assert _sorted(theirs) == _sorted(tuple(r) for r in ours)
