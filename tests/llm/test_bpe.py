import hashlib
import random

import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from quillon.llm import bpe

FILE = path("byte_bpe_50k.json")
ODD = "aé ß\n\t\r\x0b\x1c\x85  　'stredlvm09½Ⅷ漢字😀́<|endoftext|>AK_-+=.,!﻿\x00"


@pytest.fixture(scope="module")
def codec():
    return bpe.ForcedBoundaryCodec(bpe.read_tokenizer(FILE))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def _same(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return codec.encode(text) == ids and codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_equals_the_library_on_odd_texts(codec, library):
    rng = random.Random(7)
    for _ in range(1500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.2:
            text += "<|endoftext|>" + text[:3]
        assert _same(codec, library, text), repr(text)


@pytest.mark.parametrize("text", ["", "a" * 50_000, " " * 30_000, "ab" * 20_000, "é!" * 3000, "= " * 500])
def test_equals_the_library_on_long_texts(codec, library, text):
    assert _same(codec, library, text)


def test_equals_the_library_on_documents(codec, library):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    theirs = library.encode_batch(texts, add_special_tokens=False)
    assert [e.ids for e in theirs] == list(codec.encode_all(texts))


def test_fragments_are_cut_at_pairs_inside_no_token(codec):
    cut, counts = codec.fragments([b"ab\x00c", b"d"])
    assert b"".join(cut) == b"ab\x00cd" and sum(counts) == len(cut)
    for fragment in cut:
        assert all(codec.inside[one, two] for one, two in zip(fragment, fragment[1:], strict=False))


def test_a_small_cache_gives_the_same(library):
    small = bpe.ForcedBoundaryCodec(bpe.read_tokenizer(FILE), cache_size=3)
    for text in ("one two three four", "five six\nseven", "one two"):
        assert _same(small, library, text)


def test_round_trip_of_a_table(spark, docs, library):
    rows = [(1, "Some text."), (1, "Some text."), (None, "x"), (2, None), (3, "")]
    got = bpe.round_trip(spark, docs(rows), FILE).collect()
    assert len(got) == 5
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (doc_id, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode_texts(spark, docs(rows), FILE)
    assert [r.text for r in bpe.decode_ids(spark, encoded, FILE).collect()] == [t or "" for _, t in rows]
    assert bpe.round_trip(spark, docs([]), FILE).count() == 0
