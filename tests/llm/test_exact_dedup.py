import hashlib
import random

from quillon.llm import exact_dedup

ROWS = [(1, "a b"), (5, "a b"), (3, "a B"), (4, None), (9, ""), (None, "lone"), (None, "lone"), (7, "é" * 40_000)]


def _result(frame):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in frame.collect()), key=repr
    )


def _brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        group = groups[text or ""]
        keep = max((i for i in group if i is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(group), doc_id == keep, sha))
    return sorted(out, key=repr)


def test_groups_equal_brute_force(docs):
    assert _result(exact_dedup.exact_groups(docs(ROWS))) == _brute(ROWS)


def test_colliding_digests_are_told_apart(docs):
    rows = [(i, str(i % 300) * 5) for i in range(900)]
    assert exact_dedup.collided_digests(docs(rows), digest_bytes=1).count() > 0
    assert _result(exact_dedup.exact_groups(docs(rows), digest_bytes=1)) == _brute(rows)


def test_chunks_join_to_the_text_and_move_with_content():
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcdefgh ") for _ in range(60_000))
    pieces = exact_dedup.chunks(data)
    assert b"".join(pieces) == data and len(pieces) > 5
    assert max(map(len, pieces)) <= exact_dedup.MAX_CHUNK
    moved = exact_dedup.chunks(b"some words before " + data)
    assert len(set(pieces) & set(moved)) >= len(pieces) - 3
    assert exact_dedup.chunks(b"") == []
    assert b"".join(exact_dedup.chunks(b"z" * 70_000)) == b"z" * 70_000


def test_empty_table_and_kept_rows(docs):
    assert exact_dedup.exact_groups(docs([])).count() == 0
    kept = exact_dedup.keep_first_copies(docs(ROWS))
    assert kept.columns == docs(ROWS).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([5, 3, 9, None, None, 7], key=repr)
