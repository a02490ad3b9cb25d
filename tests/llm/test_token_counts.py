import random

from public_tokenizers import path

from quillon.llm import token_counts

PIECES = {"▁": -1.0, "a": -2.0, "b": -2.5, "ab": -3.0, "aba": -4.5, "▁a": -2.8, "ba": -4.4}


def _brute(word):
    """Best (score, -tokens) over all segmentations."""
    if not word:
        return (0.0, 0)
    options = []
    for end in range(1, len(word) + 1):
        if word[:end] in PIECES:
            score, tokens = _brute(word[end:])
            options.append((score + PIECES[word[:end]], tokens - 1))
    size = len(word[0].encode())
    score, tokens = _brute(word[1:])
    options.append((score + token_counts.UNKNOWN_BYTE * size, tokens - size))
    return max(options, key=lambda o: (round(o[0], 9), o[1]))


def test_shared_trie_equals_all_segmentations():
    rng = random.Random(2)
    words = ["▁" + "".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    counts = token_counts.trie_counts(words, PIECES, 3)
    assert set(counts) == set(words)
    for word in words:
        _, tokens = _brute(word)
        assert counts[word] == -tokens, word


def test_table(docs):
    rows = [(1, "ab aba\nab"), (2, None), (3, "  "), (None, "é"), (1, "ab aba\nab"), (4, "ab" * 30_000)]
    got = token_counts.token_counts(docs(rows), PIECES).collect()
    one = -_brute("▁ab")[1]
    assert got[0].n_pre_tokens == 3
    assert got[0].n_tokens == 2 * one - _brute("▁aba")[1] == got[4].n_tokens
    assert [(r.n_pre_tokens, r.n_tokens) for r in got[1:3]] == [(0, 0), (0, 0)]
    assert got[3].n_tokens == 3
    assert got[5].n_pre_tokens == 1 and got[5].n_tokens > 20_000
    assert token_counts.token_counts(docs([]), PIECES).count() == 0


def test_pieces_of_the_vocabulary_file():
    pieces = token_counts.read_pieces(path("piece_bpe_32k.model"))
    assert len(pieces) > 30_000 and "▁the" in pieces and "<s>" not in pieces
    assert token_counts.trie_counts(["▁the"], pieces, 16) == {"▁the": 1}
