"""Token counts under a unigram model, by dynamic programming over a shared trie.

The tokens of a pre-token are its most probable segmentation into vocabulary pieces,
the sum of log probabilities being largest; among equals the one with fewer tokens
counts. Distinct pre-tokens are walked in sorted order, which is a depth-first walk of
their trie: the forward score of a prefix (a trie node) is computed once and shared by
all that start with it, and the count at the end of a pre-token is what is stored.
A character that no piece covers takes one token per UTF-8 byte.

Pre-tokens are maximal runs without white space, each led by the word mark. Piece
probabilities follow the rank of a piece in the vocabulary file, as 1 / (rank + 2).
Work is per row, without a shuffle; the vocabulary, fixed by its file, is broadcast.

Cases: null or blank text has no tokens. Each row stands for itself, also with a null
or repeated ``doc_id``. An empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import slices

#: The word mark of the vocabulary file.
MARK = "▁"
#: Log probability of a byte of an uncovered character.
UNKNOWN_BYTE = -25.0
#: Remembered pre-tokens of a task; beyond, it starts over (memory, not results).
CACHE_SIZE = 400_000


def read_pieces(path: str) -> dict[str, float]:
    """Log probability of each ordinary piece of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {}
    for n in range(model.get_piece_size()):
        if not (model.is_control(n) or model.is_unknown(n) or model.is_byte(n)):
            pieces[model.id_to_piece(n)] = -math.log(n + 2)
    return pieces


def _shared(one: str, two: str) -> int:
    size = min(len(one), len(two))
    for at in range(size):
        if one[at] != two[at]:
            return at
    return size


def trie_counts(pre_tokens: Iterable[str], pieces: dict[str, float], longest: int) -> dict[str, int]:
    """Tokens of each distinct pre-token; every trie node is scored once."""
    counts: dict[str, int] = {}
    # Forward score and (negated) token count of each prefix on the current trie path.
    path: list[tuple[float, int]] = [(0.0, 0)]
    last = ""
    score_of = pieces.get
    for word in sorted(set(pre_tokens)):
        del path[_shared(last, word) + 1 :]
        for end in range(len(path), len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "replace"))
            score, tokens = path[end - 1]
            best = (score + UNKNOWN_BYTE * size, tokens - size)
            for start in range(max(0, end - longest), end):
                own = score_of(word[start:end])
                if own is not None:
                    score, tokens = path[start]
                    if (found := (score + own, tokens - 1)) > best:
                        best = found
            path.append(best)
        counts[word] = -path[-1][1]
        last = word
    return counts


def token_counts(documents: DataFrame, pieces: dict[str, float]) -> DataFrame:
    """``doc_id, n_pre_tokens, n_tokens`` of each row."""
    longest = max(map(len, pieces), default=1)
    shared = documents.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            texts = [text or "" for text in batch["text"].to_pylist()]
            words, tokens = [], []
            for start, end in slices([len(text) for text in texts], 2_000_000):
                split = [text.split() for text in texts[start:end]]
                if len(known) > CACHE_SIZE:
                    known.clear()
                new = {word for found in split for word in found if word not in known}
                marked = trie_counts([MARK + word for word in new], shared.value, longest)
                known.update((word[1:], n) for word, n in marked.items())
                words += map(len, split)
                tokens += [sum(map(known.__getitem__, found)) for found in split]
            columns = [batch["doc_id"], pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.record_batch(columns, ["doc_id", "n_pre_tokens", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_pre_tokens bigint, n_tokens bigint")
