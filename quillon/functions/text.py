"""Splitting text into sentences, tokens and bigrams, inside the row.

Every function here is a column expression, so segmenting a corpus never
shuffles: a document's sentences and a sentence's tokens stay with their row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Both patterns mean the same in Java and in RE2 (no lookaround).
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*|[.!?]+"
TOKEN_PATTERN = r"[\p{L}\p{N}']+|[^\s\p{L}\p{N}']"


def sentence_array(text: Column) -> Column:
    """``array<struct<sent_no int, sent string>>`` of the non-blank sentences.

    ``sent_no`` is the 0-based match position before blanks are dropped.
    """
    pieces = F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), F.lit(0))
    numbered = F.transform(
        pieces,
        lambda s, i: F.struct(i.cast("int").alias("sent_no"), F.trim(s).alias("sent")),
    )
    return F.filter(numbered, lambda x: x["sent"].rlike(r"\S"))


def token_array(text: Column) -> Column:
    """``array<string>`` of tokens in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def next_array(tokens: Column) -> Column:
    """The same tokens moved up by one, so that zipping gives neighbours."""
    return F.slice(tokens, 2, F.size(tokens))


def bigram_array(tokens: Column) -> Column:
    """``array<string>`` of adjacent pairs ``"a b"``; empty below two tokens."""
    heads = F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.zip_with(
        heads, next_array(tokens), lambda a, b: F.concat(a, F.lit(" "), b)
    )
