"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period ``q``, at least ``max(12, 2 * q)`` words
long, that no neighbouring word extends keeping the period. They are found in one walk:
the states of the suffix automaton that hold the suffixes of a prefix are the path from
its state to the root along suffix links. Access to that path joins it into one and
colours it with the end of the prefix, its last occurrence; on the way it meets the
segments that earlier ends have coloured. A segment with last occurrence ``e`` whose
longest suffix has ``n`` words says that the ``n`` words up to ``e`` stand again at the
new end: if the distance is within ``n``, a square, which starts at ``e - n + 1`` and has
the distance as its smallest period. Squares with the same start and period are one run,
as long as the last of them. All accesses together meet O(n log n) segments.

Only stretches that can hold a run enter the automaton: each word of a run lies in six
words that occur twice in that run, at a distance of its period. A text is cut at words
in no such six, and the parts again, until they stay; the cuts touch no run. This looks
at hashes, whose collisions only leave a part longer than it need be.

``collapsed`` texts keep, of each run, the first period: a word goes if any run contains
it after the run's first ``q`` words.

Words are runs of anything but ASCII white space. Work is per text, without a shuffle. A
text is held whole by its task, with some hundred bytes per word in the stretches that
can hold runs.

Cases: null text counts as empty; a text without runs gives 0 runs, four nulls, the hash
of the empty string and its own words. A null ``doc_id`` is not planted (see ``planted``).
Each row stands for itself, also with a repeated ``doc_id``. An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.batches import each_batch, text_bytes

#: Words of the shortest run, and of the pieces that occur twice in any run.
LEAST, PIECE = 12, 6
#: Text that one step holds as words.
BATCH_BYTES = 16 << 20
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, PIECE, dtype=np.uint64) | np.uint64(1)

Run = tuple[int, int, int]  # start, length, period


def suffix_automaton(symbols: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and longest length of each state, and the state of each prefix.

    State 1 is the root; its link is 0.
    """
    links, sizes, moves = [0, 0], [0, 0], [{}, {}]
    states, last = [], 1
    for symbol in symbols:
        state = len(sizes)
        sizes.append(sizes[last] + 1)
        moves.append({})
        links.append(1)
        at = last
        while at and symbol not in moves[at]:
            moves[at][symbol] = state
            at = links[at]
        if at:
            target = moves[at][symbol]
            if sizes[target] == sizes[at] + 1:
                links[state] = target
            else:
                copy = len(sizes)
                sizes.append(sizes[at] + 1)
                moves.append(moves[target].copy())
                links.append(links[target])
                while at and moves[at].get(symbol) == target:
                    moves[at][symbol] = copy
                    at = links[at]
                links[target] = links[state] = copy
        last = state
        states.append(state)
    return links, sizes, states


class LinkCut:
    """A rooted forest whose root paths are joined by access; each path has a colour.

    Paths are splay trees by depth. ``parent`` of a splay root is the node above its path;
    the colour of a path is kept at its splay root.
    """

    def __init__(self, links: list[int]) -> None:
        self.parent = list(links)
        self.upper, self.lower = [0] * len(links), [0] * len(links)
        self.colour = [-1] * len(links)

    def _rotate(self, node: int, above: int) -> None:
        parent, upper, lower = self.parent, self.upper, self.lower
        top = parent[above]
        if upper[above] == node:
            child = lower[node]
            upper[above], lower[node] = child, above
        else:
            child = upper[node]
            lower[above], upper[node] = child, above
        if child:
            parent[child] = above
        parent[above], parent[node] = node, top
        if top:
            if upper[top] == above:
                upper[top] = node
            elif lower[top] == above:
                lower[top] = node

    def _splay(self, node: int) -> None:
        """Make ``node`` the splay root of its path."""
        parent, upper, lower = self.parent, self.upper, self.lower
        while True:
            above = parent[node]
            if not above or (upper[above] != node and lower[above] != node):
                return
            top = parent[above]
            if top and (upper[top] == above or lower[top] == above):
                straight = (upper[top] == above) == (upper[above] == node)
                if parent[top] == 0 or (upper[parent[top]] != top and lower[parent[top]] != top):
                    self.colour[node] = self.colour[top]
                if straight:
                    self._rotate(above, top)
                else:
                    self._rotate(node, above)
                self._rotate(node, parent[node])
            else:
                self.colour[node] = self.colour[above]
                self._rotate(node, above)

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Join and colour the path from the root to ``node``.

        Returns its former segments from below: their colour and lowest node.
        """
        found, below, at = [], 0, node
        while at:
            self._splay(at)
            own, rest = self.colour[at], self.lower[at]
            found.append((own, at))
            if rest:
                self.colour[rest] = own
            self.lower[at] = below
            below, at = at, self.parent[at]
        self.colour[below] = colour
        self._splay(node)
        return found


def automaton_runs(symbols: Sequence[int]) -> list[Run]:
    """All runs of ``symbols``, by start, then period."""
    links, sizes, states = suffix_automaton(symbols)
    paths, ends = LinkCut(links), {}
    for end, state in enumerate(states):
        for before, lowest in paths.access(state, end):
            size = sizes[lowest]
            if 0 <= before and end - before <= size:
                ends[before - size + 1, end - before] = end
    runs = [(start, end + 1 - start, period) for (start, period), end in ends.items()]
    return sorted(((s, n, p) for s, n, p in runs if n >= LEAST), key=lambda run: (run[0], run[2]))


def stretches(symbols: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that hold all runs: each word of one lies in six that occur twice in it."""
    found, todo = [], [(0, len(symbols))]
    while todo:
        start, end = todo.pop()
        count = end - start - PIECE + 1
        if end - start < LEAST:
            continue
        hashes = np.zeros(count, np.uint64)
        for at in range(PIECE):
            hashes += symbols[start + at : start + at + count] * _MULTIPLIERS[at]
        ordered = np.sort(hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        marks = np.isin(hashes, twice).astype(np.int64)
        depth = np.zeros(end - start + 1, np.int64)
        depth[:count] += marks
        depth[PIECE : PIECE + count] -= marks
        covered = np.concatenate(([False], np.cumsum(depth)[:-1] > 0, [False]))
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        parts = [(start + a, start + b) for a, b in edges.reshape(-1, 2).tolist()]
        if parts == [(start, end)]:
            found.append((start, end))
        else:
            todo += parts
    return sorted(found)


def runs_of(words: Sequence[bytes]) -> list[Run]:
    """All runs of a text, by start, then period."""
    if len(words) < LEAST:
        return []
    codes: dict[bytes, int] = {}
    symbols = [codes.setdefault(word, len(codes)) for word in words]
    if len(codes) == len(symbols):
        return []
    runs: list[Run] = []
    for start, end in stretches(np.array(symbols, np.uint64)):
        runs += [(start + s, n, p) for s, n, p in automaton_runs(symbols[start:end])]
    return runs


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """``words`` without those that a run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [word for word, within in zip(words, np.cumsum(depth).tolist(), strict=False) if not within]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """``words``, in one document of ten repeating from some place on, by its id."""
    number = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), number // 10
    if number % 10 or not n:
        return words
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    piece = words[start : start + period]
    again = piece * (1 + (n - start) // period)
    return words[:start] + again[: n - start]


def periodic_runs(documents: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: its number of runs, the longest, and two digests.

    ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256``. With ``plant``, repeats are put into the texts beforehand.
    """
    schema = (
        "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint,"
        " exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    )
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        ids = batch["doc_id"].to_pylist()
        for doc_id, text in zip(ids, text_bytes(batch["text"]), strict=True):
            words = text.split()
            if plant:
                words = planted(doc_id, words)
            runs = runs_of(words)
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            first = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
            longest = (*first, 1000 * first[1] // first[2]) if first else (None,) * 4
            rest = b" ".join(collapsed(words, runs))
            rows.append(
                (doc_id, len(runs), *longest, sha256(lines.encode()).hexdigest(), sha256(rest).hexdigest())
            )
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = [pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)]
        yield pa.record_batch(columns, names)

    texts = documents.select(F.col("doc_id").cast("bigint"), "text")
    return texts.mapInArrow(each_batch(make, BATCH_BYTES), schema)
