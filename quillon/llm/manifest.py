"""Merkle manifest of a dataset with a proof per row, by incremental witnesses.

Every row is a leaf: the SHA-256 of its fields, each as byte count and value. The leaves
of a language, by ``doc_id``, form a tree of runs of ``FAN`` nodes (the last run of a
level may be shorter, also a single node); the roots of the languages form one more tree,
whose root stands for the dataset. Digests are joined as lowercase hex.

A tree is grown by appending (``Appender``): a leaf joins the open run of the lowest level
with an empty witness, and whenever a run is completed each node in it hands its siblings
to the witnesses of all leaves below it, so that a witness only ever grows at its end. It
is cut at aligned blocks of ``FAN ** LEVELS`` leaves, which tasks append on their own; the
roots of the blocks are the leaves of the next round, as further appends, until a tree
has one node. Then the rounds are walked back: the witness of a block's root completes
those of its leaves. A task holds one block, whatever the size of a language, and texts
are hashed where they are read; only digests are shuffled.

``verified`` recomputes the root from a leaf and its siblings. In rows picked by their id
(``tampered``) the leaf is first made again from a text whose A-Z are lower-cased.

Cases: null fields count as ``-``. A null ``lang`` is a language of its own, the first. A
null ``doc_id`` comes first in its language and is never tampered with. Rows that share a
``doc_id`` follow each other by their leaf; each stands for itself. Empty and very long
texts are hashed whole. An empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.operators.joins import lookup_join
from quillon.operators.numbering import numbered
from quillon.session import stored

#: Nodes of a run, and levels of a block (its leaves are ``FAN ** LEVELS``).
FAN, LEVELS = 8, 3

# The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(joined: str) -> str:
    return sha256(joined.encode()).hexdigest()


class Appender:
    """A growing tree whose leaves carry witnesses.

    ``levels`` is how far a block of a larger tree climbs; without it the tree stands
    alone and ends at one node.
    """

    def __init__(self, levels: int | None = None) -> None:
        self.levels = levels
        #: Per level the open run: digests of its nodes, and the leaves below each.
        self.open: list[list[tuple[str, list[int]]]] = []
        #: Per leaf and level, lowest first: siblings on the left, siblings on the right.
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        self._add(0, leaf, [len(self.witnesses) - 1])

    def _add(self, level: int, node: str, below: list[int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for place, (_, below) in enumerate(run):
            siblings = "".join(nodes[:place]), "".join(nodes[place + 1 :])
            for leaf in below:
                self.witnesses[leaf].append(siblings)
        self._add(level + 1, digest("".join(nodes)), [leaf for _, below in run for leaf in below])

    def finish(self) -> str:
        """Complete the short runs from below; the root."""
        level = 0
        while True:
            run = self.open[level]
            alone = level == len(self.open) - 1 and len(run) == 1
            if level == self.levels or self.levels is None and alone:
                return run[0][0]
            if run:
                self._complete(level)
            level += 1


def folded(leaf: str, witness: list[tuple[str, str]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for left, right in witness:
        leaf = digest(left + leaf + right)
    return leaf


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    fields = [_field(text if name == "text" else F.col(name)) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def tampered() -> Column:
    """Rows whose text is changed before they are verified."""
    number = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    return F.coalesce(number % 3 == 0, F.lit(False))


def leaves(documents: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, forged, row`` of each row, written once.

    ``tree`` orders languages with null first. ``forged`` is the leaf of the changed text,
    null where nothing is changed. ``row`` tells equal rows apart.
    """
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    rows = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _leaf(F.col("text")).alias("leaf"),
        F.when(tampered(), _leaf(lowered)).alias("forged"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(rows, "leaves")


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``place`` in their tree, from 0, and ``size``, the tree's leaves."""
    ordered = numbered(nodes, [F.asc("tree"), *[F.asc(c) for c in order]], "id")
    trees = ordered.groupBy("tree").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    joined = lookup_join(ordered, trees, ["tree"], "inner", [F.col("id")])
    return joined.withColumn("place", F.col("id") - F.col("first")).drop("id", "first")


def _grown_block(table: pa.Table, levels: int) -> Appender:
    """The tree over the ``node`` column of one block, in order of ``place``."""
    alone = table.column("size")[0].as_py() <= FAN**levels
    tree = Appender(None if alone else levels)
    for node in table.column("node").to_pylist():
        tree.append(node.hex())
    return tree


NODE_SCHEMA = "tree string, place bigint, size bigint, node binary"


def _block(levels: int) -> Column:
    return F.floor(F.col("place") / FAN**levels).alias("block")


def rounds(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """``nodes`` of every round: the leaves, the roots of their blocks, and so on.

    The last has one node for each tree. Four rounds do for 68 billion leaves in a tree.
    """

    def block_root(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        place, size = table.column("place")[0].as_py(), table.column("size")[0].as_py()
        root = bytes.fromhex(_grown_block(table, levels).finish())
        return pa.table(
            {
                "tree": table.column("tree")[:1],
                "place": pa.array([place // FAN**levels]),
                "size": pa.array([-(-size // FAN**levels)]),
                "node": pa.array([root]),
            }
        )

    found = [nodes]
    while (found[-1].agg(F.max("size")).first()[0] or 1) > 1:
        blocks = found[-1].select("tree", "place", "size", "node").groupBy("tree", _block(levels))
        found.append(stored(blocks.applyInArrow(block_root, NODE_SCHEMA), "nodes"))
    return found


WITNESS_SCHEMA = "tree string, place bigint, left array<string>, right array<string>"


def _witnessed(table: pa.Table, above: pa.Table, levels: int) -> list[list[tuple[str, str]]]:
    """The complete witness of each node of a block, given that of its root."""
    tree = _grown_block(table, levels)
    tree.finish()
    (left,), (right,) = above.column("left").to_pylist(), above.column("right").to_pylist()
    rest = list(zip(left, right, strict=True))
    return [own + rest for own in tree.witnesses]


def _with_above(nodes: DataFrame, above: DataFrame, levels: int):
    """Each block of ``nodes`` beside the witness of its root."""
    roots = above.withColumnRenamed("place", "block")
    return nodes.groupBy("tree", _block(levels)).cogroup(roots.groupBy("tree", "block"))


def _descended(nodes: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """Witnesses of the first of ``nodes`` from those of the roots of the last one's blocks."""

    def pass_down(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        found = _witnessed(table, above, levels)
        sides = [[[pair[side] for pair in witness] for witness in found] for side in (0, 1)]
        return pa.table(
            {
                "tree": table.column("tree"),
                "place": table.column("place"),
                "left": pa.array(sides[0], pa.list_(pa.string())),
                "right": pa.array(sides[1], pa.list_(pa.string())),
            }
        )

    for level in reversed(nodes):
        above = _with_above(level, above, levels).applyInArrow(pass_down, WITNESS_SCHEMA)
    return above


PROOF_SCHEMA = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string, verified boolean"
)


def _prove(table: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    table = table.sort_by("place")
    (subroot,), (root,) = above.column("subroot").to_pylist(), above.column("root").to_pylist()
    found = _witnessed(table, above, levels)
    leaf = [node.hex() for node in table.column("node").to_pylist()]
    forged = [node and node.hex() for node in table.column("forged").to_pylist()]
    again = [folded(f or own, w) for f, own, w in zip(forged, leaf, found, strict=True)]
    proofs = [digest("".join(left + right for left, right in w)) for w in found]
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "leaf": pa.array(leaf, pa.string()),
            "subroot": pa.array([subroot] * len(leaf), pa.string()),
            "root": pa.array([root] * len(leaf), pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(again, pa.string()),
            "verified": pa.array([value == root for value in again], pa.bool_()),
        }
    )


def _language_witnesses(subroots: DataFrame, levels: int) -> DataFrame:
    """``tree, place, left, right, subroot, root`` of each language's root (place 0)."""
    top = stored(placed(subroots.withColumn("tree", F.lit("")), ["lang_tree"]), "subroots")
    upper = rounds(top, levels)
    none = F.array().cast("array<string>")
    whole = upper[-1].select("tree", "place", none.alias("left"), none.alias("right"))
    root = F.broadcast(upper[-1].select(F.lower(F.hex("node")).alias("root")))
    found = _descended(upper[:-1], whole, levels).join(top, ["tree", "place"]).join(root)
    renamed = found.select(
        F.col("lang_tree").alias("tree"),
        F.lit(0).cast("bigint").alias("place"),
        "left",
        "right",
        F.lower(F.hex("node")).alias("subroot"),
        "root",
    )
    return stored(renamed, "witnesses")


def manifest(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    A task appends blocks of ``FAN ** levels`` leaves.
    """
    nodes = placed(leaves(documents), ["doc_id", "leaf", "row"])
    grown = rounds(stored(nodes.withColumnRenamed("leaf", "node").drop("row"), "placed"), levels)
    subroots = grown[-1].select(F.col("tree").alias("lang_tree"), "node")
    ends = _language_witnesses(subroots, levels)
    # Where every language is a lone leaf, that one is the only round and its own block.
    near = _descended(grown[1:-1], ends.select("tree", "place", "left", "right"), levels)
    roots = ends.select("tree", "subroot", "root")
    above = lookup_join(near, roots, ["tree"], "inner", [F.col("place")])

    def prove(table: pa.Table, above: pa.Table) -> pa.Table:
        return _prove(table, above, levels)

    return _with_above(grown[0], above, levels).applyInArrow(prove, PROOF_SCHEMA)
