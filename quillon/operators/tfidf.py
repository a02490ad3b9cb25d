"""TF-IDF at two granularities: sentences and whole documents.

``keys`` names the element: ``["doc_id", "sent_no"]`` or ``["doc_id"]``. Terms are
lemmas, exact (no hashing), with stop words and punctuation kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.arrays import counted
from quillon.functions.tagging import lemma_array, lemma_of
from quillon.functions.text import sentence_array, token_array
from quillon.operators import joins
from quillon.operators.joins import SALTS, is_small, lookup_join
from quillon.operators.runs import counted_keys, whole_column, whole_runs
from quillon.session import ship_package, stored

SENTENCE = ["doc_id", "sent_no"]
DOCUMENT = ["doc_id"]

# A lemma is hot when it holds at least 1 / HOT_SHARE of all postings. There can be
# at most HOT_SHARE such lemmas whatever the corpus, so their list may be broadcast.
HOT_SHARE = 10_000


def document_lemmas(documents: DataFrame) -> DataFrame:
    """``doc_id, lemmas``: the lemmas of all sentences of a document, in one array.

    Tokens never cross a sentence border, so the sentence arrays are flattened
    inside the row and nothing is shuffled.
    """
    tokens = F.flatten(
        F.transform(
            sentence_array(F.coalesce("text", F.lit(""))), lambda p: token_array(p["sent"])
        )
    )
    return documents.select("doc_id", tokens.alias("toks")).select(
        "doc_id", lemma_array("toks").alias("lemmas")
    )


def term_freq(elements: DataFrame, keys: list[str], lemmas: str = "lemmas") -> DataFrame:
    """``keys, lemma, tf``: raw counts, made inside the row."""
    cells = counted(F.col(lemmas), "lemma", "tf")
    return elements.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.lemma", "c.tf")


def idf_value(m: Column, df: Column) -> Column:
    """``ln((m + 1) / (df + 1))``"""
    return F.log((m + 1) / (df + 1))


def idf(elements: DataFrame, lemmas: str = "lemmas") -> DataFrame:
    """``lemma, df, idf`` over all elements (rows with a lemma array).

    One pass over the corpus: each element also counts the empty string once, and
    as no token is empty, its frequency is the number of elements. The counts (one
    row per lemma) are written because the plan reads them more than once.
    """
    marks = F.concat(F.array_distinct(lemmas), F.array(F.lit("")))
    counts = stored(
        elements.select(F.explode(marks).alias("lemma"))
        .groupBy("lemma")
        .agg(F.count("*").alias("df")),
        "frequencies",
    )
    size = counts.where("lemma = ''").select("df").scalar()
    return counts.where("lemma <> ''").select(
        "lemma", "df", idf_value(size, F.col("df")).alias("idf")
    )


def tfidf(postings: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, lemma, tf, idf, tfidf``: postings joined with the IDF of their lemma.

    A vocabulary that is measured to be small is broadcast. Beyond that both sides
    are shuffled by lemma; hot lemmas (see ``HOT_SHARE``) are salted over ``SALTS``
    partitions, all others hold too little to matter.
    """
    weights = weights.select("lemma", "df", "idf")
    if is_small(weights):
        joined = postings.join(F.broadcast(weights), "lemma")
    else:
        # The sum of df is the number of postings.
        total = weights.agg(F.sum("df").alias("t")).scalar()
        marked = weights.withColumn("hot", F.col("df") * HOT_SHARE >= total)
        hot = marked.where("hot").select("lemma", F.lit(True).alias("is_hot"))
        none, every = F.expr("array(0L)"), F.expr(f"sequence(0L, {SALTS - 1}L)")
        side = marked.withColumn("salt", F.explode(F.when(F.col("hot"), every).otherwise(none)))
        spread = F.pmod(F.xxhash64(*keys), F.lit(SALTS))
        joined = (
            postings.join(F.broadcast(hot), "lemma", "left")
            .withColumn("salt", F.when(F.col("is_hot"), spread).otherwise(F.expr("0L")))
            .join(side, ["lemma", "salt"])
        )
    return joined.select(*keys, "lemma", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf_vectors(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, vector``: each element's terms and weights, sorted by term.

    A group is one sentence or one document, so its size is that of its text.
    """
    return weighted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("lemma", "tfidf"))).alias("vector")
    )


def common_and_rare(weights: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``weights`` cut by ``df``: the frequent words, as many as may be broadcast, and the others.

    None if there are no others. Only sums by the size of ``df`` reach the driver.
    """
    if is_small(weights):
        return weights, None
    width = F.octet_length("lemma") + 8 * len(weights.columns)
    by_bits = weights.groupBy(F.length(F.bin("df")).alias("bits"))
    sums = by_bits.agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).collect()
    n, size, least = 0, 0, 2**62
    for row in sorted(sums, reverse=True):
        n, size = n + row["n"], size + row["bytes"]
        if n > joins.MAX_BROADCAST_ROWS or size > joins.MAX_BROADCAST_BYTES:
            break
        least = 2 ** (row["bits"] - 1)
    return weights.where(F.col("df") >= least), weights.where(F.col("df") < least)


def vectors_in_place(
    elements: DataFrame, weights: DataFrame, keys: list[str], ruled: bool = False
) -> DataFrame:
    """The rows of ``tfidf_vectors``, made where the elements lie; ``keys`` name a row.

    Frequent words are looked up token by token in a broadcast, and counted in Arrow batches.
    Only elements with a word beyond those are shuffled, and of the postings only the rare ones.
    With ``ruled`` lemmas are told from ``toks`` by rule, as without a lexicon.
    """
    common, rare = common_and_rare(weights.select("lemma", "df", "idf"))
    # The outer form: see ``segment.split_sentences``.
    words = F.posexplode_outer("toks" if ruled else "lemmas").alias("pos_no", "tok")
    lemma = lemma_of("tok") if ruled else F.col("tok")
    first = F.coalesce("pos_no", F.lit(0)) == 0
    tokens = elements.select(*keys, words).select(*keys, first.alias("first"), lemma.alias("lemma"))
    # A broadcast join leaves the rows in their order.
    tokens = tokens.join(F.broadcast(common.select("lemma", "idf")), "lemma", "left")
    types = {f.name: f.dataType.simpleString() for f in tokens.schema}
    ship_package(elements.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches):
            columns = _vectors(rows, keys)
            yield pa.RecordBatch.from_arrays(columns, [*keys, "vector", "rare"])

    cells = [*(f"{c} {types[c]}" for c in keys), "vector array<struct<lemma:string,tfidf:double>>"]
    cells.append("rare array<struct<lemma:string,tf:bigint>>")
    made = tokens.mapInArrow(count, ", ".join(cells))
    if rare is None:
        return made.select(*keys, "vector")
    # Written, as it is read three times and the elements should not be looked at again.
    made = stored(made, "vectors")
    whole = made.where(F.size("rare") == 0).select(*keys, "vector")
    parted = made.where(F.size("rare") > 0)
    postings = parted.select(*keys, F.explode("rare").alias("c")).select(*keys, "c.lemma", "c.tf")
    # Rare words are in few elements, so that none has to be salted.
    weighted = lookup_join(postings, rare.select("lemma", "idf"), ["lemma"], small=False)
    cell = F.struct("lemma", (F.col("tf") * F.col("idf")).alias("tfidf"))
    others = weighted.groupBy(*keys).agg(F.collect_list(cell).alias("others"))
    joined = parted.select(*keys, "vector").join(others, keys)
    return whole.unionByName(joined.select(*keys, F.sort_array(F.concat("vector", "others")).alias("vector")))


def _vectors(rows: pa.Table, keys: list[str]) -> list[pa.Array]:
    """Local part: ``keys, vector, rare`` of each element that has a word."""
    run = np.cumsum(rows["first"].to_numpy()) - 1
    there = rows["lemma"].is_valid().to_numpy()
    if not there.all():
        rows, run = rows.filter(pa.array(there)), run[there]
    words = whole_column(rows, "lemma").dictionary_encode() if len(rows) else pa.array([], pa.string()).dictionary_encode()
    order = pc.sort_indices(words.dictionary)
    place = np.empty(len(order), dtype=np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    code = place[words.indices.to_numpy()]
    idf = np.full(len(order), np.nan)
    idf[code] = rows["idf"].to_numpy()
    names = words.dictionary.take(order)
    of, code, tf = counted_keys(run, code)
    heads, starts = np.unique(run, return_index=True)
    known = ~np.isnan(idf[code])

    def listed(chosen: np.ndarray, name: str, values: np.ndarray) -> pa.Array:
        cells = pa.StructArray.from_arrays(
            [names.take(pa.array(code[chosen])), pa.array(values[chosen])], ["lemma", name]
        )
        ends = np.append(np.searchsorted(of[chosen], heads), chosen.sum()).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), cells)

    columns = [rows[c].take(pa.array(starts)).combine_chunks() for c in keys]
    columns = [pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return [*columns, listed(known, "tfidf", tf * idf[code]), listed(~known, "tf", tf)]
