"""Secret scan with multipart credential linking, in DataFrame functions only.

Three strong kinds are always reported: ``assign`` (a named value), ``access`` (an
access identifier) and ``hex`` (a long hexadecimal run). Four weak kinds mean little
alone: ``ident`` (a short access identifier), ``opaque`` (a long mixed token),
``shorthex`` and ``endpoint`` (a URL). Every part has a role: identifier, secret or
endpoint. Parts of a document are interval-joined within a scope (a paragraph, and
``REACH`` code points before and after the part, so that the gap between two parts
counts and not their length): a weak part is reported when a strong part of another
role lies there, or weak parts of both other roles, and it does not overlap a strong
one. The join is a running nearest start and end in either direction, so no pairs are
made.

Places are code points, the end exclusive. Matches of a kind are the leftmost that
do not overlap; one that is too short is dropped but has taken its characters.

Cases: null text counts as empty; a text without parts gives zero counts, the hash
of the empty string and empty ``spans``. Each row stands for itself, also with a null
or repeated ``doc_id``. An empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 240

# The three strong patterns.
ASSIGN = (
    "(?i)(password|passwd|secret|token|api_?key)"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"

#: kind, pattern, role, strong, least and most characters
KINDS = [
    ("assign", ASSIGN, "secret", True, 6, None),
    ("access", ACCESS, "identifier", True, 20, None),
    ("hex", HEX, "secret", True, 24, None),
    ("ident", ACCESS, "identifier", False, 12, 19),
    ("opaque", "[A-Za-z0-9+/]{32,}", "secret", False, 32, None),
    ("shorthex", "[0-9a-f]{12,}", "secret", False, 16, 23),
    ("endpoint", "https?://[A-Za-z0-9.-]+[^\\x00-\\x20\"'<>]*", "endpoint", False, 12, None),
    ("scope", "\\n[\\x20\\t\\r]*\\n", "scope", False, 1, None),
]
ROLES = ("identifier", "secret", "endpoint")
#: A token of letters alone is a word, however long.
MIXED = "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"


def _matches(place: int) -> Column:
    """Of one kind: the gap before each match, its length, and whether it counts."""
    kind, pattern, _, _, least, most = KINDS[place]
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def row(match: Column, at: Column) -> Column:
        value = F.regexp_extract(match, pattern, 2) if kind == "assign" else match
        counts = F.length(value) >= least
        if most is not None:
            counts = counts & (F.length(value) <= most)
        if kind == "opaque":
            counts = counts & match.rlike(MIXED)
        return F.struct(
            F.lit(place).alias("kind"),
            at.alias("at"),
            F.length(F.get(gaps, at)).alias("gap"),
            F.length(match).alias("size"),
            counts.alias("counts"),
        )

    return F.transform(found, row)


def _of_kind(field: int) -> Column:
    return F.get(F.array(*[F.lit(kind[field]) for kind in KINDS]), F.col("kind"))


def parts(documents: DataFrame) -> DataFrame:
    """``row, doc_id, kind, start, end`` of all parts, and one null row of each text.

    Without the latter a text would be lost whose only matches are too short to count.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The whole text itself, of no kind.
    whole = F.struct(
        F.lit(None).cast("int").alias("kind"),
        F.lit(0).alias("at"),
        F.lit(0).alias("gap"),
        F.lit(0).alias("size"),
        F.lit(True).alias("counts"),
    )
    found = F.concat(F.array(whole), *[_matches(place) for place in range(len(KINDS))])
    exploded = (
        rows.select("row", "doc_id", found.alias("found"))
        .repartition("row")
        .select("row", "doc_id", F.explode("found").alias("part"))
        .select("row", "doc_id", "part.*")
    )
    before = Window.partitionBy("row", "kind").orderBy("at")
    ended = F.sum(F.col("gap") + F.col("size")).over(before)
    placed = exploded.withColumn("end", ended).withColumn("start", F.col("end") - F.col("size"))
    return placed.where("counts").select("row", "doc_id", "kind", "start", "end")


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """``found`` with ``strong`` and ``reported``."""
    role = _of_kind(2)
    strong = F.coalesce(_of_kind(3), F.lit(False))
    in_order = Window.partitionBy("row").orderBy("start")
    scoped = (
        found.withColumn("role", role)
        .withColumn("strong", strong)
        .withColumn("scope", F.coalesce(F.sum((role == "scope").cast("int")).over(in_order), F.lit(0)))
    )
    of_scope = Window.partitionBy("row", "scope")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    before = of_scope.orderBy("start").rangeBetween(*so_far)
    after = of_scope.orderBy(F.desc("start")).rangeBetween(*so_far)

    def there(condition: Column) -> Column:
        """Whether such a part overlaps this one or stands within reach of it."""
        ended = F.max(F.when(condition, F.col("end"))).over(before)
        begins = F.min(F.when(condition, F.col("start"))).over(after)
        return F.coalesce(ended >= F.col("start") - reach, F.lit(False)) | F.coalesce(
            begins <= F.col("end") + reach, F.lit(False)
        )

    here = {r: there(F.col("role") == r) for r in ROLES}
    firm = {r: there((F.col("role") == r) & F.col("strong")) for r in ROLES}
    linked_to = F.lit(False)
    for r in ROLES:
        one, two = [o for o in ROLES if o != r]
        complement = firm[one] | firm[two] | (here[one] & here[two])
        linked_to = linked_to | ((F.col("role") == r) & complement)
    up_to_here = in_order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = in_order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    ended = F.max(F.when(F.col("strong"), F.col("end"))).over(up_to_here)
    begins = F.min(F.when(F.col("strong"), F.col("start"))).over(from_here)
    overlaps = F.coalesce(ended > F.col("start"), F.lit(False)) | F.coalesce(
        begins < F.col("end"), F.lit(False)
    )
    reported = F.col("strong") | (linked_to & ~overlaps)
    return scoped.withColumn("reported", F.coalesce(reported, F.lit(False)))


def secret_spans(documents: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: counts of the strong kinds, their digest, and all spans."""
    name = _of_kind(0)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    span = F.struct("start", "kind", label.alias("label"))

    def joined(condition: Column) -> Column:
        spans = F.array_sort(F.collect_list(F.when(condition, span)))
        return F.array_join(F.transform(spans, lambda s: s["label"]), ",")

    def count(kind: str) -> Column:
        return F.count(F.when(name == kind, F.lit(1))).alias(f"n_{kind}")

    return (
        linked(parts(documents), reach)
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            count("assign"),
            count("access"),
            count("hex"),
            F.sha2(joined(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
            joined(F.col("reported")).alias("spans"),
        )
        .drop("row")
    )
