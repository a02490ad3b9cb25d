"""Question type and answer span, as column expressions on token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.arrays import bind

# Answer quality levels. Extraction only ever assigns the two ends.
QUALITY = {"very_high": 1.0, "high": 0.75, "medium": 0.5, "low": 0.25, "very_low": 0.0}

# Wh-lemmas that give a question its type.
WH_LEMMAS = ("who", "what", "when", "where", "why")

# Entity classes that answer each question type.
ENTITY_TARGETS = {
    "WHO": ("PERSON", "ORGANIZATION"),
    "WHAT": ("PERSON", "ORGANIZATION"),
    "WHEN": ("DATE", "TIME"),
    "WHERE": ("LOCATION",),
}


def question_type(lemmas: Column, tags: Column) -> Column:
    """WHO .. WHY from the first WP or WRB token with such a lemma, else UNKNOWN."""
    wh = F.filter(
        F.arrays_zip(lemmas.alias("lemma"), tags.alias("tag")),
        lambda t: t["tag"].isin("WP", "WRB") & F.lower(t["lemma"]).isin(*WH_LEMMAS),
    )
    return F.coalesce(F.upper(F.get(wh, F.lit(0))["lemma"]), F.lit("UNKNOWN"))


def _positions(values: Column, test) -> Column:
    """0-based positions of the elements that pass ``test``."""
    marks = F.transform(values, lambda v, i: F.when(test(v), i))
    return F.filter(marks, lambda i: i.isNotNull())


def _span(tokens: Column, start: Column, end: Column) -> Column:
    """Tokens ``start .. end`` (both included), joined by one blank."""
    return F.array_join(
        F.slice(tokens, start + 1, F.greatest(end - start + 1, F.lit(0))), " "
    )


def because_answer(toks: Column, lemmas: Column, tags: Column) -> Column:
    """WHY: from the last subordinating "because" to the end; null if there is none."""
    pairs = F.arrays_zip(lemmas.alias("lemma"), tags.alias("tag"))
    hits = _positions(
        pairs, lambda p: (p["tag"] == "IN") & (F.lower(p["lemma"]) == "because")
    )
    start = F.array_max(hits)
    return F.when(start.isNotNull(), _span(toks, start, F.size(toks) - 1))


def entity_answer(
    toks: Column, ents: Column, classes: Column, legacy_span: bool = False
) -> Column:
    """From the first to the last token of the given classes, gaps included.

    ``legacy_span`` leaves out the last token of the span.
    """
    short = 1 if legacy_span else 0
    return bind(
        _positions(ents, lambda e: F.array_contains(classes, e)),
        lambda hits: F.when(
            F.size(hits) > 0,
            _span(toks, F.array_min(hits), F.array_max(hits) - short),
        ),
    )


def definition_answer(toks: Column, lemmas: Column, legacy_span: bool = False) -> Column:
    """WHAT fallback: what follows the last ":" or "be"; null if that ends the sentence."""
    short = 1 if legacy_span else 0
    last = F.array_max(_positions(lemmas, lambda v: v.isin(":", "be")))
    return F.when(
        last < F.size(toks) - 1, _span(toks, last + 1, F.size(toks) - 1 - short)
    )


def entity_targets(kind: Column) -> Column:
    """Entity classes that answer a question type; null for WHY and UNKNOWN."""
    rule = None
    for name, classes in ENTITY_TARGETS.items():
        value = F.array(*[F.lit(c) for c in classes])
        hit = kind == name
        rule = F.when(hit, value) if rule is None else rule.when(hit, value)
    return rule


def found_answer(
    kind: Column,
    toks: Column,
    lemmas: Column,
    tags: Column,
    ents: Column,
    legacy_span: bool = False,
) -> Column:
    """The extracted answer text, or null when the whole sentence is the answer."""
    by_entity = entity_answer(toks, ents, entity_targets(kind), legacy_span)
    return F.when(kind == "WHY", because_answer(toks, lemmas, tags)).otherwise(
        F.coalesce(
            by_entity,
            F.when(kind == "WHAT", definition_answer(toks, lemmas, legacy_span)),
        )
    )


def quality_of(found: Column) -> Column:
    return F.when(found.isNotNull(), F.lit(QUALITY["very_high"])).otherwise(
        F.lit(QUALITY["very_low"])
    )


def rendered_answer(quality: Column, answer: Column) -> Column:
    """``(quality) answer``"""
    return F.concat(F.lit("("), quality.cast("string"), F.lit(") "), answer)
