"""Lemma, part of speech and entity class of tokens.

The rules are written as SQL text over a token ``tok``, its lower case ``low`` and its
position ``i``: one long ``CASE`` reads and parses better that way than as hundreds of
nested column calls. Each function takes the SQL of a token array and gives the array
of results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.lexicon import (
    CLOSED_CLASS,
    CLOSED_WORDS,
    ENTITY_WORDS,
    IRREGULAR_LEMMAS,
    NO_ENTITY,
    NOUN_TAGS,
    UNLISTED,
    VERB_TAGS,
)


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _word_list(low: str, table: dict[str, str]) -> str:
    """The key whose word list has the token; null if none has."""
    words = [w for listed in table.values() for w in listed.split()]
    cases = " ".join(f"when {low} in {_in(w.split())} then '{v}'" for v, w in table.items())
    # One hash test settles nearly all tokens; only listed words walk the lists.
    return f"case when {low} in {_in(words)} then case {cases} end end"


def _closed(low: str) -> str:
    return f"{low} in {_in(CLOSED_WORDS)}"


def _plural(low: str) -> str:
    return (
        f"(endswith({low}, 's') and length({low}) >= 4 and not endswith({low}, 'ss') "
        f"and not endswith({low}, 'us') and not endswith({low}, 'is') "
        f"""and not endswith({low}, "'s") and not {_closed(low)})"""
    )


def _drop(low: str, n: int) -> str:
    return f"substring({low}, 1, length({low}) - {n})"


def _lemma(low: str) -> str:
    """Irregular verb forms, possessive ``'s`` and regular plurals; else the token."""
    return f"""coalesce({_word_list(low, IRREGULAR_LEMMAS)}, case
        when endswith({low}, "'s") and length({low}) > 2 then {_drop(low, 2)}
        when not {_plural(low)} then {low}
        when endswith({low}, 'ies') and length({low}) > 4 then concat({_drop(low, 3)}, 'y')
        when endswith({low}, 'sses') or endswith({low}, 'xes') or endswith({low}, 'ches')
          or endswith({low}, 'shes') then {_drop(low, 2)}
        else {_drop(low, 1)} end)"""


def _verbal(low: str) -> str:
    return (
        f"case when endswith({low}, 'ing') and length({low}) > 4 then 'VBG' "
        f"when endswith({low}, 'ed') and length({low}) > 3 then 'VBD' end"
    )


def _name_like(tok: str, i: str) -> str:
    return rf"({i} > 0 and {tok} rlike r'^\p{{Lu}}')"


def _tag(tok: str, low: str, i: str) -> str:
    return rf"""coalesce({_word_list(low, CLOSED_CLASS)},
        case when {low} rlike '^[0-9]+$' then 'CD' end,
        {_verbal(low)},
        case when {_name_like(tok, i)} then 'NNP' when {_plural(low)} then 'NNS'
        when {low} rlike r'\p{{L}}' then 'NN' else '{UNLISTED}' end)"""


def _entity(tok: str, low: str, i: str) -> str:
    return f"""coalesce({_word_list(low, ENTITY_WORDS)}, case
        when {low} rlike '^(19|20)[0-9][0-9]$' then 'DATE'
        when {low} rlike '^[0-9]+$' then 'NUMBER'
        when {_name_like(tok, i)} and not {_closed(low)} and {_verbal(low)} is null
          then 'PERSON'
        else '{NO_ENTITY}' end)"""


def _with_low(toks: str) -> str:
    return f"transform({toks}, t -> struct(t as tok, lower(t) as low))"


def lemma_sql(toks: str) -> str:
    return f"transform(transform({toks}, t -> lower(t)), low -> {_lemma('low')})"


def tag_sql(toks: str) -> str:
    """``UNLISTED`` for whatever no rule names."""
    return f"transform({_with_low(toks)}, (x, i) -> {_tag('x.tok', 'x.low', 'i')})"


def entity_sql(toks: str) -> str:
    """Names of places and bodies come from a lexicon table only."""
    return f"transform({_with_low(toks)}, (x, i) -> {_entity('x.tok', 'x.low', 'i')})"


def lemma_of(tok: str) -> Column:
    """The lemma of a single token, as ``lemma_array`` gives it."""
    return F.expr(_lemma(f"lower({tok})"))


def lemma_array(toks: str) -> Column:
    return F.expr(lemma_sql(toks))


def tag_array(toks: str) -> Column:
    return F.expr(tag_sql(toks))


def entity_array(toks: str) -> Column:
    return F.expr(entity_sql(toks))


def is_noun(tag: Column) -> Column:
    return tag.isin(*NOUN_TAGS)


def is_verb(tag: Column) -> Column:
    return tag.isin(*VERB_TAGS)


def is_content(tag: Column) -> Column:
    """Nouns and verbs: the tokens a question is searched by."""
    return tag.isin(*NOUN_TAGS, *VERB_TAGS)
