"""Hand-worked cases of the column expressions."""

import math

import pytest
from pyspark.sql import functions as F

from quillon.functions.answers import found_answer, question_type
from quillon.functions.arrays import counted
from quillon.functions.lexicon import (
    CLOSED_CLASS,
    CLOSED_WORDS,
    ENTITY_CLASSES,
    PART_OF_SPEECH_TAGS,
)
from quillon.operators import numbering, scoring, segment
from quillon.plans.answering import Search


def cells(text):
    """``tok/LABEL ...`` -> tokens and labels ('' without one)."""
    parts = [p.rsplit("/", 1) if "/" in p else [p, ""] for p in text.split()]
    return [p[0] for p in parts], [p[1] for p in parts]


@pytest.mark.parametrize(
    ("tagged", "kind"),
    [
        ("Who/WP wrote it ?", "WHO"),
        ("How/WRB and why/WRB does it work ?", "WHY"),
        ("How/WRB are you ?", "UNKNOWN"),
        ("Which/WDT module is this ?", "UNKNOWN"),
        ("", "UNKNOWN"),
    ],
)
def test_question_type(frame, tagged, kind):
    toks, tags = cells(tagged)
    row = frame([([t.lower() for t in toks], tags)], "lemmas array<string>, tags array<string>")
    assert row.select(question_type(F.col("lemmas"), F.col("tags"))).first()[0] == kind


SPANS = [
    # type, sentence (label: a tag, an entity class or a lemma), default, legacy
    (
        "WHY",
        "It fails because/IN the index is bad .",
        "because the index is bad .",
        "because the index is bad .",
    ),
    ("WHY", "It fails because/IN why because/IN so", "because so", "because so"),
    ("WHY", "It fails often .", None, None),
    ("WHO", "Ada/PERSON met Bob/PERSON .", "Ada met Bob", "Ada met"),
    ("WHO", "Ada/PERSON left .", "Ada", ""),
    ("WHEN", "It began in 1999/DATE .", "1999", ""),
    ("WHERE", "It lives here .", None, None),
    ("WHERE", "It lives in Rome/LOCATION .", "Rome", ""),
    ("WHAT", "A slice is/be a segment .", "a segment .", "a segment"),
    ("WHAT", "It is/be what it is/be", None, None),
    ("WHAT", "Ada/PERSON is/be here", "Ada", ""),
    ("WHO", "It is/be here", None, None),
    ("UNKNOWN", "Ada/PERSON is/be here because/IN", None, None),
]


@pytest.mark.parametrize(("kind", "sentence", "default", "legacy"), SPANS)
def test_answer_span(frame, kind, sentence, default, legacy):
    toks, labels = cells(sentence)
    lemmas = ["be" if m == "be" else t.lower() for t, m in zip(toks, labels, strict=True)]
    row = frame(
        [(kind, toks, lemmas, labels, labels)],
        "type string, toks array<string>, lemmas array<string>, tags array<string>, "
        "ents array<string>",
    )
    columns = [F.col(c) for c in ("type", "toks", "lemmas", "tags", "ents")]
    got = row.select(found_answer(*columns), found_answer(*columns, legacy_span=True)).first()
    assert tuple(got) == (default, legacy)


def test_fixed_lists_are_consistent():
    assert set(CLOSED_CLASS) <= set(PART_OF_SPEECH_TAGS)
    assert len(PART_OF_SPEECH_TAGS) == 36 and len(ENTITY_CLASSES) == 12
    assert len(CLOSED_WORDS) == len(set(CLOSED_WORDS))


def test_sentences_and_tokens(frame):
    text = "One two. \n  ... Three!? It's 2021"
    docs = frame([(7, text), (8, " "), (9, None), (10, "")], "doc_id bigint, text string")
    rows = segment.annotate(docs).orderBy("doc_id", "sent_no").collect()
    assert [r.doc_id for r in rows] == [7, 7, 7, 7]
    assert [r.sent for r in rows] == ["One two.", "...", "Three!?", "It's 2021"]
    # The blank piece before the line break has number 1 and is dropped.
    assert [r.sent_no for r in rows] == [0, 2, 3, 4]
    assert [r.doc_sents for r in rows] == [4, 0, 0, 0]
    assert rows[3].toks == ["It's", "2021"] and rows[3].lemmas == ["it", "2021"]
    assert rows[3].ents == ["NONE", "DATE"]


@pytest.mark.parametrize(
    ("token", "lemma", "tag", "entity"),
    [
        ("were", "be", "VBD", "NONE"),
        ("stories", "story", "NNS", "NONE"),
        ("boxes", "box", "NNS", "NONE"),
        ("class", "class", "NN", "NONE"),
        ("strings", "string", "NNS", "NONE"),
        ("dog's", "dog", "NN", "NONE"),
        ("using", "using", "VBG", "NONE"),
        ("used", "used", "VBD", "NONE"),
        ("Ada", "ada", "NNP", "PERSON"),
        ("Monday", "monday", "NNP", "DATE"),
        ("1850", "1850", "CD", "NUMBER"),
        ("2050", "2050", "CD", "DATE"),
        ("%", "%", "UNLISTED", "NONE"),
    ],
)
def test_tagging(frame, token, lemma, tag, entity):
    docs = frame([(1, f"x {token}")], "doc_id bigint, text string")
    row = segment.annotate(docs).first()
    assert (row.lemmas[1], row.tags[1], row.ents[1]) == (lemma, tag, entity)


def test_counted(frame):
    table = frame([(["b", "a", "b"],), ([],)], "v array<string>")
    got = table.select(counted(F.col("v"), "key", "n").alias("c")).collect()
    assert [(c.key, c.n) for c in got[0].c] == [("a", 1), ("b", 2)]
    assert got[1].c == []


def test_initial_index(frame):
    lemmas = ["one", "line", ",", "two", "line", "twin", "trio"]
    table = frame([(lemmas,)], "lemmas array<string>")
    got = {(r.initial, r.page): r.lemmas for r in numbering.initial_index(table, 2).collect()}
    assert got == {
        ("L", 0): ["line"],
        ("O", 0): ["one"],
        ("T", 0): ["trio", "twin"],
        ("T", 1): ["two"],
    }


def test_worked_scores(frame):
    text = "stack hold value\nqueue hold item\nstack be adt stack"
    docs = frame([(1, text)], "doc_id bigint, text string")
    features = frame(
        [(5, 0, "stack", 2), (5, 0, "be", 1), (5, 1, "be adt", 1), (5, 1, "adt stack", 1)],
        "q_id bigint, kind int, key string, nq bigint",
    )
    sentences = segment.annotate(docs)
    matches = scoring.matching_features(sentences, scoring.wanted_features(features), True)
    weights, size = scoring.feature_weights(matches), scoring.sentence_count(matches)
    search = Search(None, features, matches, weights, size, True)

    def by_sentence(scored):
        return {r.sent_no: r.score for r in scoring.shown(scored).collect()}

    plain = by_sentence(search.scores(use_bigrams=False))
    assert plain == pytest.approx({0: 0.575364, 2: 1.843875}, abs=1e-6)
    boosted = search.scores()
    assert by_sentence(boosted) == pytest.approx({0: 0.575364, 2: 3.116150}, abs=2e-6)
    asked = frame([(5, 1)], "q_id bigint, topic int")
    of_sentence = frame([(1, 2, 1), (1, 0, -1)], "doc_id bigint, sent_no int, topic int")
    got = by_sentence(scoring.boost_topics(boosted, asked, of_sentence))
    assert got[0] == plain[0] and got[2] == pytest.approx(3.895187, abs=2e-6)
    none = frame([(5, -1)], "q_id bigint, topic int")
    assert by_sentence(scoring.boost_topics(boosted, none, of_sentence))[0] == plain[0]
    top = scoring.top_elements(boosted, 5, ["doc_id", "sent_no"]).collect()
    assert [(r.rank, r.sent_no) for r in sorted(top, key=lambda r: r.rank)] == [(1, 2), (2, 0)]


def test_one_rank_rule_at_every_size(frame):
    unit = scoring.IDF_UNITS
    rows = [
        (1, 10_000_000 * unit, 0, 0),
        (2, 10_000_000 * unit + unit // 10, 0, 0),
        (3, 300, 0, 0),
        (4, 400, 0, 0),
        (5, unit, 3000, 0),
        (6, unit, 3000, 1),
        (7, unit + 1, 3000, 1),
        (8, unit, 3001, 0),
    ]
    scored = frame(
        [(0, *row) for row in rows],
        "q_id bigint, doc_id bigint, base bigint, shared bigint, boosted int",
    )
    top = scoring.top_elements(scored, 8, ["doc_id"]).orderBy("rank").collect()
    assert [r.doc_id for r in top] == [8, 7, 6, 5, 2, 1, 4, 3]
    shown = {r.doc_id: r.score for r in top}
    assert shown[6] == shown[8] == float("inf")
    assert shown[1] == pytest.approx(1e7, rel=1e-7) and shown[4] == pytest.approx(4e-7, rel=1e-7)


def test_leading_punctuation_is_kept(frame):
    docs = frame([(1, "!!! Wow"), (2, "..."), (3, "a.\n?! b")], "doc_id bigint, text string")
    rows = segment.annotate(docs).orderBy("doc_id", "sent_no").collect()
    assert [r.sent for r in rows] == ["!!!", "Wow", "...", "a.", "?!", "b"]


def test_documents_without_text_count(frame):
    from quillon.operators import tfidf
    from quillon.plans.answering import document_first

    rows = [(1, "stack hold"), (2, "stack queue. list"), (3, "queue"), (4, ""), (5, None)]
    docs = frame(rows, "doc_id bigint, text string")
    idf = {r.lemma: r.idf for r in tfidf.idf(tfidf.document_lemmas(docs)).collect()}
    assert idf["stack"] == pytest.approx(math.log(6 / 3))
    asked = frame([(1, "stack list")], "q_id bigint, text string")
    found = document_first(asked, docs, n_documents=1).collect()
    assert {r.doc_id for r in found} == {2}
