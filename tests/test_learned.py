"""Lemmas and sentence ends learned from a corpus."""

import pytest
from pyspark.sql import functions as F

from quillon.operators import boundaries, joins, lemmas, numbering, phrases, segment
from quillon.plans.answering import answer_questions
from quillon.plans.prepared import answer_from_version
from quillon.sources import versions

DOCS = "doc_id bigint, text string"
TEXT = (
    "They run and are running now. We use what was used before. Please stop, he stopped it. "
    "A red thing is a thing. Being here is fun. The goes go far. To design is fun, she designed "
    "a design while designing. He boxes a box. A faster fast car is fast. A number is numb. Number."
)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(1, TEXT)], DOCS)


def _table(frame):
    return {r.surface: r.lemma for r in frame.collect()}


def test_stems_of_the_corpus_are_found(corpus):
    found = _table(lemmas.lemma_table(segment.annotate(corpus)))
    assert found == {
        "running": "run", "used": "use", "stopped": "stop", "goes": "go", "designed": "design",
        "designing": "design", "boxes": "box", "faster": "fast",
    }


def test_words_of_the_questions_are_looked_up_too(spark, corpus):
    asked = segment.annotate_questions(spark.createDataFrame([(1, "Who stops Stopping uses?")], "q_id bigint, text string"))
    assert _table(lemmas.lemma_table(segment.annotate(corpus), asked))["Stopping"] == "stop"


@pytest.mark.parametrize("words", [0, 500])
def test_a_learned_lexicon_answers_verb_questions(spark, corpus, monkeypatch, words):
    monkeypatch.setattr(segment, "MAX_MAPPED_WORDS", words)
    questions = spark.createDataFrame([(1, "What is designing?")], "q_id bigint, text string")
    asked = segment.annotate_questions(questions)
    lexicon = lemmas.lemma_table(segment.annotate(corpus), asked).drop("n_stem")
    plain = answer_questions(questions, corpus, k=1).first()
    learned = answer_questions(questions, corpus, k=1, lexicon=lexicon).first()
    assert learned.score > plain.score and learned.sent_no == plain.sent_no


def test_no_words_no_lemmas(spark):
    assert lemmas.lemma_table(segment.annotate(spark.createDataFrame([], DOCS))).count() == 0
    assert lemmas.lemma_table(segment.annotate(spark.createDataFrame([(1, None), (2, "")], DOCS))).count() == 0


PROSE = (
    "Dr. Smith met Mr. Jones. They saw Dr. No and J. Bond, etc. at noon. Pi is 3.14 or so. "
    "Visit example.com today. He left.\nMr. Jones stayed, e.g. here. Did Dr. Smith? Yes! Mr. Jones, etc. went"
    " and Mr. No. too, e.g. there, etc. or e.g. so on."
)


def _sentences(spark, text):
    documents = spark.createDataFrame([(1, text)], DOCS)
    known = boundaries.abbreviations(spark.createDataFrame([(1, PROSE)], DOCS))
    rows = segment.split_sentences(documents, abbreviations=known).orderBy("sent_no").collect()
    assert [r.doc_sents for r in rows] == [len(rows), *[0] * (len(rows) - 1)][: len(rows)]
    return [r.sent for r in rows]


def test_abbreviations_are_learned(spark):
    found = {r.word: (r.dot, r.plain) for r in boundaries.abbreviations(spark.createDataFrame([(1, PROSE)], DOCS)).collect()}
    assert found == {"dr": (3, 0), "mr": (4, 0), "e.g": (3, 0)}
    assert boundaries.abbreviations(spark.createDataFrame([], DOCS)).count() == 0
    assert boundaries.abbreviations(spark.createDataFrame([(1, "no period")], DOCS)).count() == 0


def test_sentence_ends(spark):
    assert _sentences(spark, "Dr. Smith met J. Bond. Pi is 3.14 or so. See example.com now. He left.\nMr. Jones stayed.") == [
        "Dr. Smith met J. Bond.", "Pi is 3.14 or so.", "See example.com now.", "He left.", "Mr. Jones stayed.",
    ]
    assert _sentences(spark, "It is, e.g. this. Why? Ask Mr.\nJones!") == ["It is, e.g. this.", "Why?", "Ask Mr.", "Jones!"]
    assert _sentences(spark, "") == _sentences(spark, " \n ") == []
    assert _sentences(spark, "...") == ["..."]


def test_a_store_keeps_learned_sentences(spark, tmp_path):
    documents = spark.createDataFrame([(1, PROSE)], DOCS)
    known = boundaries.abbreviations(documents)
    version = versions.prepare(documents, str(tmp_path), buckets=2, abbreviations=known)
    assert "Dr. Smith met Mr. Jones." in [r.sent for r in version.sentences.collect()]


def test_helper_columns_clash_with_no_caller(spark):
    rows = spark.createDataFrame([(i, i % 3, 7, 8, 9) for i in range(20)], "k bigint, salt bigint, place int, part int, offset int")
    numbered = numbering.numbered(rows, [F.asc("k")], "n")
    assert numbered.columns == [*rows.columns, "n"]
    assert {(r.salt, r.place, r.part, r.offset) for r in numbered.collect()} == {(s, 7, 8, 9) for s in range(3)}
    side = spark.createDataFrame([(i, i) for i in range(10)], "k bigint, v bigint")
    joined = joins.lookup_join(rows, side, ["k"], "inner", [F.col("place")], small=False)
    assert joined.columns == [*rows.columns, "v"]
    assert {(r.k, r.salt) for r in joined.collect()} == {(i, i % 3) for i in range(10)}


PHRASES = [
    ("New York", "LOCATION"), ("New York Times", "ORGANIZATION"), ("York Times Square", "LOCATION"),
    ("the United Nations", "ORGANIZATION"), ("Rio de Janeiro", "LOCATION"), ("Oslo", "LOCATION"),
    ("New York", "PERSON"), ("", "MISC"), (None, "MISC"), ("a a", "MISC"), ("Lima", None),
]


def _phrased(spark, text):
    words = spark.createDataFrame(PHRASES, "phrase string, nec string")
    annotated = segment.annotate(spark.createDataFrame([(1, text), (2, None), (3, "Nothing here.")], DOCS))
    rows = phrases.with_phrases(annotated, words, ["doc_id", "sent_no"])
    assert rows.columns == annotated.columns and rows.count() == annotated.count()
    tokens = segment.explode_tokens(rows, ["doc_id", "sent_no"], ("tok", "nec", "pos"))
    return [(r.tok, r.nec) for r in tokens.where("doc_id = 1 and nec not in ('NONE', 'PERSON')").orderBy("sent_no", "pos_no").collect()]


@pytest.mark.parametrize("large", [False, True])
def test_phrases_are_leftmost_and_longest(spark, monkeypatch, large):
    if large:
        monkeypatch.setattr("quillon.operators.joins.MAX_BROADCAST_ROWS", 0)
    text = "He saw New York Times Square. In New York, in Oslo. The a a a a list of the United Nations."
    assert _phrased(spark, text) == [
        ("New", "ORGANIZATION"), ("York", "ORGANIZATION"), ("Times", "ORGANIZATION"),
        ("New", "LOCATION"), ("York", "LOCATION"), ("Oslo", "LOCATION"),
        *[("a", "MISC")] * 4,
        ("the", "ORGANIZATION"), ("United", "ORGANIZATION"), ("Nations", "ORGANIZATION"),
    ]


def test_a_where_answer_spans_the_whole_name(spark, tmp_path):
    rows = [(1, "The carnival is held in Rio de Janeiro each year."), (2, "Another text.")]
    documents = spark.createDataFrame(rows, DOCS)
    questions = spark.createDataFrame([(1, "Where is the carnival held?")], "q_id bigint, text string")
    words = spark.createDataFrame(PHRASES, "phrase string, nec string")
    assert answer_questions(questions, documents, k=1, phrases=words).first().answer == "Rio de Janeiro"
    version = versions.prepare(documents, str(tmp_path), buckets=2, phrases=words)
    assert answer_from_version(questions, version).first().answer == "Rio de Janeiro"


@pytest.mark.parametrize("joined", [False, True])
def test_a_phrase_table_that_tasks_can_keep_shuffles_nothing(spark, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(phrases, "can_be_held", lambda side: False)
    text = "He saw New York Times Square. In New York, in Oslo. The a a a a list of the United Nations."
    annotated = segment.annotate(spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Of the United")], DOCS))
    names = spark.createDataFrame(PHRASES, "phrase string, nec string")
    found = phrases.with_phrases(annotated, names, ["doc_id", "sent_no"])
    rows = {(r.doc_id, r.sent_no): (r.ents, r.tags) for r in found.collect()}
    assert rows[1, 2][0] == ["NONE", *["MISC"] * 4, "NONE", "NONE", *["ORGANIZATION"] * 3, "NONE"]
    assert rows[1, 2][1][1:5] == ["NNP"] * 4 and "ORGANIZATION" not in rows[4, 0][0]
    if not joined:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("joined", [False, True])
def test_a_lexicon_of_many_words_shuffles_nothing(spark, corpus, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(segment, "can_be_held", lambda side: False)
    many = [(f"w{i}", "x", None, None) for i in range(600)]
    own = [("running", "motor", None, None), ("running", "motors", "VB", None), ("now", None, None, "PERSON")]
    lexicon = spark.createDataFrame(many + own, "surface string, lemma string, pos string, nec string")
    documents = corpus.union(spark.createDataFrame([(7, None), (8, ""), (9, " ... ")], DOCS))
    found = segment.annotate(documents, lexicon)
    few = segment.annotate(documents, lexicon.where("lemma is null or lemma <> 'x'"))
    assert sorted(found.collect()) == sorted(few.collect())
    assert "motor" in [w for r in found.collect() for w in r.lemmas]
    if not joined:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
