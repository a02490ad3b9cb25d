"""

``documents`` is the corpus, ``benchmark`` the questions (each passage behind a
question word), ``conversations`` a second set of questions, ``documents.source``
the topic of a text and ``embeddings`` the word vectors of the most frequent words.
"""

from __future__ import annotations

import importlib
import warnings
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from quillon.functions.answers import (
    because_answer,
    definition_answer,
    entity_answer,
    entity_targets,
    quality_of,
)
from quillon.functions.lexicon import STOP_WORDS
from quillon.functions.text import sentence_array
from quillon.operators import lemmas as lemma_rules
from quillon.operators import (
    answering,
    boundaries,
    cooccurrence,
    joins,
    models,
    numbering,
    phrases,
    pivots,
    postings,
    scoring,
    segment,
    tfidf,
    topic_model,
    topics,
    vectors,
    word_model,
)
from quillon.plans.answering import Search, answer_questions, document_first
from quillon.plans.prepared import (
    answer_from_store,
    answer_from_version,
    document_first_from_version,
)
from quillon.session import scratch_path, settled, stored
from quillon.sources import reports, versions
from quillon.sources.store import prepare_store, read_store
from quillon.sources.tables import read_documents
from quillon.streaming.questions import (
    TIMED_SCHEMA,
    answer_stream,
    answer_version_stream,
    once_within,
    read_question_stream,
)

SENTENCE, DOCUMENT = tfidf.SENTENCE, tfidf.DOCUMENT
# Question words, by item number.
QUESTION_WORDS = ("who", "what", "when", "where", "why", "how")
# When the first questions of a timed stream are asked, in seconds.
DAY_ONE = 1_700_000_000
# Words of the given documents as a lexicon: lemma, part of speech, entity class.
LEXICON = {
    "nd": ("Nd", "NNP", "LOCATION"),
    "th": (None, "NNP", "LOCATION"),
    "ing": ("Ing", "NNP", "ORGANIZATION"),
    "Ing": ("Ing", "NNP", "ORGANIZATION"),
    "en": (None, None, "PERSON"),
}

# Runs of words of the given documents as names.
PHRASES = {
    "of the": "LOCATION",
    "of the the": "ORGANIZATION",
    "the the": "MISC",
    "de la": "PERSON",
    "in der": "LOCATION",
    "that the of": "ORGANIZATION",
    "is": "TIME",
}


# --- inputs -----------------------------------------------------------------


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    cores = spark.sparkContext.defaultParallelism
    return read_documents(spark, f"{sf}/documents.parquet", cores)


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    return segment.annotate(_documents(spark, sf))


def _tokens(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    return segment.explode_tokens(_sentences(spark, sf), SENTENCE, fields)


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array(*[F.lit(w) for w in QUESTION_WORDS])
    word = F.get(words, (F.col("item_id") % len(QUESTION_WORDS)).cast("int"))
    return spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("q_id"), F.concat(word, F.lit(" "), F.col("text")).alias("text")
    )


def _conversation_questions(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'user'")
    order = [F.asc("conv_id"), F.asc("turn")]
    return numbering.numbered(turns.select("conv_id", "turn", "text"), order, "q_id").select(
        "q_id", "text"
    )


def _asked(spark: SparkSession, sf: str) -> DataFrame:
    return segment.annotate_questions(_questions(spark, sf))


def _stop_words(spark: SparkSession) -> DataFrame:
    return topics.stop_word_frame(spark, STOP_WORDS)


def _topical(spark: SparkSession, sf: str) -> DataFrame:
    return topics.topical_sentences(_sentences(spark, sf), STOP_WORDS)


def _words_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """How often each topical lemma occurs in each source."""
    number = F.expr("substring(source, 4)").cast("int")
    documents = _documents(spark, sf).withColumn("topic", number)
    topical = topics.topical_sentences(
        segment.annotate(documents, carry=("topic",)), STOP_WORDS
    )
    return topics.words_by_topic(segment.explode_lemmas(topical, "topic"))


def _topic_words(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 most frequent topical lemmas of each source."""
    return topics.topic_top_words(_words_by_source(spark, sf))


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return topics.vocabulary(segment.explode_lemmas(_topical(spark, sf)))


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector")
    )


def _synonyms(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest words of the target terms; vector ``i`` belongs to word ``i``."""
    words = _vocabulary(spark, sf).join(
        _embeddings(spark, sf), F.col("term_id") == F.col("vec_id")
    )
    found = vectors.synonyms_from(scoring.target_terms(_asked(spark, sf)), words)
    return settled(found)


# --- sources and sinks ------------------------------------------------------


def corpus_scan(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")


def prepared_roundtrip(spark, sf):
    path = scratch_path(spark, "store")
    prepare_store(_documents(spark, sf), path, buckets=8)
    features = read_store(spark, path).features
    return features.select("doc_id", "sent_no", "kind", "key", "n")


def prepared_tables(spark, sf):
    """Every table of a prepared segment that no fit can vary, as rows of one shape."""
    version = versions.prepare(_documents(spark, sf), scratch_path(spark, "store"), buckets=8)
    absent = {"doc_id": -1, "sent_no": -1, "kind": -1, "key": "", "n": 0}

    def rows(name: str, table: DataFrame) -> DataFrame:
        kinds = dict(doc_id="bigint", sent_no="int", kind="int", key="string", n="bigint")
        cells = [
            (F.col(c) if c in table.columns else F.lit(absent[c])).cast(kind).alias(c)
            for c, kind in kinds.items()
        ]
        return table.select(F.lit(name).alias("name"), *cells)

    weights = version.weights()
    parts = [
        rows("documents", version.documents.withColumnRenamed("n_sents", "n")),
        rows("sentences", version.sentences.select("doc_id", "sent_no", F.size("toks").alias("n"))),
        rows("features", version.features),
        rows("doc_features", version.doc_features),
        rows("weights", weights.withColumnRenamed("df", "n")),
    ]
    return reduce(DataFrame.unionByName, parts)


def topic_report(spark, sf):
    return reports.topic_lines(topics.ranked_topic_words(_words_by_source(spark, sf)))


def doc_view(spark, sf):
    # A document has a TF-IDF vector exactly when it has a sentence, as each has a token.
    documents = _documents(spark, sf)
    return reports.document_view(documents, F.size(sentence_array(F.col("text"))) > 0)


def initial_index(spark, sf):
    index = numbering.initial_index(_sentences(spark, sf))
    return index.select("initial", "page", F.array_join("lemmas", " ").alias("lemmas"))


# --- annotation -------------------------------------------------------------


def sentences(spark, sf):
    return _sentences(spark, sf).select(*SENTENCE, "sent")


def tokens(spark, sf):
    return _tokens(spark, sf, "tok")


def lemmas(spark, sf):
    return _tokens(spark, sf, "lemma")


def pos_tags(spark, sf):
    return _tokens(spark, sf, "pos")


def entity_tags(spark, sf):
    return _tokens(spark, sf, "nec")


def _lexicon(spark: SparkSession) -> DataFrame:
    rows = [(word, *rest) for word, rest in LEXICON.items()]
    return spark.createDataFrame(rows, "surface string, lemma string, pos string, nec string")


def lexicon_tags(spark, sf):
    annotated = segment.annotate(_documents(spark, sf), _lexicon(spark))
    return segment.explode_tokens(annotated, SENTENCE)


def lemma_table(spark, sf):
    found = lemma_rules.lemma_table(_sentences(spark, sf), _asked(spark, sf))
    return found.select("surface", "lemma", "n_stem")


def lemmas_learned(spark, sf):
    table = settled(lemma_rules.lemma_table(_sentences(spark, sf)))
    annotated = segment.annotate(_documents(spark, sf), table.drop("n_stem"))
    return segment.explode_tokens(annotated, SENTENCE, ("tok", "lemma"))


def qa_lemmas(spark, sf):
    """Answers with learned lemmas on both sides: "designed" finds "designing"."""
    table = lemma_rules.lemma_table(_sentences(spark, sf), _asked(spark, sf))
    lexicon = settled(table.drop("n_stem"))
    return answer_questions(_questions(spark, sf), _documents(spark, sf), lexicon=lexicon)


def abbreviations(spark, sf):
    found = boundaries.abbreviations(_documents(spark, sf))
    return found.select("word", "dot", "plain", F.round("weight", 6).alias("weight"))


def sentences_learned(spark, sf):
    documents = _documents(spark, sf)
    known = settled(boundaries.abbreviations(documents).select("word"))
    return segment.split_sentences(documents, abbreviations=known).select(*SENTENCE, "sent")


def _phrases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PHRASES.items()), "phrase string, nec string")


def phrase_tags(spark, sf):
    named = phrases.with_phrases(_sentences(spark, sf), _phrases(spark), SENTENCE)
    return segment.explode_tokens(named, SENTENCE, ("tok", "pos", "nec"))


def answers_phrases(spark, sf):
    """Answers where names of several words are known."""
    return answer_questions(
        _questions(spark, sf), _documents(spark, sf), phrases=_phrases(spark)
    )


def content_tokens(spark, sf):
    return segment.content_tokens(_tokens(spark, sf, "lemma", "pos"))


def bigrams(spark, sf):
    return segment.bigrams(_sentences(spark, sf), SENTENCE)


def question_tokens(spark, sf):
    return segment.explode_tokens(_asked(spark, sf), ["q_id"])


def question_bigrams(spark, sf):
    return segment.bigrams(_asked(spark, sf), ["q_id"])


def lemma_match(spark, sf):
    asked = segment.explode_tokens(_asked(spark, sf), ["q_id"], ("lemma",))
    return segment.lemma_matches(asked, _sentences(spark, sf)).select(
        "q_id", "pos_no", "lemma", "n_matches"
    )


# --- TF-IDF -----------------------------------------------------------------


def term_freq(spark, sf):
    return tfidf.term_freq(_sentences(spark, sf), SENTENCE)


def _rounded_idf(weights: DataFrame) -> DataFrame:
    return weights.select("lemma", "df", F.round("idf", 6).alias("idf"))


def idf_sentence(spark, sf):
    return _rounded_idf(tfidf.idf(_sentences(spark, sf)))


def idf_document(spark, sf):
    return _rounded_idf(tfidf.idf(tfidf.document_lemmas(_documents(spark, sf))))


def _weighted(elements: DataFrame, keys: list[str]) -> DataFrame:
    return tfidf.tfidf(tfidf.term_freq(elements, keys), tfidf.idf(elements), keys)


def _rounded_tfidf(weighted: DataFrame, keys: list[str]) -> DataFrame:
    return weighted.select(*keys, "lemma", "tf", F.round("tfidf", 6).alias("tfidf"))


def tfidf_sentence(spark, sf):
    return _rounded_tfidf(_weighted(_sentences(spark, sf), SENTENCE), SENTENCE)


def tfidf_document(spark, sf):
    elements = tfidf.document_lemmas(_documents(spark, sf))
    return _rounded_tfidf(_weighted(elements, DOCUMENT), DOCUMENT)


def tfidf_vectors(spark, sf):
    elements = _sentences(spark, sf)
    vectors = tfidf.vectors_in_place(elements, tfidf.idf(elements), SENTENCE, ruled=True)
    cell = "concat(x.lemma, ':', cast(cast(round(x.tfidf, 6) as decimal(18, 6)) as string))"
    return vectors.select(
        *SENTENCE, F.expr(f"array_join(transform(vector, x -> {cell}), ' ')").alias("vector")
    )


def hashed_tf(spark, sf):
    """What does not depend on the hash: the counts of a sentence add up to its tokens."""
    rows = _sentences(spark, sf).select(*SENTENCE, "lemmas")
    hashed = models.fit_hashed_tfidf(rows).transform(rows)
    total = F.aggregate(models.sparse_cells("tf"), F.lit(0.0), lambda s, c: s + c["value"])
    return hashed.select(*SENTENCE, total.cast("bigint").alias("n_tokens"))


def tfidf_ml(spark, sf):
    rows = _sentences(spark, sf).select(*SENTENCE, "lemmas")
    words = settled(segment.explode_lemmas(rows).distinct())
    model = models.fit_tfidf(rows, words.count())
    names = models.term_places(model, words)
    cells = model.transform(rows).select(*SENTENCE, F.explode(models.sparse_cells("tfidf")).alias("c"))
    weighted = cells.select(*SENTENCE, "c.place", F.round("c.value", 6).alias("tfidf"))
    named = joins.lookup_join(weighted, names, ["place"], spread_by=[F.col("doc_id"), F.col("sent_no")])
    return named.select(*SENTENCE, "lemma", "tfidf")


# --- word vectors -----------------------------------------------------------


def word2vec_vectors(spark, sf):
    """What a fit cannot vary: the words that have a vector, and its size."""
    vectors = word_model.fit_word_vectors(_sentences(spark, sf))
    return vectors.select("term", F.size("vector").alias("size"))


def cooccurrences(spark, sf):
    return cooccurrence.cooccurrences(_sentences(spark, sf), ruled=True)


def word_information(spark, sf):
    return cooccurrence.positive_information(cooccurrences(spark, sf))


def information_vectors(spark, sf):
    """Which words have a vector, its size, and that its numbers are finite."""
    found = cooccurrence.information_vectors(word_information(spark, sf))
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return found.select("term", F.size("vector").alias("size"), finite.alias("finite"))


def nearest_vectors(spark, sf):
    table = _embeddings(spark, sf).withColumnRenamed("vec_id", "name")
    near = vectors.nearest_vectors(table, table)
    return near.select(F.col("term").alias("vec_id"), "rank", "neighbour", "similarity")


def nearest_pivots(spark, sf):
    """The same rows as ``nearest_vectors``, in cells around pivots."""
    table = _embeddings(spark, sf).withColumnRenamed("vec_id", "name")
    near = pivots.nearest_by_pivots(table, table)
    return near.select(F.col("term").alias("vec_id"), "rank", "neighbour", "similarity")


def expanded_terms(spark, sf):
    return scoring.target_terms(_asked(spark, sf), _synonyms(spark, sf))


# --- topics -----------------------------------------------------------------


def stopword_filter(spark, sf):
    return topics.drop_stop_words(_tokens(spark, sf, "lemma"), _stop_words(spark))


def topic_tokens(spark, sf):
    return topics.topic_tokens(_tokens(spark, sf, "lemma"), _stop_words(spark))


def vocabulary(spark, sf):
    return _vocabulary(spark, sf)


def token_totals(spark, sf):
    return topics.token_totals(segment.explode_lemmas(_topical(spark, sf)))


def topic_tfidf(spark, sf):
    return _rounded_tfidf(_weighted(_topical(spark, sf), SENTENCE), SENTENCE)


def lda_topics(spark, sf):
    """What a fit cannot vary: all words are ranked in each topic, by falling weight."""
    fitted = topic_model.fit_topic_weights(_topical(spark, sf))
    ranked = topics.ranked_topic_words(fitted).withColumn("rank", F.col("rank").cast("int"))
    described = stored(ranked, "described")
    known = _vocabulary(spark, sf).select("term", F.lit(True).alias("known"))
    # Joined to the next rank; a window would sort each topic in one task.
    before = described.select("topic", (F.col("rank") + 1).alias("rank"), F.col("weight").alias("before"))
    falling = F.coalesce(F.col("weight") <= F.col("before"), F.lit(True))
    ranked = described.join(before, ["topic", "rank"], "left").withColumn("falling", falling)
    return ranked.join(known, "term", "left").select(
        "topic", "rank", F.coalesce("known", F.lit(False)).alias("known"), "falling"
    )


def topic_top_words(spark, sf):
    return _topic_words(spark, sf)


def sentence_topic(spark, sf):
    words = settled(_topic_words(spark, sf))
    found = topics.with_topics(_sentences(spark, sf), words, SENTENCE)
    return found.select(*SENTENCE, "topic")


def question_topic(spark, sf):
    words = settled(_topic_words(spark, sf))
    return topics.assign_topics(_asked(spark, sf), words, ["q_id"])


# --- questions, scores, answers ---------------------------------------------


def question_type(spark, sf):
    return answering.question_types(_asked(spark, sf))


def target_terms(spark, sf):
    return scoring.target_terms(_asked(spark, sf))


def _search(spark, sf, **options) -> Search:
    return Search.over_sentences(_asked(spark, sf), _sentences(spark, sf), ruled=True, **options)


def base_score(spark, sf):
    return scoring.shown(_search(spark, sf).scores(use_bigrams=False))


def bigram_score(spark, sf):
    return scoring.shown(_search(spark, sf).scores())


def topic_score(spark, sf):
    words = settled(_topic_words(spark, sf))
    return scoring.shown(_search(spark, sf, topic_words=words).topic_scores(words))


def _top(spark, sf, k):
    top = _search(spark, sf).top_sentences(k)
    return top.select("q_id", "rank", *SENTENCE, "score")


def top_sentences(spark, sf):
    return _top(spark, sf, 5)


def top1_sentence(spark, sf):
    return _top(spark, sf, 1)


def _extracted(sentences: DataFrame, found, *labels) -> DataFrame:
    return sentences.withColumn("found", found).select(
        *SENTENCE,
        *labels,
        F.coalesce("found", "sent").alias("answer"),
        quality_of(F.col("found")).alias("quality"),
    )


def answer_why(spark, sf):
    found = because_answer(F.col("toks"), F.col("lemmas"), F.col("tags"))
    return _extracted(_sentences(spark, sf), found)


def answer_entity(spark, sf):
    kinds = F.array(*[F.lit(k) for k in ("WHO", "WHEN", "WHERE")])
    typed = _sentences(spark, sf).withColumn("type", F.explode(kinds))
    found = entity_answer(F.col("toks"), F.col("ents"), entity_targets(F.col("type")))
    return _extracted(typed, found, "type")


def answer_definition(spark, sf):
    found = definition_answer(F.col("toks"), F.col("lemmas"))
    return _extracted(_sentences(spark, sf), found)


def qa_batch(spark, sf):
    return answer_questions(_questions(spark, sf), _documents(spark, sf))


def answers(spark, sf):
    """Answers with the topic boost and with expanded terms, as the interactive form has."""
    return answer_questions(
        _questions(spark, sf),
        _documents(spark, sf),
        synonyms=_synonyms(spark, sf),
        topic_words=settled(_topic_words(spark, sf)),
    )


def answers_legacy(spark, sf):
    return answer_questions(_questions(spark, sf), _documents(spark, sf), legacy_span=True)


def answers_lexicon(spark, sf):
    """Answers with a lexicon that knows places and organizations."""
    return answer_questions(
        _questions(spark, sf), _documents(spark, sf), lexicon=_lexicon(spark)
    )


def qa_conversations(spark, sf):
    return answer_questions(_conversation_questions(spark, sf), _documents(spark, sf))


def answer_report(spark, sf):
    return answering.answer_report(_questions(spark, sf), qa_batch(spark, sf))


def answer_digest(spark, sf):
    return answering.answer_digest(_questions(spark, sf), qa_batch(spark, sf))


def best_answer(spark, sf):
    return answering.best_answer(qa_batch(spark, sf))


def two_stage_retrieval(spark, sf):
    return document_first(_questions(spark, sf), _documents(spark, sf))


def qa_store(spark, sf):
    """The same answers as ``qa_batch`` with topics, from a prepared store."""
    path = scratch_path(spark, "store")
    words = settled(_topic_words(spark, sf))
    prepare_store(_documents(spark, sf), path, words, buckets=8)
    return answer_from_store(_questions(spark, sf), read_store(spark, path))


def posting_blocks(spark, sf):
    """Term counts of sentences, packed into blocks and read back from them."""
    terms = scoring.corpus_terms(_sentences(spark, sf))
    blocks = stored(postings.pack_postings(terms), "blocks")
    rows = postings.unpack_postings(blocks)
    return rows.select("doc_id", "sent_no", F.col("key").alias("lemma"), F.col("n").alias("tf"))


def block_documents(spark, sf):
    """Term counts of whole documents and the headers' frequencies, from one set of blocks."""
    terms = scoring.corpus_terms(_sentences(spark, sf))
    blocks = stored(postings.pack_postings(terms), "blocks")
    weights = postings.block_weights(blocks).select("key", "df")
    counts = postings.document_postings(blocks)
    return joins.lookup_join(counts, weights, ["key"], spread_by=[F.col("doc_id")]).select(
        "doc_id", F.col("key").alias("lemma"), F.col("n").alias("tf"), F.col("df").alias("sentences")
    )


def qa_packed(spark, sf):
    """The same answers as ``qa_store``, from a store that keeps its features in blocks."""
    path = scratch_path(spark, "store")
    words = settled(_topic_words(spark, sf))
    prepare_store(_documents(spark, sf), path, words, buckets=8, packed=True)
    return answer_from_store(_questions(spark, sf), read_store(spark, path))


def qa_appended(spark, sf):
    """The same answers as ``qa_batch``, from a corpus that grew by segments.

    The first segment has a quarter of the documents and old texts of others; three more
    bring the rest and replace the old ones; one document comes that is removed again.
    """
    path, documents = scratch_path(spark, "store"), _documents(spark, sf).select("doc_id", "text")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    old = F.concat(F.lit("An old text is here. "), F.substring("text", 1, 50)).alias("text")
    extra = spark.range(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.lit("It is gone.").alias("text"))
    first = documents.where(part == 0).unionByName(documents.where(part == 1).select("doc_id", old))
    versions.prepare(first.unionByName(extra), path, buckets=8)
    for number in (1, 2, 3):
        gone = extra if number == 2 else None
        versions.append(spark, path, documents.where(part == number), gone)
    return answer_from_version(_questions(spark, sf), versions.read_version(spark, path))


def two_stage_store(spark, sf):
    """The same as ``two_stage_retrieval``, from stored document and sentence features."""
    version = versions.prepare(_documents(spark, sf), scratch_path(spark, "store"), buckets=8)
    return document_first_from_version(_questions(spark, sf), version)


def qa_fitted(spark, sf):
    """Answers with the store's own fitted word vectors and topics, by what cannot vary.

    Which sentences win depends on the fit; that they exist, that ranks have no gap and
    that the quality fits the span does not.
    """
    path = scratch_path(spark, "store")
    version = versions.prepare(
        _documents(spark, sf), path, buckets=8, fit=True, vector_size=50, iterations=5
    )
    found = answer_from_version(_questions(spark, sf), version)
    sents = version.sentences.select("doc_id", "sent_no", "sent")
    joined = found.join(sents, SENTENCE, "left")
    whole = F.col("answer") == F.col("sent")
    return joined.select(
        "q_id",
        "rank",
        F.col("sent").isNotNull().alias("exists"),
        ((F.col("quality") == 1.0) | whole).alias("fits"),
        (F.col("score") > 0).alias("scored"),
    )


def qa_stream(spark, sf):
    """One answer per question of a stream; equals the batch with ``k=1``."""
    folder = scratch_path(spark, "stream")
    prepare_store(_documents(spark, sf), f"{folder}/store", buckets=8)
    _questions(spark, sf).write.parquet(f"{folder}/questions")
    query = answer_stream(
        read_question_stream(spark, f"{folder}/questions"),
        read_store(spark, f"{folder}/store"),
        f"{folder}/answers",
        f"{folder}/progress",
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/answers").select(*answering.ANSWER_COLUMNS)


def qa_stream_once(spark, sf):
    """Questions asked again are answered once, and a new version is taken up.

    The stream is stopped after the even questions. Then documents are replaced by
    themselves, which makes version 2, and the odd questions come with all even ones again.
    """
    folder = scratch_path(spark, "stream")
    documents = _documents(spark, sf).select("doc_id", "text")
    versions.prepare(documents, f"{folder}/store", buckets=8)
    asked = _questions(spark, sf).groupBy(F.lower("text").alias("same")).agg(
        F.min("q_id").alias("q_id"), F.min_by("text", "q_id").alias("text")
    )
    even = F.col("q_id") % 2 == 0
    again = asked.where(even).select(
        (-F.col("q_id") - 1).alias("q_id"), F.concat("text", F.lit(" ")).alias("text")
    )
    rounds = [asked.where(even), asked.where(~even).select("q_id", "text").unionByName(again)]
    for number, questions in enumerate(rounds):
        if number:
            versions.append(spark, f"{folder}/store", documents.where("doc_id % 4 = 0"))
        asked_at = F.timestamp_seconds(F.lit(DAY_ONE + 60 * number)).alias("asked_at")
        questions.select("q_id", "text", asked_at).write.mode("append").parquet(f"{folder}/questions")
        stream = read_question_stream(spark, f"{folder}/questions", schema=TIMED_SCHEMA)
        answer_version_stream(
            once_within(stream, "10 minutes"),
            f"{folder}/store",
            f"{folder}/answers",
            f"{folder}/progress",
        ).awaitTermination()
    answers = spark.read.parquet(f"{folder}/answers")
    return answers.select(*answering.ANSWER_COLUMNS, "version")


QUERIES = [
    corpus_scan, prepared_roundtrip, topic_report, doc_view, initial_index,
    sentences, tokens, lemmas, pos_tags, entity_tags, lexicon_tags, lemma_table, lemmas_learned,
    abbreviations, sentences_learned, phrase_tags,
    content_tokens, bigrams,
    question_tokens, question_bigrams, lemma_match,
    term_freq, idf_sentence, idf_document, tfidf_sentence, tfidf_document, tfidf_vectors,
    hashed_tf, tfidf_ml,
    word2vec_vectors, nearest_vectors, expanded_terms,
    stopword_filter, topic_tokens, vocabulary, token_totals, topic_tfidf, lda_topics,
    topic_top_words, sentence_topic, question_topic,
    question_type, target_terms, base_score, bigram_score, topic_score,
    top_sentences, top1_sentence, answer_why, answer_entity, answer_definition,
    qa_batch, answers, answers_legacy, answers_lexicon, qa_conversations, answer_report, answer_digest,
    best_answer, two_stage_retrieval, qa_store, qa_stream,
    qa_lemmas, answers_phrases, prepared_tables, qa_appended, two_stage_store, qa_fitted,
    posting_blocks, block_documents, qa_packed, nearest_pivots, qa_stream_once,
    cooccurrences, word_information, information_vectors,
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: answer all benchmark questions in one job."""
    return qa_batch(spark, "/root/testdata/sf0.001")


def _llm_parts() -> list:
    """The training-data operators and the pipeline over them, where they can be imported.

    Without them, or without a library that they need, the other queries still stand.
    """
    parts = []
    for name in ("quillon.llm.registry", "corpus_pipeline"):
        try:
            parts.append(importlib.import_module(name))
        except ModuleNotFoundError as error:
            warnings.warn(f"{name} left out: {error}", stacklevel=2)
    return parts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in QUERIES}
    for part in _llm_parts():
        found.update(part.QUERIES)
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(oracle_queries.build())
    for part in _llm_parts():
        texts = part.ORACLE_SQL
        named = texts if isinstance(texts, dict) else {"pipeline": texts}
        found.update({name: text for name, text in named.items() if text})
    return found
