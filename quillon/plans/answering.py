"""Answer a table of questions from a table of documents, all in one go.

A run reads the corpus twice whatever the number of questions: once for the
features the questions ask for, once to fetch the winning sentences.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.arrays import bind
from quillon.functions.text import sentence_array
from quillon.operators import pruning, scoring, segment, topics
from quillon.operators.answering import extract_answers, question_types
from quillon.operators.joins import MAX_BROADCAST_ROWS, is_small, lookup_join
from quillon.operators.phrases import with_phrases
from quillon.operators.tfidf import DOCUMENT, SENTENCE
from quillon.session import stored


@dataclass
class Search:
    """What scoring needs: both sides' features, and whether the questions are few."""

    questions: DataFrame  # annotated
    features: DataFrame  # q_id, kind, key, nq
    matches: DataFrame  # doc_id, sent_no, kind, key, n [, topic]
    weights: DataFrame  # kind, key, df
    size: Column  # number of sentences
    small: bool
    documents: Column | None = None  # number of documents

    @cached_property
    def pairs(self) -> int:
        return scoring.scoring_pairs(self.features, self.weights)

    @property
    def tasks(self) -> int:
        return scoring.scoring_tasks(self.features.sparkSession, self.pairs)

    @classmethod
    def over_sentences(
        cls,
        questions: DataFrame,
        sentences: DataFrame,
        synonyms: DataFrame | None = None,
        topic_words: DataFrame | None = None,
        documents: DataFrame | None = None,
        ruled: bool = False,
    ) -> Search:
        """One pass over annotated sentences for everything the questions ask.

        ``documents`` are counted, for scores of whole documents. ``ruled`` says that no
        lexicon had a say in the lemmas of the sentences.
        """
        features = scoring.question_features(questions, synonyms)
        small = scoring.questions_are_small(features)
        # Distinct features are no more than the features themselves.
        all_small = small and (topic_words is None or is_small(topic_words))
        wanted = scoring.wanted_features(features, topic_words)
        matches = scoring.matching_features(sentences, wanted, all_small, ruled)
        return cls(
            questions,
            features,
            matches,
            # Written once: the tasks and every block of questions are read off it.
            stored(scoring.feature_weights(matches), "weights"),
            scoring.sentence_count(matches),
            small,
            None if documents is None else scoring.document_count(documents),
        )

    def scores(
        self,
        use_bigrams: bool = True,
        within: DataFrame | None = None,
        element_topics: DataFrame | None = None,
    ) -> DataFrame:
        return scoring.score(
            self.features,
            self.matches,
            self.weights,
            self.size,
            SENTENCE,
            self.small,
            self.tasks,
            use_bigrams,
            within,
            element_topics,
        )

    def contenders(self, k: int, topic_words: DataFrame | None = None) -> DataFrame:
        """Scores of all sentences that can be among the ``k`` best of their question.

        The same rows as ``scores`` or ``topic_scores`` give, less those that bounds rule out.
        Where there are few to begin with, all are scored.
        """
        if self.pairs <= pruning.FEW_PAIRS:
            return self.scores() if topic_words is None else self.topic_scores(topic_words)
        blocks = [self.features] if self.small else scoring.question_blocks(self.features)
        parts = [
            pruning.contenders(
                block, self.matches, self.weights, self.size, SENTENCE, k, topic_words is not None
            )
            for block in blocks
        ]
        scored = reduce(DataFrame.unionByName, parts)
        return scored if topic_words is None else self._boosted(scored, topic_words)

    def top_sentences(self, k: int, topic_words: DataFrame | None = None) -> DataFrame:
        """The ``k`` best sentences of each question, with ``rank`` and ``score``."""
        return scoring.top_elements(self.contenders(k, topic_words), k, SENTENCE)

    def document_scores(self, per_document: DataFrame | None = None) -> DataFrame:
        """Base score of whole documents, with document frequencies.

        A document has no bigrams of its own, so only terms count. ``per_document(doc_id,
        kind, key, n)`` are its features where they are stored; else they are added up.
        """
        if per_document is None:
            per_document = self.matches.groupBy("doc_id", *scoring.FEATURE).agg(F.sum("n").alias("n"))
        weights = stored(scoring.feature_weights(per_document), "weights")
        return scoring.score(
            self.features,
            per_document,
            weights,
            self.documents,
            DOCUMENT,
            self.small,
            self.tasks,
            use_bigrams=False,
        )

    def topic_scores(self, topic_words: DataFrame) -> DataFrame:
        found = self._sentence_topics(topic_words)
        return self._boosted(self.scores(element_topics=found), topic_words)

    def _sentence_topics(self, topic_words: DataFrame) -> DataFrame | None:
        """``doc_id, sent_no, topic``, unless the matches have their topics stored."""
        if "topic" in self.matches.columns:
            return None
        return topics.topics_of_matches(self.matches, topic_words, SENTENCE, self.tasks)

    def _boosted(self, scored: DataFrame, topic_words: DataFrame) -> DataFrame:
        asked = topics.assign_topics(self.questions, topic_words, ["q_id"])
        found = None if "topic" in scored.columns else self._sentence_topics(topic_words)
        return scoring.boost_topics(scored, asked, found)


def winning_sentences(
    documents: DataFrame,
    top: DataFrame,
    small: bool,
    lexicon: DataFrame | None = None,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """``top`` with the text and token arrays of its sentences.

    The join comes before any splitting, so only documents that hold a winner are
    tokenized, and for those only the winning sentence.
    """
    joined = lookup_join(documents.select("doc_id", "text"), top, ["doc_id"], small=small)
    sent = bind(
        F.filter(sentence_array(F.col("text")), lambda s: s["sent_no"] == F.col("sent_no")),
        lambda hit: F.get(hit, F.lit(0))["sent"],
    )
    picked = joined.withColumn("sent", sent).drop("text")
    found = segment.with_tokens(picked, "sent", ["q_id", "rank"], lexicon)
    return found if phrases is None else with_phrases(found, phrases, ["q_id", "rank"])


def answer_top(
    questions: DataFrame,
    documents: DataFrame,
    top: DataFrame,
    k: int,
    legacy_span: bool = False,
    lexicon: DataFrame | None = None,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """Answers from the best sentences ``top(q_id, doc_id, sent_no, score, rank)``.

    ``top`` has at most ``k`` rows per question; it is broadcast when the counted
    questions bound it, otherwise joined by document.
    """
    bounded = questions.count() * k <= MAX_BROADCAST_ROWS
    typed = lookup_join(top, question_types(questions), ["q_id"], small=bounded)
    return extract_answers(
        winning_sentences(documents, typed, bounded, lexicon, phrases), legacy_span
    )


def answer_questions(
    questions: DataFrame,
    documents: DataFrame,
    k: int = 5,
    synonyms: DataFrame | None = None,
    topic_words: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    legacy_span: bool = False,
    phrases: DataFrame | None = None,
) -> DataFrame:
    """``questions(q_id, text)`` x ``documents(doc_id, text)`` -> up to ``k`` answers each.

    ``synonyms`` widens the search terms, ``topic_words`` turns on the topic boost;
    ``phrases(phrase, nec)`` name entities of several tokens in the winning sentences.
    """
    annotated = segment.annotate_questions(questions, lexicon)
    search = Search.over_sentences(
        annotated, segment.annotate(documents, lexicon), synonyms, topic_words, ruled=lexicon is None
    )
    top = search.top_sentences(k, topic_words)
    return answer_top(annotated, documents, top, k, legacy_span, lexicon, phrases)


def document_first(
    questions: DataFrame,
    documents: DataFrame,
    n_documents: int = 2,
    k: int = 10,
    synonyms: DataFrame | None = None,
) -> DataFrame:
    """``q_id, rank, doc_id, sent_no, score``: the best sentences of the best documents.

    Picks ``n_documents`` per question by document score, then ranks their sentences.
    Both scores come from the same pass over the corpus.
    """
    annotated = segment.annotate_questions(questions)
    search = Search.over_sentences(
        annotated, segment.annotate(documents), synonyms, documents=documents, ruled=True
    )
    best = scoring.top_elements(search.document_scores(), n_documents, DOCUMENT)
    # Written, as it is read twice and the documents should not be scored again.
    within = stored(best.select("q_id", "doc_id"), "within")
    if questions.count() * n_documents <= MAX_BROADCAST_ROWS:
        within = F.broadcast(within)
    return scoring.top_elements(search.scores(within=within), k, SENTENCE)
