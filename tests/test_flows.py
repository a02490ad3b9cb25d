"""Whole flows: agreement of the forms, fallbacks, files, models."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import joins, models, numbering, scoring, segment, tfidf, topics, vectors
from quillon.operators.answering import answer_digest
from quillon.plans.answering import answer_questions, document_first
from quillon.plans.prepared import answer_from_store
from quillon.session import scratch_path
from quillon.sources import reports, tables
from quillon.sources.models import load_lda, load_word2vec, save_model
from quillon.sources.questions import sample_questions
from quillon.sources.store import read_store, write_store
from quillon.streaming.questions import answer_stream, read_question_stream


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_answers(asked, corpus):
    got = {(r.q_id, r["rank"]): r for r in answer_questions(asked, corpus, 5).collect()}
    assert got[1, 1].answer == "because the index is bad ." and got[1, 1].quality == 1.0
    assert got[2, 1].answer == "a segment ."
    assert got[3, 1].answer == "1999"
    assert not any(q == 4 for q, _ in got)
    digest = answer_digest(asked, answer_questions(asked, corpus, 5)).collect()
    assert {r.q_id: r.digest for r in digest}[4] == ""


def test_one_is_a_prefix_and_questions_are_independent(asked, corpus):
    five = answer_questions(asked, corpus, 5)
    one = answer_questions(asked, corpus, 1)
    assert rows(one) == rows(five.where("rank = 1"))
    single = [rows(answer_questions(asked.where(F.col("q_id") == q), corpus, 5)) for q in (1, 2, 3)]
    assert sorted(sum(single, []), key=repr) == rows(five)


def test_large_side_path_gives_the_same(asked, corpus, frame, monkeypatch):
    words = frame([(0, 1, "index", 2.0), (1, 1, "slice", 2.0)], "topic int, rank int, term string, weight double")
    synonyms = frame([("slice", "segment")], "term string, synonym string")
    args = {"synonyms": synonyms, "topic_words": words}
    usual = rows(answer_questions(asked, corpus, 5, **args))
    docs = rows(document_first(asked, corpus))
    weights = rows(tfidf.tfidf(
        tfidf.term_freq(segment.annotate(corpus), tfidf.SENTENCE),
        tfidf.idf(segment.annotate(corpus)), tfidf.SENTENCE))
    for module in ("quillon.operators.joins", "quillon.operators.scoring",
                   "quillon.operators.tfidf", "quillon.plans.answering"):
        monkeypatch.setattr(f"{module}.is_small", lambda df: False)
    monkeypatch.setattr("quillon.plans.answering.MAX_BROADCAST_ROWS", 0)
    assert rows(answer_questions(asked, corpus, 5, **args)) == usual
    assert rows(document_first(asked, corpus)) == docs
    assert weights == rows(tfidf.tfidf(
        tfidf.term_freq(segment.annotate(corpus), tfidf.SENTENCE),
        tfidf.idf(segment.annotate(corpus)), tfidf.SENTENCE))


def test_many_questions_are_scored_in_blocks(asked, corpus, monkeypatch):
    from quillon.plans.answering import Search

    usual = rows(answer_questions(asked, corpus, 5))
    monkeypatch.setattr("quillon.operators.scoring.is_small", lambda df: False)
    monkeypatch.setattr("quillon.operators.joins.MAX_BROADCAST_ROWS", 16)
    search = Search.over_sentences(segment.annotate_questions(asked), segment.annotate(corpus))
    assert len(scoring.question_blocks(search.features)) > 1
    assert rows(answer_questions(asked, corpus, 5)) == usual
    # Between the sums and the pairs they add up there is no exchange.
    lines = plan(search.scores()).splitlines()
    sums = [i for i, line in enumerate(lines) if "HashAggregate" in line and "base" in line]
    for at in sums:
        below = next(line for line in lines[at + 1 :] if "Join" in line or "Exchange" in line)
        assert "BroadcastHashJoin" in below


def test_is_small_measures(frame):
    table = frame([("abc",), ("d" * 1000,)], "key string")
    assert joins.is_small(table)
    assert not joins.is_small(table, max_rows=1)
    assert not joins.is_small(table, max_bytes=500)


def test_boosts_never_lower_a_score(asked, corpus, frame):
    from quillon.plans.answering import Search

    words = frame([(0, 1, "index", 2.0)], "topic int, rank int, term string, weight double")
    search = Search.over_sentences(
        segment.annotate_questions(asked), segment.annotate(corpus), topic_words=words
    )
    keys = ["q_id", "doc_id", "sent_no"]
    base = scoring.shown(search.scores(use_bigrams=False)).withColumnRenamed("score", "plain")
    full = scoring.shown(search.topic_scores(words))
    joined = base.join(full, keys)
    assert joined.count() == base.count() == full.count() > 0
    assert joined.where("score < plain").count() == 0
    assert scoring.TOPIC_BOOST == 1.25 and scoring.BIGRAM_BOOST == 1.3


def test_store_and_stream_equal_batch(spark, asked, corpus):
    path = scratch_path(spark, "t")
    write_store(segment.annotate(corpus), f"{path}/store", buckets=4)
    store = read_store(spark, f"{path}/store")
    assert rows(answer_from_store(asked, store, 5)) == rows(answer_questions(asked, corpus, 5))
    asked.write.parquet(f"{path}/questions")
    before = sorted(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    for _ in range(2):  # the second run finds nothing new
        answer_stream(
            read_question_stream(spark, f"{path}/questions", 1), store, f"{path}/out", f"{path}/progress"
        ).awaitTermination()
    assert sorted(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == before
    streamed = spark.read.parquet(f"{path}/out").drop("batch_id")
    assert rows(streamed) == rows(answer_questions(asked, corpus, 1))
    with pytest.raises(FileNotFoundError, match="sentences"):
        read_store(spark, f"{path}/nothing")


def test_lexicon_and_model(frame, spark, corpus, monkeypatch):
    lexicon = frame(
        [("Eve", "eve", "NNP", "ORGANIZATION"), ("segment", None, "FW", None)],
        "surface string, lemma string, pos string, nec string",
    )
    plain = segment.annotate(corpus).where("doc_id = 2").orderBy("sent_no").collect()
    ruled = segment.annotate(corpus, lexicon).where("doc_id = 2").orderBy("sent_no").collect()
    assert ruled[1].ents[2] == "ORGANIZATION" and plain[1].ents[2] == "PERSON"
    assert ruled[0].tags[4] == "FW" and ruled[0].lemmas == plain[0].lemmas
    assert [r.doc_sents for r in ruled] == [3, 0, 0]

    assert rows(segment.annotate(corpus, lexicon.unionByName(lexicon))) == rows(
        segment.annotate(corpus, lexicon)
    )
    blank = frame([(1, "Eve met"), (2, ""), (3, " ")], "q_id bigint, text string")
    mapped = rows(segment.annotate_questions(blank, lexicon))
    assert len(mapped) == 3
    documents = rows(segment.annotate(corpus, lexicon))
    monkeypatch.setattr("quillon.operators.segment.MAX_MAPPED_WORDS", 0)
    assert rows(segment.annotate_questions(blank, lexicon).select(blank.columns + segment.ARRAYS)) == mapped
    assert rows(segment.annotate(corpus, lexicon)) == documents

    def model(batches):
        for batch in batches:
            out = batch.assign(sent_no=0, doc_sents=1, sent=batch["text"])
            words = batch["text"].str.split()
            yield out.assign(toks=words, lemmas=words, tags=words, ents=words)[
                ["doc_id", "sent_no", "doc_sents", "sent", "toks", "lemmas", "tags", "ents"]
            ]

    assert segment.annotate_with(corpus, model).count() == 3


def test_topics(frame):
    words = frame(
        [(0, "list"), (0, "index"), (1, "queue"), (1, "item")], "topic int, term string"
    )
    table = frame(
        [(1, ["list", "item"]), (2, ["item", "queue", "item"]), (3, ["tree"]), (4, [])],
        "q_id int, lemmas array<string>",
    )
    got = {r.q_id: r.topic for r in topics.assign_topics(table, words, ["q_id"]).collect()}
    assert got == {1: 0, 2: 1, 3: -1, 4: -1}


def test_numbered_is_gapless(spark):
    table = spark.range(5000).select(F.xxhash64("id").alias("v"))
    got = numbering.numbered(table, [F.asc("v")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(5000))
    assert [r.v for r in got] == sorted(r.v for r in got)


def test_nearest_in_many_blocks(frame):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(60, 5)).round(2)
    data[7] = data[8]
    data[9] = 0.0
    table = frame([(i, v.tolist()) for i, v in enumerate(data)], "name bigint, vector array<double>")
    got = vectors.nearest_vectors(table, table, 3, block_rows=16).collect()
    assert rows(vectors.nearest_vectors(table, table, 3)) == sorted(map(tuple, [
        (r.neighbour, r["rank"], r.similarity, r.term) for r in got]), key=repr)
    none = vectors.nearest_vectors(table.where("name < 0"), table)
    assert none.count() == 0
    # Few queries: only the best of each task are shuffled, not the vectors.
    assert "block" not in plan(vectors.nearest_vectors(table, table, 3))
    norm = np.linalg.norm(data, axis=1)
    sims = np.round(data @ data.T / np.maximum(np.outer(norm, norm), 1e-12), 6)
    for i in range(60):
        others = sorted((j for j in range(60) if j != i), key=lambda j: (-sims[i, j], j))[:3]
        mine = sorted((r["rank"], r.neighbour) for r in got if r.term == i)
        assert [n for _, n in mine] == others


def test_files(spark, tmp_path):
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "a.txt").write_text("One.\nTwo.")
    (tmp_path / "corpus" / "b.txt").write_text("Three.")
    docs = tables.read_corpus_folder(spark, str(tmp_path / "corpus"))
    assert sorted(r.text for r in docs.collect()) == ["One.\nTwo.", "Three."]
    assert docs.select("doc_id").distinct().count() == 2
    (tmp_path / "q.txt").write_text("What is it?\n\nWhy?\n")
    found = tables.read_question_file(spark, str(tmp_path / "q.txt")).orderBy("q_id")
    assert [r.text for r in found.collect()] == ["What is it?", "Why?"]
    (tmp_path / "stop.txt").write_text("ours \nits\nits\n")
    words = tables.read_stop_words(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.word for r in words.collect()) == ["its", "ours"]
    assert sample_questions(spark).count() == 8
    words = spark.createDataFrame([(1, 1, "b", 0.5), (0, 1, "a", 2.0)], "topic int, rank int, term string, weight double")
    reports.write_topic_report(words, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert sorted(lines) == ["TOPIC_0;a;2.0", "TOPIC_1;b;0.5"]


def test_models(spark, corpus, tmp_path):
    sentences = topics.topical_sentences(segment.annotate(corpus), ["with"])
    for weighting in ("count", "tfidf"):
        model, counts = models.fit_topics(sentences, topics=3, iterations=3, weighting=weighting)
        described = models.describe_topics(model, counts, 4).orderBy("topic", "rank").collect()
        assert len(described) == 12
        for topic in range(3):
            weights = [r.weight for r in described if r.topic == topic]
            assert weights == sorted(weights, reverse=True)
    save_model(model, str(tmp_path / "lda"))
    assert load_lda(str(tmp_path / "lda")).vocabSize() == len(counts.vocabulary)
    w2v = models.fit_word2vec(segment.annotate(corpus), size=8, min_count=1, slices=1)
    found = models.word_vectors(w2v).collect()
    assert {len(r.vector) for r in found} == {8}
    save_model(w2v, str(tmp_path / "w2v"))
    loaded = models.word_vectors(load_word2vec(str(tmp_path / "w2v")))
    terms = spark.createDataFrame([("index",), ("index",), ("nowhere",)], "lemma string")
    near = vectors.synonyms_from(terms, loaded, 3).collect()
    assert [r.term for r in near] == ["index"] * 3 and all(r.synonym != "index" for r in near)
    with pytest.raises(FileNotFoundError, match="LDA"):
        load_lda(str(tmp_path / "missing"))
    with pytest.raises(FileNotFoundError, match="Word2Vec"):
        load_word2vec(str(tmp_path / "missing"))
    hashed = models.hashed_tf(segment.annotate(corpus), 64).select("tf", "toks").collect()
    assert all(r.tf.values.sum() == len(r.toks) for r in hashed)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, asked):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sentences = segment.annotate(docs)
    words = spark.createDataFrame([("the", 1), ("an", 2)], "term string, topic int")
    assigned = topics.assign_topics(sentences, words, tfidf.SENTENCE)
    assert plan(assigned).count("Exchange hashpartitioning") == 1
    for df in (sentences, segment.bigrams(sentences, tfidf.SENTENCE),
               tfidf.term_freq(sentences, tfidf.SENTENCE), reports.document_view(docs)):
        assert "Exchange" not in plan(df) and "Python" not in plan(df)
    answers = plan(answer_questions(asked, docs))
    assert "WindowGroupLimit" in answers and "BroadcastHashJoin" in answers
    assert "SortMergeJoin" not in answers and "CartesianProduct" not in answers
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in answers
