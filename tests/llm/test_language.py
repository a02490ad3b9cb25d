import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import language


def _brute_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    marked = " " + " ".join(words) + " " if words else ""
    found = Counter(c for c in marked if c != " ")
    found.update(marked[i : i + 2] for i in range(len(marked) - 1))
    found.update(marked[i : i + 3] for i in range(len(marked) - 2) if marked[i + 1] != " ")
    return found


def _number(ngram):
    value = 0
    for c in ngram:
        value = value << 21 | ord(c)
    return value


def test_ngrams_equal_brute_force():
    for text in ("", "123 !", "Ab", "  Été à  Paris, 2024!", "a-b\nc", "ß😀漢字 x"):
        keys, counts = np.unique(language.ngrams(text), return_counts=True)
        expected = {_number(n): c for n, c in _brute_ngrams(text).items()}
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == expected, text


def test_distance_equals_brute_force():
    profiles = language.Profiles([("aa", _number(n), i) for i, n in enumerate("abcd")] + [("zz", _number("z"), 0)])
    lang, score = profiles.predict("a b")
    own = language.in_rank_order(language.ngrams("a b"), 300).tolist()
    ranks = {_number(n): i for i, n in enumerate("abcd")}
    distance = sum(min(abs(ranks[g] - i), 400) if g in ranks else 400 for i, g in enumerate(own))
    assert (lang, score) == ("aa", 1 - distance / (400 * len(own)))


def test_held_out_accuracy_and_fold(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predict_languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    fold = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in fold) / len(fold) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_profiles_count_all_training_rows(spark, docs):
    rows = [(1, "aab", "x"), (2, "b", "x"), (3, "zz", "y"), (4, "q", None)]
    found = language.learn_profiles(docs(rows)).where("lang = 'x'").orderBy("rank").collect()
    total = _brute_ngrams("aab") + _brute_ngrams("b")
    expected = sorted(total.items(), key=lambda x: (-x[1], _number(x[0])))
    assert [r.ngram for r in found] == [_number(n) for n, _ in expected]


def test_cases(docs):
    rows = [(1, None), (2, "123 ?!"), (3, "word words"), (None, "more words"), (3, "word words")]
    got = language.predict_languages(docs(rows)).collect()
    assert len(got) == 5
    assert [(r.lang_pred, r.score) for r in got[:2]] == [("und", 0.0)] * 2
    assert language.predict_languages(docs([])).count() == 0
    nothing = language.predict_languages(docs([(1, "text", None)])).first()
    assert nothing.lang_pred == "und"


def test_only_undetermined_rows_go(docs):
    rows = docs([(1, "some plain words"), (2, "42"), (3, None), (4, "other plain words"), (0, "plain")])
    kept = language.drop_undetermined(rows)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 4]
    assert kept.where(F.col("recipe") == "x").count() == 3


def test_nothing_learned_loses_nothing(docs):
    """All ``lang`` null, or only held-out rows labelled: what has a letter stays."""
    texts = [(i, t) for i, t in enumerate(("some words", "42 !", None, "", "漢字", "x"))]
    for lang in ([None] * 6, [None if zlib.crc32(str(i).encode()) % 3 != 1 else "en" for i in range(6)]):
        rows = docs([(i, t, own) for (i, t), own in zip(texts, lang, strict=True)])
        kept = language.drop_undetermined(rows)
        assert sorted(r.doc_id for r in kept.collect()) == [0, 4, 5]
        assert kept.columns == rows.columns


def test_the_prediction_takes_effect(spark, docs):
    """Null languages are filled in, wrong ones stay, texts like no profile go."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()
    rows = [(r.doc_id, r.text, r.lang) for r in table]
    given = {r.doc_id: r.lang for r in table}
    lost = [i for i in given if i % 7 == 0]
    wrong = [i for i in given if i % 7 == 1]
    rows = [(i, t, None if i in lost else "zz" if i in wrong else lang) for i, t, lang in rows if i not in wrong]
    rows += [(i, t, "de" if given[i] != "de" else "fr") for i, t in ((r.doc_id, r.text) for r in table) if i in wrong]
    rows += [(9_001, "漢字 仮名 混じり 文 漢字", None), (9_002, "ж д щ ю э ъ", "en"), (9_003, "12 34", None)]
    kept = {r.doc_id: r.lang for r in language.drop_undetermined(docs(rows)).collect()}
    lettered = {i for i, t, _ in rows if any(c.isalpha() for c in t or "")}
    assert kept.keys() == lettered - {9_001, 9_002}
    assert sum(kept[i] == given[i] for i in lost if i in kept) >= 0.95 * len(lost)
    assert all(kept[i] != given[i] for i in wrong if i in kept)


def test_too_many_languages_are_refused_before_they_are_collected(spark, docs, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language.predict_languages(docs([(i, "text", f"l{i}") for i in range(20)]))


def test_profiles_are_cut_before_the_shuffle(docs):
    plan = language.learn_profiles(docs([(1, "some words", "en")]))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_very_long_texts(docs):
    rows = [(1, "word and more " * 300_000, "en"), (2, "words and more", "en")]
    got = {r.doc_id: r.lang_pred for r in language.predict_languages(docs(rows)).collect()}
    assert got == {1: "en", 2: "en"}
