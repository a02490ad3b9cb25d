import hashlib
import re
from collections import defaultdict

import corpus_pipeline
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillon.llm import mixing

SOURCE = "/root/testdata/sf0.001/documents.parquet"


def _shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(4, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def _near(rows):
    sets = {r["doc_id"]: _shingles(r["text"]) for r in rows}
    label = {i: i for i in sets}
    for i, one in sets.items():
        for j, two in sets.items():
            if j < i and one and two and 100 * len(one & two) >= 80 * len(one | two):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return [r for r in rows if label[r["doc_id"]] == r["doc_id"]]


def _cell(row):
    text = row["text"] or ""
    tokens = len(re.findall("[^\x20\x09-\x0d]+", text))
    share = lambda low, high: sum(low <= c <= high for c in text) / max(len(text), 1)
    if share("0", "9") > 0.05:
        topic = "figures"
    elif share("A", "Z") > 0.3:
        topic = "capitals"
    else:
        topic = "note" if tokens < 100 else "article" if tokens < 1000 else "long"
    return (row["source"] or "", row["lang"] or "", topic), tokens


def _mixed(rows):
    tokens = defaultdict(int)
    for row in rows:
        cell, n = _cell(row)
        tokens[cell] += n
    total = sum(tokens.values())
    weight = {cell: n / total for cell, n in tokens.items()}
    most = {cell: w / mixing.FRACTION for cell, w in weight.items()}
    targets = []
    for dimension in range(3):
        marginal = defaultdict(int)
        for cell, n in tokens.items():
            marginal[cell[dimension]] += n
        lifted = {name: n**mixing.TEMPER for name, n in marginal.items()}
        targets.append({name: x / sum(lifted.values()) for name, x in lifted.items()})
    for _ in range(mixing.ROUNDS):
        for dimension in range(3):
            sums = defaultdict(float)
            for cell, w in weight.items():
                sums[cell[dimension]] += w
            for cell, w in weight.items():
                name = cell[dimension]
                factor = targets[dimension][name] / sums[name] if sums[name] else 0
                weight[cell] = min(w * factor, most[cell])
    kept = []
    for row in rows:
        cell, _ = _cell(row)
        draw = int(hashlib.md5(f"mix:{row['doc_id']}".encode()).hexdigest()[:13], 16) / 16**13
        if most[cell] and draw < weight[cell] / most[cell]:
            kept.append(row)
    return kept


def test_stages_equal_a_brute_force_chain(spark, tmp_path):
    table = spark.read.parquet(SOURCE).withColumn("key", F.lit("own"))
    odd = spark.createDataFrame(
        [(9001, None, None, None, None, "x"), (9002, "", "en", "s", 0, "x"), (9003, "12 34", "en", "s", 5, "x")],
        table.schema,
    )
    table.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r.asDict() for r in table.unionByName(odd).collect()]

    rows = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
    largest = {}
    for r in rows:
        largest[r["text"]] = max(largest.get(r["text"], -1), r["doc_id"])
    rows = _mixed(_near([r for r in rows if largest[r["text"]] == r["doc_id"]]))
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    expected = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in rows}

    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id: r.n_tokens for r in got.collect()} == expected
    assert 40 < len(expected) < 200


def test_stages_keep_the_columns(spark, docs):
    frame = docs([(1, "one two three four five"), (2, "one two three four five"), (None, None)])
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "bpe_round_trip"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, "").columns == frame.columns
        assert stage(spark, frame.limit(0), "").count() == 0


def test_one_row_of_each_text_stays(spark, docs):
    rows = [(1, "a b"), (1, "a b"), (0, "a b"), (None, "c"), (None, "c"), (None, "d"), (2, "d"), (3, None), (3, ""), (4, "e")]
    got = corpus_pipeline.drop_exact_copies(spark, docs(rows), "")
    assert got.columns == docs(rows).columns
    kept = sorted(((r.doc_id, r.text or "") for r in got.collect()), key=repr)
    assert kept == sorted([(1, "a b"), (None, "c"), (2, "d"), (3, ""), (4, "e")], key=repr)
