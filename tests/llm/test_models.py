"""Word models, language and quality."""

import math
import pathlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from agoralens.llm import language, quality, questions, word_model
from agoralens.sources import scratch

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("frequent", [0, 3, 1_000])
def test_word_losses_like_brute_force(spark, frequent):
    rows = [(1, "the cat saw The cat", True), (1, "кот видел кота", None), (3, None, True), (None, " \n", None), (5, "日本 the cat saw", False), (5, "the dog saw the cat the cat", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean").withColumn("gram", F.lit(1))
    tokens = [(t or "").lower().split() for _, t, _ in rows]
    pairs = [list(zip(["^", *w], w)) for w in tokens]
    both = {True: Counter(p for q, r in zip(pairs, rows) if r[2] for p in q), False: Counter(p for q in pairs for p in q)}
    size = len({w for t in tokens for w in t})

    def loss(target, pair):
        c, (a, b) = both[target], WEIGHTS
        head = sum(n for p, n in c.items() if p[0] == pair[0])
        word = sum(n for p, n in c.items() if p[1] == pair[1]) / sum(c.values())
        return -math.log(a * (c[pair] / head if head else 1 / size) + b * word + (1 - a - b) / size)

    WEIGHTS = word_model.WEIGHTS
    expected = [
        (i, len(p), *[round(np.mean([loss(t, x) for x in p]), 9) if p else None for t in (True, False)]) for (i, *_), p in zip(rows, pairs)
    ]
    found = word_model.score(df, word_model.count(df, "good"), frequent=frequent).collect()
    assert sorted([(r.doc_id, r.n_tokens, *[None if x is None else round(x, 9) for x in r[2:4]]) for r in found], key=str) == sorted(expected, key=str)


def test_word_model_grows_and_knows_every_script(spark, awkward, empty):
    """Words of letters without an a-z base tell texts apart, in the query too; tables follow the corpus."""
    rows = [(k, f"хорошие слова {w} стоят здесь", "en", "a", 1) for k, w in enumerate(["тут", "там"] * 5)]
    rows += [(k + 10, f"дурацкие буквы {w} лежат рядом", "en", "a", 1) for k, w in enumerate(["тут", "там"] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = word_model.stored(docs, "documents").inputFiles()[0].rsplit("/", 1)[0]
    labels = docs.where("doc_id < 10").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    made = {"documents": folder, "labels": word_model.stored(labels, "labels").inputFiles()[0].rsplit("/", 1)[0]}
    table, questions.table = questions.table, lambda s, _, name: s.read.parquet(made[name])
    try:
        found = {r.doc_id: r.difference for r in questions.op4_language_model(spark, "").collect()}
    finally:
        questions.table = table
    assert max(found[k] for k in range(10)) + 1 < min(found[k] for k in range(10, 20))
    sizes = [word_model.count(docs.where(F.col("doc_id") < n).withColumn("good", F.lit(True)), "good").count() for n in (1, 2, 20)]
    assert sizes == [5, 7, 14]
    assert word_model.score(awkward, word_model.count(awkward.withColumn("good", F.lit(None).cast("boolean")), "good")).count() == awkward.count()
    assert word_model.score(empty, word_model.count(empty.withColumn("good", F.lit(True)), "good")).count() == 0


def test_word_model_of_many_buckets_and_blocks(spark, monkeypatch):
    """Losses do not depend on how keys and texts are dealt out, and copies of a row all get theirs."""
    dice = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{x}" for x in dice.zipf(1.3, 60) % 500), bool(k % 3)) for k in range(40)] * 2 + [(None, None, True), (None, "", False), (None, "only", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    told = []
    for size in (10**9, 300):
        monkeypatch.setattr(word_model, "BUCKET_BYTES", size)
        monkeypatch.setattr(word_model, "BLOCK_BYTES", 2 * size)
        monkeypatch.setattr(word_model, "HELD", size)
        counts = word_model.count(df, "good")
        found = [[x if x is None else round(x, 9) for x in r] for r in word_model.score(df, counts, frequent=50).collect()]
        told.append((counts.totals, sorted(found, key=str)))
    assert counts.buckets > 50 and counts.blocks > 25
    assert told[0] == told[1] and len(told[0][1]) == len(rows)


def test_bigrams_take_few_bytes(spark):
    """What is stored of texts whose bigrams mostly occur once."""
    dice = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{x}" for x in dice.integers(0, 5_000, 500)), k % 9 == 0) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    start = scratch.made_so_far()
    counts = word_model.count(df, "good")
    assert word_model.score(df, counts).count() == len(rows)
    files = [path for folder in scratch.made_since(start) for path in pathlib.Path(folder.removeprefix("file:")).rglob("*.parquet")]
    assert files and sum(path.stat().st_size for path in files) < 6 * counts.count()


@pytest.mark.parametrize("values", [[], [0, 0], [1, 300, 0], [2**62, 5]])
def test_packed_values_come_back(values):
    values = np.array(values, np.int64)
    assert np.array_equal(word_model.unpacked(pa.chunked_array([[word_model.packed(values)]], pa.binary()))[0], values)
    keys = np.unique(values.view(np.uint64) * word_model.START)
    assert np.array_equal(word_model.unpacked_keys(pa.chunked_array([[word_model.packed_keys(keys)]], pa.binary()))[0], keys)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs.where(~language.held_out("doc_id")))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out("doc_id"))
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 200 and right / n > 0.98
    assert found.where("score < 0 OR score > 1").count() == 0


def test_kernel_like_sets():
    texts = ["der hund bellt", "the dog barks", "Der  Hund!"]
    sets = [language.grams(t) for t in texts]
    model = language.fit([("x", sets[0]), ("y", sets[1])], landmarks=2)._replace(weights=np.eye(2, dtype=np.float32))
    kernel = model.scores(sets)
    for a in range(3):
        for b in range(2):
            x = [set(map(int, g)) for g in sets[a]]
            y = [set(map(int, g)) for g in sets[b]]
            expected = np.mean([len(p & q) / math.sqrt(len(p) * len(q)) for p, q in zip(x, y)])
            assert kernel[a, b] == pytest.approx(expected, rel=1e-5)


def test_language_edges(spark, awkward, empty):
    model = language.train(awkward)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(awkward, model).collect()}
    assert found[4] == found[5] == found[6] == found[10] == ("und", 0.0) and found[1][0] in ("en", "de", "fr")
    assert language.predict(empty, model).count() == 0
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.predict(awkward, nothing).collect()} == {"und"}
    assert language.train(awkward.where("lang = 'en'")).languages == ["en"]


def brute_counts(text):
    words = (text or "").encode().split()
    runs = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + d for k in range(len(words) - 2) for d in range(3) if runs[tuple(words[k : k + 3])] > 1}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)
    )


def test_statistics_like_brute_force(spark, awkward, empty):
    for df in (spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), awkward):
        expected = sorted(((r.doc_id, *brute_counts(r.text)) for r in df.collect()), key=str)
        assert sorted((tuple(r)[:6] for r in quality.statistics(df).collect()), key=str) == expected
    labels = spark.createDataFrame([(1, 1), (3, 0), (99, 1), (None, 1), (1, None), (1, 1)], "doc_id long, quality int")
    judged = quality.judge(awkward, labels)
    assert judged.count() == awkward.count() and judged.where("base_failed AND kept").count() == 0
    assert quality.judge(empty, labels).count() == 0
    assert quality.judge(awkward, labels.limit(0)).where("kept = base_failed").count() == 0


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rest = labels.where("doc_id % 3 != 0")
    judged = quality.judge(docs, rest).join(labels.where("doc_id % 3 = 0"), "doc_id").where("NOT base_failed")
    n, right = judged.agg(F.count("*"), F.sum((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()
    assert n > 80 and right / n > 0.97


def test_trees_are_monotone_and_flat():
    draw = np.random.default_rng(2)
    x = draw.random((3_000, 2))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.2 * draw.random(3_000) < 0.5 + 0.4 * x[:, 1]).astype(float)
    trees = quality.fit(x, y, [-1, 0])
    grid = np.linspace(0, 1, 200)
    for other in (0.1, 0.5, 0.9):
        scores = trees.score(np.stack([grid, np.full(200, other)], axis=1))
        assert (np.diff(scores) <= 1e-9).all()
    assert ((trees.score(x) > 0) == (y > 0)).mean() > 0.85

    def walk(row, node):
        while trees.feature[node] >= 0:
            node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        return trees.value[node]

    one = trees.start + sum(walk(x[7], root) for root in trees.roots)
    assert trees.score(x[7:8])[0] == pytest.approx(one)


def test_every_language_is_learned(spark):
    """Rare languages are learned next to frequent ones, and repeated rows count once; more languages than
    the sample may have texts are refused."""
    alphabets = {"a": "abcde", "b": "fghij", "rare": "klmno"}
    rows = [(i, f"{w}{w[::-1]} {w} {i % 7}", lang) for lang, w in alphabets.items() for i in range(2 if lang == "rare" else 120)]
    rows += [(3, "abcde abcde", "a")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, per_language=10, most=30)
    assert model.languages == ["a", "b", "rare"]
    found = {r.doc_id: r.lang_pred for r in language.predict(spark.createDataFrame([(1, "klmno onmlk klm"), (2, "fghij jihgf")], "doc_id long, text string"), model).collect()}
    assert found == {1: "rare", 2: "b"}
    with pytest.raises(ValueError, match="languages"):
        language.train(docs, most=2)
    assert language.only_learned(docs, language.fit([])).count() == 0


def test_share_of_known_grams():
    assert language.upper_share(0, 0) == 1.0 and language.upper_share(10, 10) == pytest.approx(1.0)
    assert language.upper_share(50, 100) > 0.5 > language.upper_share(30, 100) > 0.3
    assert language.upper_share(5, 10) > language.upper_share(50, 100)
