import sys

import pytest
import sentencepiece

sys.path.insert(0, ".")
import corpus_pipeline as pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from agoralens.llm import language, questions  # noqa: E402
from agoralens.sources import scratch  # noqa: E402
from tests.compare import connect, difference  # noqa: E402
from tests.llm.test_minhash import brute  # noqa: E402
from tests.llm.test_personal_data import brute as personal  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in pipeline.STAGES:
        before = docs
        docs = pipeline._stored(spark, stage(spark, docs, SF), "test")
        kept.append((before, docs))
        if name != "pieces":
            assert docs.columns == columns
    texts = {r.doc_id: r.text for r in kept[0][0].collect()}
    spoken = {r.doc_id: r.text for r in kept[0][1].collect()}
    assert set(texts) - set(spoken) <= {i for i, t in texts.items() if sum(c.isalpha() for c in t or "") < 20}
    groups = brute(list(spoken.items()), 80)
    single = {r.doc_id: r.text for r in kept[1][1].collect()}
    assert set(single) == {i for i, _, top in groups if i == top}
    masked = kept[2][1].collect()
    assert {r.doc_id for r in masked} == set(single)
    assert all(not personal(r.text) and r.n_chars == len(r.text) for r in masked)
    assert all(r.text == single[r.doc_id] for r in masked if not personal(single[r.doc_id]) and "AKIA" not in single[r.doc_id])
    mixed = kept[3][1].collect()
    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.MODEL)
    ours = sorted((r.doc_id, list(r.ids), r.decoded) for r in kept[4][1].collect())
    assert ours == sorted((r.doc_id, library.encode(r.text), r.text) for r in mixed)


def test_empty_table(spark, empty):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        docs = pipeline._stored(spark, stage(spark, docs, SF), "test")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(questions.QUESTIONS))
def test_queries(spark, name):
    df = questions.QUESTIONS[name](spark, SF)
    if name in questions.SQL:
        assert difference(df, connect(SF), questions.SQL[name]) is None
    else:
        assert df.count() == 200


FOREIGN = [
    "De snelle bruine vos springt over de luie hond en rent daarna door het bos naar huis.",
    "Ik heb gisteren een boek gelezen over de geschiedenis van Nederland.",
    "Wczoraj poszedłem do sklepu, aby kupić chleb i mleko dla całej rodziny.",
    "Bugün hava çok güzel, bu yüzden çocuklarla birlikte parka gidiyoruz.",
    "Oggi il tempo è bello e andiamo con i bambini al mare per nuotare.",
    "Idag är det vackert väder och vi går med barnen till stranden för att bada.",
    "Сегодня хорошая погода, и мы идём с детьми на пляж.",
]


def test_unlearned_languages_go(spark):
    """Foreign texts go and learned ones stay, short ones too, with or without an id and next to a good
    row of the same id; other columns may have any name."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    short = [(None, " ".join(r.text.split()[:12])) for r in docs.where("doc_id % 100 = 3").collect()]
    odd = [(5, t) for t in FOREIGN] + [(None, t) for t in FOREIGN] + [(5, None), (None, ""), (None, "123 !")] + short
    odd = spark.createDataFrame([(i, t, None, "x", 0) for i, t in odd], docs.schema)
    got = pipeline.known_language(spark, docs.unionByName(odd).withColumn("a.b", F.lit(1)), SF)
    assert got.columns == [*docs.columns, "a.b"]
    texts = {r.text for r in got.collect()}
    assert not texts & set(FOREIGN) and None not in texts and "" not in texts and "123 !" not in texts
    assert len({t for _, t in short} & texts) >= 0.9 * len(short)
    clean = [r.text for r in docs.collect() if sum(c.isalpha() for c in r.text or "") > 20]
    assert sum(t in texts for t in clean) >= 0.999 * len(clean)


def test_language_stage_goes_by_predictions(spark):
    """A text stays by its predicted language and score, not by its 3-grams alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where(~language.held_out("doc_id")))
    few = docs.limit(20).withColumn("a.b", F.lit(1))
    assert 0 < model.least <= language.LEAST_SCORE
    assert language.only_learned(few, model).count() == 20
    assert language.only_learned(few, model._replace(weights=0 * model.weights)).count() == 0
    odd = spark.createDataFrame([(-1, "a", None, "x", 1), (-2, "The a", None, "x", 5), (-3, None, None, "x", 0)], docs.schema)
    every = docs.unionByName(odd)
    kept = {r.doc_id for r in pipeline.known_language(spark, every, SF).select("doc_id").collect()}
    found = {r.doc_id: r for r in language.predict(every, model).collect()}
    assert found[-1].score < model.least and -1 not in kept and -3 not in kept
    assert all(found[i].lang_pred != "und" and found[i].score >= model.least for i in kept)
    assert len(kept) >= docs.count() - 2


def test_dotted_names_and_no_ids(spark):
    """All stages keep rows without ids and columns of any name; their inner tables are deleted."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("a.b", F.lit("x"))
    docs = docs.unionByName(docs.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
    for name, stage in pipeline.STAGES:
        before = docs.count()
        docs = pipeline._stored(spark, stage(spark, docs, SF), "test")
        if name != "pieces":
            assert "a.b" in docs.columns
        if name in ("language", "near duplicates", "personal data"):
            assert docs.where("doc_id IS NULL").count() == 5 and docs.count() <= before


def test_run_leaves_one_table(spark):
    rows = spark.conf.get(pipeline.BATCH_ROWS)
    before = scratch.made_so_far()
    assert pipeline.run(spark, SF).count() > 0
    assert scratch.made_so_far() <= before + 1 and spark.conf.get(pipeline.BATCH_ROWS) == rows
