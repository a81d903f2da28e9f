from agoralens.llm import url_filter as uf
from tests.conftest import plan, rows


def test_verdicts(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://WWW.Bad.net/a.html?x=1#y"), (2, "https://bad.net/a/"), (3, "https://bad.net/a/b"), (4, None), (5, ""),
            (6, "no scheme"), (7, "http://a.example.org/es/1"), (8, "http://example.org/en/12"), (9, "http://org/"), (10, "http://org"),
            (11, "http://myorg/es/"), (12, "http://x.com/de/1"), (13, "http://x.com/fr/"), (2, "https://bad.net/a/"), (None, "http://bad.net/a"),
        ],
        "page_id long, url string",
    ).selectExpr("*", "'x' AS host", "'y' AS canonical", "1 AS listed", "2 AS block")
    listed = spark.createDataFrame([("bad.net/a",), ("other.net/",)], "canonical string")
    rules = [uf.Rule("org", "/", "allow"), uf.Rule("example.org", "/es/", "block"), uf.Rule("example.org", "/en/1", "block"), uf.Rule("com", "/fr/", "allow"), uf.Rule("com", "/de/", "block")]
    found = uf.judge(pages, listed, rules)
    by = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert found.count() == 15
    assert [i for i in by if by[i] == (None, "block")] and {i for i in by if by[i] == (None, "block")} == {1, 2, None}
    assert by[3] == by[4] == by[5] == by[6] == by[10] == by[11] == (None, "allow")
    assert by[7] == ("example.org/es/", "block") and by[8] == ("example.org/en/1", "block") and by[9] == ("org/", "allow")
    assert by[12] == ("com/de/", "block") and by[13] == ("com/fr/", "allow")
    none = uf.judge(pages, listed.limit(0), [])
    assert {r.verdict for r in none.collect()} == {"allow"}
    assert uf.judge(pages.limit(0), listed, rules).count() == 0
    assert "Python" not in plan(found)


def test_filter_has_no_false_negatives_and_few_positives(spark):
    from pyspark.sql import functions as F

    listed = spark.range(20_000).select(F.concat(F.lit("h.org/"), "id").alias("canonical"))
    filters = uf.bloom(listed)
    assert filters.count() <= 20_000 / uf.PER_BLOCK + 1
    probe = spark.range(40_000).select(F.concat(F.lit("h.org/"), "id").alias("url_key"), (F.col("id") < 20_000).alias("true"))
    blocks = filters.agg(F.max("blocks")).first()[0]
    hit = F.lit(True)
    for i, bit in enumerate(uf._bits(F.col("url_key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    seen = probe.withColumn("block", uf._block(F.col("url_key"), F.lit(blocks))).join(filters, "block").where(hit)
    counts = dict(rows(seen.groupBy("true").count()))
    assert counts[True] == 20_000 and counts.get(False, 0) < 400
    assert {r.listed for r in uf.is_listed(probe, listed).where("`true`").collect()} == {True}
    assert {r.listed for r in uf.is_listed(probe, listed, max_rows=1).where("NOT `true`").collect()} == {False}
