import random
import re

from pyspark.sql import functions as F

from agoralens.functions import text
from agoralens.functions.stemming import stem, stem_tokens
from agoralens.operators import clean, language
from tests.conftest import plan, rows

# Word pairs printed in the publication of the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "radicalli": "radic", "vileli": "vile", "vietnamization": "vietnam", "operator": "oper",
    "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "replacement": "replac", "adoption": "adopt", "communism": "commun", "activate": "activ",
    "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "guy": "gui", "always": "alwai", "is": "is", "as": "as",
    "y": "y", "yy": "yy", "": "",
}


def test_stems(spark):
    df = spark.createDataFrame(list(STEMS.items()), "word string, stem string")
    assert rows(df.where(stem("word") != F.col("stem")).select("word", stem("word"))) == []


def test_stemming_stays_in_the_jvm_and_needs_no_shuffle(spark):
    df = spark.createDataFrame([(["cats"],)], "tokens array<string>")
    shown = plan(df.select(stem_tokens(F.col("tokens")).alias("t")))
    assert "Python" not in shown and "Exchange" not in shown


def test_null_word_has_null_stem(spark):
    df = spark.createDataFrame([(None,)], "word string")
    assert rows(df.select(stem("word"))) == [(None,)]


def test_joined_tokens(spark):
    df = spark.createDataFrame([("a@b@@c",), ("",), (None,), ("@",)], "t string")
    kept = df.select("t", text.tokens_of("t").alias("x"), text.tokens_of("t", True).alias("y"))
    assert {r.t: (r.x, r.y) for r in kept.collect()} == {
        "a@b@@c": (["a", "b", "c"], ["a", "b", "", "c"]),
        "": ([], []),
        None: ([], []),
        "@": ([], ["", ""]),
    }
    assert df.select(text.joined_tokens(text.tokens_of("t"))).first()[0] == "a@b@c"


def test_removed_rows_and_nulls_go(spark):
    df = spark.createDataFrame([("[removed]",), ("[deleted]",), (None,), ("ok",)], "body string")
    assert rows(clean.drop_removed(df, "body")) == [("ok",)]


def test_markup(spark):
    raw = "see http://x.y/z www.q *b* &amp; [l](u) a\\nb\nc {x} \\\"q &nbsp;_"
    df = spark.createDataFrame([(raw,), (None,)], "t string")
    got = [r[0] for r in df.select(text.strip_markup("t")).collect()]
    assert got[1] is None
    assert got[0].split() == ["see", "b", "l", "u", "a", "b", "c", "x", '"q']
    assert "\n" in got[0]


def test_tokens_are_letters_only(spark):
    df = spark.createDataFrame([("I DON'T know, 25f: café!  --",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(text.tokenize("t")).collect()]
    assert got == [["i", "dont", "know", "f", "café"], [], []]


def test_word_count_keeps_edge_pieces(spark):
    samples = ["", " a b ", "a", "a-b", "!!", "one  two\nthree.", "é"]
    df = spark.createDataFrame([(s, None) for s in samples], "t string, b string")

    def slow(t, b=""):
        return len(re.split(r"\s+", re.sub("[^A-Za-z0-9]+", " ", f"{t} {b}")))

    assert [r[0] for r in df.select(text.word_count("t", "b")).collect()] == [slow(s) for s in samples]


def test_word_count_against_plain_python(spark):
    pick = random.Random(1)
    samples = ["".join(pick.choice("ab Z9.,\n\té_") for _ in range(pick.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    slow = [len(re.split(r"\s+", re.sub("[^A-Za-z0-9]+", " ", s))) for s in samples]
    assert [r[0] for r in df.select(text.word_count("t")).collect()] == slow


def test_clean_posts(spark):
    df = spark.createDataFrame(
        [(1, "My Cats", "were running &amp; *jumping*"), (2, "x", "[removed]"), (3, None, "the")],
        "id int, title string, selftext string",
    )
    got = {r.id: (r.tokens, r.clean_text) for r in clean.clean_posts(df).collect()}
    assert got == {1: (["cat", "run", "jump"], "cat@run@jump"), 3: ([], "")}


def test_clean_comments_keeps_words_that_only_look_like_stop_words(spark):
    # The apostrophe goes before stop words are looked up, so "dont" stays.
    df = spark.createDataFrame([("I don't care",)], "body string")
    assert clean.clean_comments(df).first().tokens == ["dont", "care"]


def test_vocabulary(spark):
    df = spark.createDataFrame([(["cats", "cat", "cats"],)], "tokens array<string>")
    assert rows(clean.stemmed_vocabulary(df)) == [("cat", 1, "cat"), ("cats", 2, "cat")]


def test_style_and_lexical_features(spark):
    df = spark.createDataFrame(
        [(1, "Why? Because. So!", ["why", "so", "so"], "a?b?"), (2, "none", [], None)],
        "id int, raw_text string, tokens array<string>, title string",
    )
    got = {r.id: r for r in language.lexical_features(language.style_features(df)).collect()}
    assert (got[1].question_count, got[1].sentence_punct_count, got[1].readability_score) == (1, 3, 1.0)
    assert (got[1].word_count, got[1].unique_words, got[1].question_marks) == (3, 2, 2)
    assert (got[2].readability_score, got[2].unique_ratio, got[2].question_marks) == (1.0, None, None)


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame(
        [("high", ["b", "a", "c", "c"]), ("low", ["z"])], "engagement string, tokens array<string>"
    )
    top = language.top_words(language.word_counts(df), 2)
    assert rows(top) == [("high", "a", 1, 2), ("high", "c", 2, 1), ("low", "z", 1, 1)]
    assert "WindowGroupLimit" in plan(top)


def test_word_counts_can_keep_empty_tokens(spark):
    df = spark.createDataFrame([("high", ["a", ""])], "engagement string, tokens array<string>")
    assert len(rows(language.word_counts(df))) == 1
    assert len(rows(language.word_counts(df, keep_empty=True))) == 2


def test_first_match(spark):
    from agoralens.operators.engagement import classify

    df = spark.createDataFrame([("My wife and our divorce",), ("MOM",), (None,)], "t string")
    assert [r[0] for r in df.select(classify("t")).collect()] == ["breakup", "family", "other"]
