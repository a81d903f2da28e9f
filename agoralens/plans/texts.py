"""Cleaning, emotion and language on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.stemming import (
    MEASURE_ABOVE_0,
    MEASURE_ABOVE_1,
    SHORT_ENDING,
    STEP_2,
    STEP_3,
    STEP_4,
    VOWEL,
    longest_first,
    stem_tokens,
)
from agoralens.functions.text import json_safe, joined_tokens, strip_markup, tokenize
from agoralens.operators import clean, emotion, engagement, heavy, language, stats, temporal
from agoralens.operators.emotion import EMOTIONS
from agoralens.operators.lookups import lookup_join
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources.scratch import stored
from agoralens.sources.tables import spread_few_files

# ---- cleaning --------------------------------------------------------------------------------

_JSON_SAFE = (
    "regexp_replace(replace(replace(replace(replace({x}, '\\n', ' '), '\\t', ' '), '\\\"', '\"'), "
    "'&nbsp;', ' '), '[{{}}]', ' ', 'g')"
)


def _json_safe_sql(x: str) -> str:
    return _JSON_SAFE.format(x=x)


def _strip_markup_sql(x: str) -> str:
    for pattern in ("http\\S+|www\\S+", "&amp;|&quot;|&gt;|&lt;", "[*_>\\[\\]()]"):
        x = f"regexp_replace({x}, '{pattern}', ' ', 'g')"
    return _json_safe_sql(x)


@question(f"SELECT page_id, {_json_safe_sql('html')} AS safe FROM pages")
def json_safe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread_few_files(roles.table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", json_safe("html").alias("safe"))


@question(f"SELECT page_id, {_strip_markup_sql('html')} AS raw_text FROM pages")
def strip_markup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread_few_files(roles.table(spark, sf_dir, "pages"), "page_id")
    return pages.select("page_id", strip_markup("html").alias("raw_text"))


@question(f"""
{roles.with_tables(roles.TEXT_COMMENTS)}
SELECT id, author FROM text_comments WHERE body <> '[removed]' AND body <> '[deleted]'""")
def drop_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = roles.comment_texts(spark, sf_dir)
    return clean.drop_removed(comments, "body").select("id", "author")


@question(f"SELECT doc_id, array_to_string({roles.tokens_sql('text')}, '@') AS tokens FROM documents")
def tokenized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = roles.documents(spark, sf_dir)
    return documents.select("doc_id", joined_tokens(tokenize("text")).alias("tokens"))


def _guard(condition: str, new: str, old: str = "w") -> str:
    return f"CASE WHEN {condition} THEN {new} ELSE {old} END"


def _but(n: int, w: str = "w") -> str:
    return f"left({w}, length({w}) - {n})"


def _suffix_sql(table: dict[str, str]) -> str:
    cases = " ".join(
        f"WHEN ends_with(w, '{s}') THEN "
        + _guard(f"regexp_matches({_but(len(s))}, '{MEASURE_ABOVE_0}')", f"{_but(len(s))} || '{table[s]}'")
        for s in longest_first(table)
    )
    return f"CASE {cases} ELSE w END"


def _drop_sql() -> str:
    cases = ""
    for s in longest_first(STEP_4):
        fits = f"regexp_matches({_but(len(s))}, '{MEASURE_ABOVE_1}')"
        if s == "ion":
            fits += f" AND regexp_matches({_but(3)}, '[st]$')"
        cases += f" WHEN ends_with(w, '{s}') THEN {_guard(fits, _but(len(s)))}"
    return f"CASE{cases} ELSE w END"


def stem_list_sql(words: str) -> str:
    """Porter's steps over a list of words, one list_transform per step."""
    def has(pattern: str, w: str) -> str:
        return f"regexp_matches({w}, '{pattern}')"

    rest = _but(1)
    double = (
        f"(length({rest}) > 1 AND right({rest}, 1) = left(right({rest}, 2), 1) "
        f"AND {has('[^aeiouY]$', rest)})"
    )
    short = (
        f"({has(MEASURE_ABOVE_0, rest)} AND NOT {has(MEASURE_ABOVE_1, rest)} "
        f"AND {has(SHORT_ENDING, rest)})"
    )
    steps = [
        _guard("length(w) > 2", "regexp_replace(w, '([^aeiou])y', '\\1Y', 'g')"),
        _guard(
            "length(w) <= 2", "w",
            f"CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {_but(2)} "
            f"WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {_but(1)} ELSE w END",
        ),
        f"CASE WHEN ends_with(w, 'eed') THEN {_guard(has(MEASURE_ABOVE_0, _but(3)), _but(1))} "
        f"WHEN ends_with(w, 'ed') THEN {_guard(has(VOWEL, _but(2)), _but(2) + " || '+'")} "
        f"WHEN ends_with(w, 'ing') THEN {_guard(has(VOWEL, _but(3)), _but(3) + " || '+'")} ELSE w END",
        f"CASE WHEN NOT ends_with(w, '+') THEN w WHEN {has('(at|bl|iz)$', rest)} THEN {rest} || 'e' "
        f"WHEN {double} AND NOT {has('[lsz]$', rest)} THEN {_but(2)} "
        f"WHEN {short} THEN {rest} || 'e' ELSE {rest} END",
        _guard(f"{has('[yY]$', 'w')} AND {has(VOWEL, rest)}", f"{rest} || 'i'"),
        _suffix_sql(STEP_2),
        _suffix_sql(STEP_3),
        _drop_sql(),
        _guard(
            f"ends_with(w, 'e') AND ({has(MEASURE_ABOVE_1, rest)} OR "
            f"({has(MEASURE_ABOVE_0, rest)} AND NOT {has(SHORT_ENDING, rest)}))",
            rest,
        ),
        _guard(f"ends_with(w, 'll') AND {has(MEASURE_ABOVE_1, 'w')}", rest),
        "replace(w, 'Y', 'y')",
    ]
    for step in steps:
        words = f"list_transform({words}, lambda w: {step})"
    return words


@question(f"""
SELECT doc_id, array_to_string({stem_list_sql(roles.tokens_sql('text'))}, '@') AS stems
FROM documents""")
def stemmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = roles.documents(spark, sf_dir)
    return documents.select("doc_id", joined_tokens(stem_tokens(tokenize("text"))).alias("stems"))


# The words of the test texts' four languages that count as stop words here. The
# operators' default is Spark's English list.
DEMO_STOP_WORDS = ("the", "and", "of", "in", "is", "on", "le", "la", "les", "de", "der", "die", "que")
_STOP_WORDS = ", ".join(f"'{w}'" for w in DEMO_STOP_WORDS)


def _clean_sql(raw: str) -> str:
    """One-string cleaned text of a raw text."""
    kept = f"list_filter({roles.tokens_sql(raw)}, lambda w: w NOT IN ({_STOP_WORDS}))"
    return f"array_to_string({stem_list_sql(kept)}, '@')"


@question(f"""
{roles.with_tables(roles.POST_TEXTS)}, raw AS (
  SELECT id, {_strip_markup_sql(_json_safe_sql('title') + " || ' ' || " + _json_safe_sql('selftext'))} AS raw_text
  FROM post_texts WHERE selftext NOT IN ('[removed]', '[deleted]'))
SELECT id, raw_text, {_clean_sql('raw_text')} AS clean_text FROM raw""")
def cleaned_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.clean_posts(roles.post_texts(spark, sf_dir), stop_words=DEMO_STOP_WORDS)
    return cleaned.select("id", "raw_text", "clean_text")


@question(f"""
{roles.with_tables(roles.TEXT_COMMENTS)}, raw AS (
  SELECT id, author, {_strip_markup_sql(_json_safe_sql('body'))} AS raw_text
  FROM text_comments WHERE body NOT IN ('[removed]', '[deleted]'))
SELECT id, author, raw_text, {_clean_sql('raw_text')} AS clean_text FROM raw""")
def cleaned_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.clean_comments(
        roles.comment_texts(spark, sf_dir), stop_words=DEMO_STOP_WORDS
    )
    return cleaned.select("id", "author", "raw_text", "clean_text")


@question(f"""
WITH words AS (SELECT unnest({roles.tokens_sql('text')}) AS word FROM documents),
counted AS (SELECT word, count(*) AS n FROM words GROUP BY 1)
SELECT word, n, {stem_list_sql('[word]')}[1] AS stem FROM counted""")
def stemmed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = roles.documents(spark, sf_dir)
    return clean.stemmed_vocabulary(documents.select(tokenize("text").alias("tokens")))


# ---- emotion ---------------------------------------------------------------------------------

def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.post_texts(spark, sf_dir)
    return posts.select("id", tokenize("selftext").alias("tokens"))


_WIDE = """docs AS (SELECT id, {tokens} AS tokens FROM post_texts),
hits AS (SELECT id, emotion FROM (SELECT id, unnest(tokens) AS word FROM docs) JOIN lexicon USING (word)),
per_doc AS (SELECT id, {sums}, count(*) AS emotion_token_count FROM hits GROUP BY 1),
wide AS (SELECT d.id, len(tokens) AS n_tokens, {names}, emotion_token_count
         FROM docs d LEFT JOIN per_doc p ON p.id = d.id)""".format(
    tokens=roles.tokens_sql("selftext"),
    sums=", ".join(f"count(*) FILTER (emotion = '{e}') AS {e}_count" for e in EMOTIONS),
    names=", ".join(f"{e}_count" for e in EMOTIONS),
)
_WITH_WIDE = roles.with_tables(roles.POST_TEXTS, roles.LEXICON, _WIDE)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emotion.wide_counts(_docs(spark, sf_dir), roles.lexicon(spark, sf_dir))


@question(f"{_WITH_WIDE} SELECT id, emotion, count(*) AS emotion_count FROM hits GROUP BY 1, 2")
def emotion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emotion.counts(_docs(spark, sf_dir), roles.lexicon(spark, sf_dir))


def _density_columns(bottom: str) -> str:
    return ", ".join(f"round({e}_count / {bottom} + 1e-9, 6) AS {e}_density" for e in EMOTIONS)


_DENSITIES = [f"{e}_density" for e in EMOTIONS]
_COUNTS = [f"{e}_count" for e in EMOTIONS]


@question(f"""{_WITH_WIDE}
SELECT id, coalesce(emotion_token_count, 0) AS emotion_token_count,
       greatest(coalesce(emotion_token_count, 0), 1) AS total_tokens, {", ".join(_COUNTS)},
       {_density_columns("emotion_token_count")}
FROM wide""")
def emotion_density_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = emotion.densities(_wide(spark, sf_dir), "matched")
    return settled(out, 6, *_DENSITIES).select(
        "id", "emotion_token_count", "total_tokens", *_COUNTS, *_DENSITIES
    )


@question(f"""{_WITH_WIDE}
SELECT id, coalesce(emotion_token_count, 0) AS emotion_token_count,
       greatest(n_tokens, 1)::bigint AS total_tokens,
       round(coalesce(emotion_token_count, 0) / greatest(n_tokens, 1) + 1e-9, 6) AS emotional_vocab_density,
       {_density_columns("greatest(n_tokens, 1)")}
FROM wide""")
def emotion_density_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = emotion.densities(_wide(spark, sf_dir), "tokens")
    return settled(out, 6, "emotional_vocab_density", *_DENSITIES).select(
        "id", "emotion_token_count", "total_tokens", "emotional_vocab_density", *_DENSITIES
    )


_TIMED = _WIDE + f""",
timed AS (SELECT hour(created)::int AS hour, month(created)::int AS month,
                 (dayofweek(created) + 1)::int AS weekday_num, strftime(created, '%a') AS weekday,
                 {", ".join(f"{e}_count / emotion_token_count AS {e}_density" for e in EMOTIONS)}
          FROM wide LEFT JOIN post_meta USING (id))"""
_WITH_TIMED = roles.with_tables(roles.POST_TEXTS, roles.POST_META, roles.LEXICON, _TIMED)
_PROFILE = ", ".join(f"round(avg({e}_density) + 1e-9, 6) AS {e}_avg" for e in EMOTIONS)


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities with time keys; the join with the facts happens after texts became counts."""
    scored = emotion.densities(_wide(spark, sf_dir), "matched")
    created = roles.post_meta(spark, sf_dir).select("id", "created")
    return temporal.add_time_keys(scored.join(created, "id", "left"))


def _profile(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    out = emotion.temporal_profile(_timed(spark, sf_dir), list(by))
    return settled(out, 6, *[f"{e}_avg" for e in EMOTIONS])


@question(f"{_WITH_TIMED} SELECT hour, {_PROFILE} FROM timed GROUP BY 1")
def emotion_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "hour")


@question(f"{_WITH_TIMED} SELECT month, {_PROFILE} FROM timed GROUP BY 1")
def emotion_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "month")


@question(f"{_WITH_TIMED} SELECT weekday_num, weekday, {_PROFILE} FROM timed GROUP BY 1, 2")
def emotion_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "weekday_num", "weekday")


@question(
    _WITH_WIDE
    + " UNION ALL ".join(
        f"SELECT '{e}_density' AS emotion_density, "
        f"round(avg({e}_count / greatest(n_tokens, 1)) + 1e-9, 6) AS mean_value FROM wide"
        for e in EMOTIONS
    )
)
def mean_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = emotion.densities(_wide(spark, sf_dir), "tokens")
    return settled(emotion.mean_density(scored), 6, "mean_value")


@question(f"""{_WITH_WIDE},
d AS (SELECT anger_count / emotion_token_count AS x FROM wide WHERE emotion_token_count IS NOT NULL),
edges AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50.0::double AS w FROM d)
SELECT bin, round(lo + bin * w + 1e-9, 6) AS bin_start, round(lo + (bin + 1) * w + 1e-9, 6) AS bin_end, n
FROM (SELECT least(49, floor((x - lo) / w))::int AS bin, count(*) AS n FROM d, edges GROUP BY 1), edges""")
def emotion_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each of 50 bins of anger density that is in use."""
    scored = emotion.densities(_wide(spark, sf_dir), "matched")
    scored = stored(scored.select("anger_density"))
    return settled(stats.histogram(scored, "anger_density", 50), 6, "bin_start", "bin_end")


@question(f"""{_WITH_WIDE}
SELECT id, sign(coalesce(positive_count - negative_count, 0))::int AS polarity,
       round(coalesce((positive_count - negative_count) / emotion_token_count, 0) + 1e-9, 6) AS polarity_score
FROM wide""")
def emotion_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = emotion.polarity(emotion.densities(_wide(spark, sf_dir), "matched"))
    return settled(out, 6, "polarity_score").select("id", "polarity", "polarity_score")


_SENTIMENT = _WIDE + """,
s AS (SELECT sign(coalesce(positive_count - negative_count, 0))::int AS x, score::double AS score,
             num_comments::double AS num_comments
      FROM wide JOIN post_meta USING (id)),
r AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r_score,
             rank() OVER (ORDER BY num_comments)
               + (count(*) OVER (PARTITION BY num_comments) - 1) / 2.0 AS r_num_comments
      FROM s)"""


@question(
    roles.with_tables(roles.POST_TEXTS, roles.POST_META, roles.LEXICON, _SENTIMENT)
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, count(*) AS n, round(corr(x, {m}) + 1e-9, 6) AS pearson, "
        f"round(regr_slope({m}, x) + 1e-9, 6) AS slope, round(corr(x, {m}) ** 2 + 1e-9, 6) AS r2, "
        f"round(corr(rx, r_{m}) + 1e-9, 6) AS spearman FROM r"
        for m in ("score", "num_comments")
    )
)
def sentiment_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = emotion.polarity(emotion.densities(_wide(spark, sf_dir), "matched"))
    joined = scored.select("id", "polarity").join(roles.post_meta(spark, sf_dir), "id")
    # Ranks pass over the scores several times; the texts are read once.
    joined = stored(joined.select("polarity", "score", "num_comments"))
    out = engagement.sentiment_correlation(joined, "polarity", ["score", "num_comments"])
    return settled(out, 6, "pearson", "slope", "r2", "spearman")


# ---- language --------------------------------------------------------------------------------

def _styled(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.post_texts(spark, sf_dir)
    raw = posts.withColumns({"raw_text": roles.document_of(), "tokens": tokenize("selftext")})
    return language.style_features(raw)


_STYLE = f"""style AS (
  SELECT id, tokens_n AS post_length_tokens, length(raw)::int AS post_length_chars,
         length(regexp_replace(raw, '[^?]', '', 'g'))::int AS question_count,
         greatest(length(regexp_replace(raw, '[^.!?]', '', 'g')), 1)::int AS sentence_punct_count
  FROM (SELECT id, title || ' ' || selftext AS raw,
               len({roles.tokens_sql('selftext')})::int AS tokens_n FROM post_texts))"""


@question(f"""
{roles.with_tables(roles.POST_TEXTS, _STYLE)}
SELECT *, round(greatest(post_length_tokens, 1) / sentence_punct_count + 1e-9, 6) AS readability_score
FROM style""")
def style_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(_styled(spark, sf_dir), 6, "readability_score").select(
        "id", "post_length_tokens", "post_length_chars", "question_count",
        "sentence_punct_count", "readability_score",
    )


# Names and limits of the style groups.
_STYLE_LABELS = {
    "post_length_tokens": "postlength",
    "emotional_vocab_density": "emotionalworddensity",
    "sentence_punct_count": "sentencemarks",
    "readability_score": "readabilityscore",
}


@question(
    roles.with_tables(roles.POST_TEXTS, roles.POST_META, roles.LEXICON, _WIDE, _STYLE)
    + """, f AS (SELECT s.*, greatest(post_length_tokens, 1) / sentence_punct_count AS readability_score,
        coalesce(emotion_token_count, 0) / greatest(n_tokens, 1) AS emotional_vocab_density,
        coalesce(num_comments, 0) AS num_comments
      FROM style s JOIN wide w USING (id) LEFT JOIN post_meta m USING (id))
"""
    + " UNION ALL ".join(
        f"SELECT '{label}' AS feature, round(avg({c}) + 1e-9, 4) AS mean, "
        f"round(stddev_samp({c}) + 1e-9, 4) AS std, "
        f"round(corr({c}, num_comments) + 1e-9, 6) AS corr_with_num_comments FROM f"
        for c, label in _STYLE_LABELS.items()
    )
)
def style_engagement_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Style and emotion features per post against its comments."""
    styled = _styled(spark, sf_dir)
    kept = ["post_length_tokens", "sentence_punct_count", "readability_score"]
    wide = emotion.wide_counts(styled, roles.lexicon(spark, sf_dir), keep=kept)
    scored = emotion.densities(wide, "tokens").select("id", "emotional_vocab_density", *kept)
    comments = roles.post_meta(spark, sf_dir).select("id", "num_comments")
    joined = scored.join(comments, "id", "left").fillna(0, subset=["num_comments"])
    out = stats.feature_target_table(joined, _STYLE_LABELS, "num_comments")
    return settled(settled(out, 4, "mean", "std"), 6, "corr_with_num_comments")


def _lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical features with the engagement half of each post."""
    posts = roles.post_texts(spark, sf_dir).withColumn("tokens", tokenize("selftext"))
    features = language.lexical_features(posts).select(
        "id", "word_count", "unique_words", "unique_ratio", "question_marks"
    )
    return features.join(_engaged(spark, sf_dir), "id")


def _engaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement half of the posts that have a text."""
    ids = roles.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    facts = roles.post_meta(spark, sf_dir).join(ids, "id", "left_semi")
    return engagement.split_at_quantile(facts).select("id", "engagement")


_ENGAGED = """engaged AS (
  SELECT id, CASE WHEN num_comments >= (SELECT quantile_cont(num_comments, 0.5) FROM post_meta
                                        WHERE id IN (SELECT id FROM post_texts))
                  THEN 'high' ELSE 'low' END AS engagement
  FROM post_meta WHERE id IN (SELECT id FROM post_texts))"""
_LEXICAL = f"""lexical AS (
  SELECT id, len(tokens)::int AS word_count, len(list_distinct(tokens))::int AS unique_words,
         len(list_distinct(tokens)) / nullif(len(tokens), 0) AS unique_ratio,
         length(regexp_replace(title, '[^?]', '', 'g'))::int AS question_marks, engagement, tokens
  FROM (SELECT id, title, {roles.tokens_sql('selftext')} AS tokens FROM post_texts)
  JOIN engaged USING (id))"""
_WITH_LEXICAL = roles.with_tables(roles.POST_TEXTS, roles.POST_META, _ENGAGED, _LEXICAL)


@question(f"""{_WITH_LEXICAL}
SELECT id, word_count, unique_words, round(unique_ratio + 1e-9, 6) AS unique_ratio, question_marks,
       engagement
FROM lexical""")
def lexical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(_lexical(spark, sf_dir), 6, "unique_ratio")


@question(f"""{_WITH_LEXICAL}
SELECT engagement, round(avg(word_count), 2) AS avg_word_count,
       round(avg(unique_ratio), 3) AS avg_unique_ratio,
       round(avg(question_marks), 3) AS avg_question_marks
FROM lexical GROUP BY 1""")
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.group_stats(_lexical(spark, sf_dir), rounded=True)


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted per post half. Posts get their half first, so that only counts of distinct words are
    shuffled."""
    halves = stored(_engaged(spark, sf_dir), "halves")
    return language.word_counts(lookup_join(_docs(spark, sf_dir), halves, ["id"]))


_COUNTED = """counted AS (
  SELECT engagement, word, count(*) AS count
  FROM (SELECT engagement, unnest(tokens) AS word FROM lexical) GROUP BY 1, 2)"""


@question(f"{_WITH_LEXICAL}, {_COUNTED} SELECT * FROM counted")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_counts(spark, sf_dir)


def _top_sql(k: int) -> str:
    return f"""{_WITH_LEXICAL}, {_COUNTED}
SELECT engagement, word, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY engagement ORDER BY count DESC, encode(word))::int AS rank
  FROM counted) WHERE rank <= {k}"""


@question(_top_sql(50))
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.top_words(_word_counts(spark, sf_dir), 50)


@question(_top_sql(20))
def top_words_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.top_words(_word_counts(spark, sf_dir), 20)


@question(_top_sql(50))
def top_words_by_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, counting only words that can be among the 50: no vocabulary is shuffled."""
    halves = stored(_engaged(spark, sf_dir), "halves")
    return heavy.most_frequent(lookup_join(_docs(spark, sf_dir), halves, ["id"]), 50)
