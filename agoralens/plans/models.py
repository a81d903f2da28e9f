"""Features, labels, models and evaluation on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.functions.keys import strip_kind
from agoralens.operators import clean, features, ml, split, stats
from agoralens.plans import roles
from agoralens.plans.overview import settled
from agoralens.plans.registry import question
from agoralens.sources.scratch import stored

# ---- features --------------------------------------------------------------------------------

_MEANS = ("comment_score_mean", "comment_len_mean", "comment_contro_mean", "comment_is_op_ratio")
_SUMS = ("comment_score_sum", "comment_len_sum")


def _threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.comment_features(roles.comments(spark, sf_dir), roles.bare_posts(spark, sf_dir))
    return settled(settled(out, 4, *_MEANS), 2, *_SUMS)


_THREADS = """threads AS (
  SELECT link_id, round(avg(c.score) + 1e-9, 4) AS comment_score_mean,
         max(c.score) AS comment_score_max, round(sum(c.score) + 1e-9, 2) AS comment_score_sum,
         round(avg(length) + 1e-9, 4) AS comment_len_mean, max(length) AS comment_len_max,
         round(sum(length) + 1e-9, 2) AS comment_len_sum,
         count(DISTINCT c.author) AS comment_author_nunique,
         round(avg(coalesce((c.author = p.author)::int, 0)) + 1e-9, 4) AS comment_is_op_ratio,
         round(avg(controversiality) + 1e-9, 4) AS comment_contro_mean,
         max(controversiality) AS comment_contro_max,
         sum(controversiality)::bigint AS comment_contro_sum
  FROM comments c LEFT JOIN (SELECT id::varchar AS id, author FROM posts) p ON p.id = c.link_id
  GROUP BY link_id)"""
_WITH_THREADS = roles.with_tables(roles.POSTS, roles.COMMENTS, _THREADS)


@question(f"{_WITH_THREADS} SELECT * FROM threads")
def comment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _threads(spark, sf_dir)


@question(
    f"{_WITH_THREADS} SELECT id, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in features.COMMENT_FEATURES)
    + " FROM (SELECT id FROM posts) LEFT JOIN threads ON link_id = id::varchar"
)
def posts_with_comment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.bare_posts(spark, sf_dir).select("id")
    return features.with_comment_features(posts, _threads(spark, sf_dir))


@question(f"""
{roles.with_tables(roles.POSTS, roles.COMMENTS)}
SELECT link_id, count(*) AS n
FROM comments c JOIN posts p ON p.id::varchar = c.link_id
WHERE epoch(c.created) - epoch(p.created) BETWEEN 0 AND 86400 * 365
GROUP BY 1""")
def comments_within_a_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts, comments = roles.bare_posts(spark, sf_dir), roles.comments(spark, sf_dir)
    early = features.comments_within(comments, posts, 86_400 * 365)
    return early.groupBy("link_id").agg(F.count("*").alias("n"))


def _post_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text features are taken before the facts are joined on, so the join is narrow."""
    created = roles.post_meta(spark, sf_dir).select("id", "created", "num_comments")
    cleaned = clean.clean_posts(roles.post_texts(spark, sf_dir), stop_words=())
    measured = features.post_text_features(cleaned).select("id", "clean_text", *features.POST_TEXT_FEATURES)
    return features.post_time_features(measured.join(created, "id", "left"))


@question(f"""
{roles.with_tables(roles.POST_TEXTS, roles.POST_META)}, marked AS (
  SELECT id, title, selftext,
         replace(title, '&nbsp;', ' ') || ' ' || replace(selftext, '&nbsp;', ' ') AS whole,
         created
  FROM post_texts LEFT JOIN post_meta USING (id)
  WHERE selftext NOT IN ('[removed]', '[deleted]'))
SELECT id, len({roles.tokens_sql('whole')})::int AS token_count_before_markup,
       len(string_split_regex(title, '\\s+'))::int AS title_token_count,
       length(title)::int AS title_char_len, contains(title, '?')::int AS title_has_question_mark,
       len(string_split_regex(selftext, '\\s+'))::int AS selftext_token_count,
       length(selftext)::int AS selftext_char_len, contains(whole, '?')::int AS has_question_mark,
       len(string_split(whole, '.'))::int AS sentence_count, hour(created)::int AS post_hour,
       (dayofweek(created) + 1)::int AS post_dow,
       (dayofweek(created) IN (0, 6))::int AS is_weekend
FROM marked""")
def post_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from agoralens.functions.text import document_text, tokenize

    whole = F.replace(document_text("title", "selftext"), F.lit("&nbsp;"), F.lit(" "))
    posts = clean.drop_removed(roles.post_texts(spark, sf_dir), "selftext")
    marked = posts.withColumns({"raw_text": whole}).withColumn("tokens", tokenize("raw_text"))
    created = roles.post_meta(spark, sf_dir).select("id", "created")
    # The join carries numbers, no texts.
    measured = features.post_text_features(marked).select("id", *features.POST_TEXT_FEATURES)
    out = features.post_time_features(measured.join(created, "id", "left"))
    kept = [c for c in features.POST_FEATURES if c not in ("token_count", "char_len_clean")]
    return out.select("id", F.col("token_count").alias("token_count_before_markup"), *kept)


def _comment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts become numbers before the facts are joined on, so the join is narrow."""
    measured = features.body_features(roles.comment_texts(spark, sf_dir)).drop("body")
    joined = measured.join(roles.comment_facts(spark, sf_dir), "place", "left")
    return features.context_features(joined)


@question(f"""
{roles.with_tables(roles.TEXT_COMMENTS)}
SELECT id, score, gilded, length(body)::int AS body_length,
       regexp_matches(body, '[!?]')::int AS punctuation_count,
       contains(body, '?')::int AS contains_question,
       regexp_matches(lower(body), 'toxic|abusive|gaslight')::int AS negativity,
       len(regexp_extract_all(body, '\\S+'))::int AS num_words,
       starts_with(parent_id, 't3_')::int AS is_top_level, hour(created)::int AS hour,
       controversiality AS label
FROM text_comments""")
def comment_row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _comment_features(spark, sf_dir)
    return out.select(
        "id", *features.COMMENT_ROW_FEATURES, "contains_question", "negativity", "label"
    )


@question("""
SELECT doc_id, regexp_matches(lower(text), 'that|with')::int AS flag FROM documents""")
def keyword_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = roles.table(spark, sf_dir, "documents")
    return documents.select("doc_id", features.keyword_flag("text", ("that", "with")).alias("flag"))


@question(f"""
WITH RECURSIVE r AS (
  SELECT conv_id, turn, conv_id || '_' || turn AS id, CASE WHEN turn > 0
         THEN conv_id || '_' || (turn - 1) END AS up FROM conversations),
d AS (SELECT id, 1::bigint AS depth FROM r WHERE up IS NULL OR up NOT IN (SELECT id FROM r)
      UNION ALL SELECT r.id, d.depth + 1 FROM r JOIN d ON r.up = d.id)
SELECT id, depth FROM d""")
def thread_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.thread_depth(roles.replies(spark, sf_dir))


# ---- labels and splits -----------------------------------------------------------------------

_LABELLED = """labelled AS (
  SELECT id, num_comments, least(round(score / 500000, 3), 1) AS probability_positive,
         CASE WHEN num_comments >= (SELECT quantile_cont(num_comments, 0.75) FROM posts)
              THEN 1.0::double ELSE 0.0::double END AS label FROM posts),
scored AS (SELECT *, CASE WHEN probability_positive >= 0.5 THEN 1.0::double ELSE 0.0::double END AS prediction
           FROM labelled)"""
_WITH_SCORED = roles.with_tables(roles.POSTS, _LABELLED)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = roles.posts(spark, sf_dir).select("id", "score", "num_comments")
    # Comments are counted once, for the threshold and for the labels.
    return ml.quantile_label(stored(posts))


def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled posts with a fixed rule in place of a model."""
    probability = F.least(F.round(F.col("score") / 500_000, 3), F.lit(1.0))
    scored = _labelled(spark, sf_dir).withColumn("probability_positive", probability)
    guess = F.when(F.col("probability_positive") >= 0.5, 1.0).otherwise(0.0)
    return scored.withColumn("prediction", guess)


@question(f"{_WITH_SCORED} SELECT id, num_comments, label FROM scored")
def quantile_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("id", "num_comments", "label")


@question(f"""{_WITH_SCORED}
SELECT label, count(*) AS n,
       round(CASE WHEN label = 1 THEN (SELECT count(*) FILTER (label = 0) / count(*) FILTER (label = 1)
                                       FROM scored) ELSE 1 END + 1e-9, 6) AS weight
FROM scored GROUP BY 1""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(ml.class_weights(_labelled(spark, sf_dir)), 6, "weight")


@question("""
WITH s AS (SELECT (SELECT count(*) FROM labels WHERE toxic = 0)
                  / (SELECT count(*) FROM labels WHERE toxic = 1) AS w)
SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN floor(w)::bigint
         + (('0x' || substr(md5(doc_id::varchar || 'o'), 1, 8))::bigint % 10000
            < (w - floor(w)) * 10000)::bigint ELSE 1 END AS copies
FROM labels, s""")
def oversampled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = roles.table(spark, sf_dir, "labels")
    repeated = ml.oversample(labels, "doc_id", "toxic")
    return repeated.groupBy("doc_id", "toxic").agg(F.count("*").alias("copies"))


@question("""
SELECT o_orderkey AS id, CASE WHEN ('0x' || substr(md5(o_orderkey::varchar || 's42'), 1, 8))::bigint
                              % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
FROM orders""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign_split(roles.bare_posts(spark, sf_dir), "id").select("id", "split")


# ---- evaluation of the rule ------------------------------------------------------------------

@question(f"{_WITH_SCORED} SELECT label, prediction, count(*) AS count FROM scored GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.confusion_matrix(_rule_scored(spark, sf_dir))


@question(f"""{_WITH_SCORED},
c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (label = 1 AND prediction = 0) AS fn,
             count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) AS n FROM scored)
SELECT n, round((tp + tn) / n + 1e-9, 6) AS accuracy, round(tp / (tp + fp) + 1e-9, 6) AS precision,
       round(tp / (tp + fn) + 1e-9, 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn) + 1e-9, 6) AS f1_positive,
       round(((tp + fn) * 2 * tp / (2 * tp + fp + fn) + (tn + fp) * 2 * tn / (2 * tn + fp + fn)) / n
             + 1e-9, 6) AS f1
FROM c""")
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ml.binary_metrics(_rule_scored(spark, sf_dir))
    return settled(out, 6, "accuracy", "precision", "recall", "f1_positive", "f1")


_CURVE = """steps AS (
  SELECT probability_positive AS threshold, count(*) FILTER (label = 1) AS p,
         count(*) FILTER (label = 0) AS n FROM scored GROUP BY 1),
curve AS (
  SELECT threshold, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER () AS tp,
         sum(n) OVER () AS tn FROM steps WINDOW w AS (ORDER BY threshold DESC))"""


@question(f"""{_WITH_SCORED}, {_CURVE}
SELECT threshold, round(cn / tn + 1e-9, 6) AS fpr, round(cp / tp + 1e-9, 6) AS tpr FROM curve
UNION ALL SELECT 'infinity'::double, 0.0, 0.0""")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_scores(spark, sf_dir)
    return settled(ml.roc_points(stored, "probability_positive"), 6, "fpr", "tpr")


def _stored_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and score only, written once for questions that pass over them several times."""
    return stored(_rule_scored(spark, sf_dir).select("label", "probability_positive"))


@question(f"""{_WITH_SCORED}, {_CURVE}
SELECT round(sum(n * (cp - p / 2)) / max(tp * tn) + 1e-9, 6) AS auc FROM curve""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(ml.roc_auc(_stored_scores(spark, sf_dir), "probability_positive"), 6, "auc")


@question(f"""{_WITH_SCORED},
edges AS (SELECT min(probability_positive) AS lo,
                 (max(probability_positive) - min(probability_positive)) / 30.0::double AS w FROM scored)
SELECT label, bin, round(lo + bin * w + 1e-9, 6) AS bin_start, round(lo + (bin + 1) * w + 1e-9, 6) AS bin_end, n
FROM (SELECT label, greatest(0, least(29, floor((probability_positive - lo) / w)))::int AS bin, count(*) AS n
      FROM scored, edges GROUP BY 1, 2), edges""")
def probability_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_scores(spark, sf_dir)
    out = stats.histogram(stored, "probability_positive", 30, by="label")
    return settled(out, 6, "bin_start", "bin_end")


@question(f"""{_WITH_SCORED}
SELECT id, probability_positive FROM scored ORDER BY probability_positive DESC, id LIMIT 500""")
def top_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _rule_scored(spark, sf_dir)
    return ml.top_scored(scored, ["id", "probability_positive"], "probability_positive")


@question(f"""{_WITH_SCORED}
SELECT id, num_comments, label, prediction, probability_positive
FROM scored ORDER BY md5(id::varchar), id LIMIT 1000""")
def scored_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id", "num_comments", "label", "prediction", "probability_positive"]
    return ml.scored_sample(_rule_scored(spark, sf_dir), columns, "id")


# ---- models ----------------------------------------------------------------------------------

def _comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table of all comments, written once because training passes over it many times."""
    rows = _comment_features(spark, sf_dir)
    return stored(rows.select("id", *features.COMMENT_ROW_FEATURES, "label"))


def _metrics(model, train: DataFrame, test: DataFrame) -> DataFrame:
    return ml.evaluate_binary(ml.score(model, train), "train").unionByName(
        ml.evaluate_binary(ml.score(model, test), "test")
    )


@question()
def controversy_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.hash_split(_comment_rows(spark, sf_dir), "id")
    return _metrics(ml.controversy_pipeline().fit(train), train, test)


@question()
def controversy_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = split.hash_split(_comment_rows(spark, sf_dir), "id")
    fitted = ml.controversy_pipeline().fit(train).stages[-1]
    return ml.coefficients_table(
        spark, features.COMMENT_ROW_FEATURES, fitted.coefficients.toArray()
    )


@question()
def controversy_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = split.hash_split(_comment_rows(spark, sf_dir), "id")
    fitted = ml.controversy_pipeline(trees=True).fit(train).stages[-1]
    return ml.importances_table(
        spark, features.COMMENT_ROW_FEATURES, fitted.featureImportances.toArray()
    )


@question()
def controversy_top_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _comment_rows(spark, sf_dir)
    model = ml.controversy_pipeline().fit(split.hash_split(rows, "id")[0])
    scored = ml.score(model, rows, "prob_controversial")
    columns = ["id", "score", "is_top_level", "prob_controversial"]
    top = ml.top_scored(scored, columns, "prob_controversial")
    # 500 rows at most, so the texts are picked out without a shuffle.
    texts = roles.comment_texts(spark, sf_dir).select("id", "body")
    return texts.join(F.broadcast(top), "id").orderBy(F.desc("prob_controversial"), "id")


def _engagement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled feature table of all text posts with their cleaned text, written once."""
    posts = _post_features(spark, sf_dir)
    texts = roles.comment_texts(spark, sf_dir).withColumn("length", F.length("body")).drop("body")
    comments = texts.join(roles.comment_facts(spark, sf_dir), "place", "left")
    threads = features.comment_features(comments.withColumn("link_id", strip_kind("link_id")))
    joined = features.with_comment_features(posts, threads)
    columns = ["id", "clean_text", "num_comments", *features.POST_FEATURES, *features.COMMENT_FEATURES]
    rows = stored(joined.fillna(0, subset=["num_comments"]).select(*columns))
    return ml.quantile_label(rows)


@question()
def engagement_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.hash_split(_engagement_rows(spark, sf_dir), "id")
    weighted = stored(ml.with_class_weights(train))
    model = ml.cross_validate(ml.engagement_pipeline(), weighted, "id")
    return _metrics(model, weighted, test)


@question()
def engagement_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest on oversampled posts, and always guessing the larger class."""
    train, test = split.hash_split(_engagement_rows(spark, sf_dir), "id")
    forest = ml.fit_forest(ml.engagement_forest(), stored(ml.oversample(train, "id")))
    return ml.evaluate_binary(ml.score(forest, test), "forest").unionByName(
        ml.evaluate_binary(ml.majority_baseline(test), "majority")
    )
