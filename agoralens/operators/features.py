"""Feature tables for posts, comments and threads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from agoralens.functions.calendar import is_weekend
from agoralens.functions.keys import is_direct_reply, strip_kind
from agoralens.functions.numbers import ratio
from agoralens.functions.text import has_mark, space_pieces
from agoralens.operators.lookups import spread_join
from agoralens.sources.scratch import stored

# Words that mark a negative comment.
NEGATIVE_WORDS = ("toxic", "abusive", "gaslight")

# Names of the model features, in the order of the models' inputs.
COMMENT_FEATURES = (
    "comment_score_mean", "comment_score_max", "comment_score_sum",
    "comment_len_mean", "comment_len_max", "comment_len_sum",
    "comment_author_nunique", "comment_is_op_ratio",
    "comment_contro_mean", "comment_contro_max", "comment_contro_sum",
)
POST_FEATURES = (
    "token_count", "sentence_count", "has_question_mark", "char_len_clean",
    "title_token_count", "title_char_len", "title_has_question_mark",
    "selftext_token_count", "selftext_char_len",
    "post_hour", "post_dow", "is_weekend",
)
POST_TEXT_FEATURES = POST_FEATURES[:-3]
COMMENT_ROW_FEATURES = (
    "score", "body_length", "punctuation_count", "num_words", "is_top_level", "gilded", "hour",
)

_MEASURES = {"score": "score", "length": "len", "controversiality": "contro"}


def comment_features(
    comments: DataFrame, posts: DataFrame | None = None, *, length: str = "length"
) -> DataFrame:
    """Per thread (`link_id`): mean, maximum and sum of score, length and controversiality,
    distinct authors and the share of comments by the post's own author.

    Rows are first added up per (thread, author) and then per thread. That yields the distinct
    authors without a second pass over the comments, and a thread holding a large part of all
    comments is spread over its authors. Posts join in as rows of the same aggregation, which
    marks their author without a join. Without `posts` the author share is 0.
    """
    columns = [F.col(length if m == "length" else m).alias(m) for m in _MEASURES]
    rows = comments.select(
        strip_kind("link_id").alias("link_id"), "author", *columns, F.lit(0).alias("_post")
    )
    if posts is not None:
        nothing = [F.lit(None).cast(rows.schema[m].dataType).alias(m) for m in _MEASURES]
        rows = rows.unionByName(
            posts.select(
                F.col("id").cast("string").alias("link_id"),
                F.col("author").cast(rows.schema["author"].dataType).alias("author"),
                *nothing,
                F.lit(1).alias("_post"),
            )
        )
    per_author = rows.groupBy("link_id", "author").agg(
        F.count_if(F.col("_post") == 0).alias("n"),
        F.max("_post").alias("_post"),
        *[
            f(m).alias(f"{m}_{name}")
            for m in _MEASURES
            for name, f in (("n", F.count), ("sum", F.sum), ("max", F.max))
        ],
    )
    known_author = (F.col("n") > 0) & F.col("author").isNotNull()
    own = F.sum(F.when((F.col("_post") == 1) & F.col("author").isNotNull(), F.col("n")).otherwise(0))
    per_measure = [
        c
        for m, name in _MEASURES.items()
        for c in (
            ratio(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"comment_{name}_mean"),
            F.max(f"{m}_max").alias(f"comment_{name}_max"),
            F.sum(f"{m}_sum").alias(f"comment_{name}_sum"),
        )
    ]
    threads = per_author.groupBy("link_id").agg(
        F.sum("n").alias("_n"),
        F.count_if(known_author).alias("comment_author_nunique"),
        ratio(own, F.sum("n")).alias("comment_is_op_ratio"),
        *per_measure,
    )
    return threads.where(F.col("_n") > 0).select("link_id", *COMMENT_FEATURES)


def with_comment_features(posts: DataFrame, threads: DataFrame) -> DataFrame:
    """Posts with their thread's features; posts without comments get 0."""
    keyed = threads.withColumnRenamed("link_id", "_link")
    joined = posts.join(keyed, F.col("id").cast("string") == F.col("_link"), "left").drop("_link")
    return joined.fillna(0, subset=list(COMMENT_FEATURES))


def comments_within(comments: DataFrame, posts: DataFrame, seconds: int) -> DataFrame:
    """Comments written within a time span after their post, so features do not look ahead."""
    opened = posts.select(
        F.col("id").cast("string").alias("_post"), F.col("created").alias("_opened")
    )
    keyed = comments.withColumn("_post", strip_kind("link_id"))
    age = F.col("created").cast("timestamp").cast("double") - F.col("_opened").cast(
        "timestamp"
    ).cast("double")
    joined = spread_join(keyed, opened, ["_post"])
    return joined.where(age.between(0, seconds)).select(*comments.columns)


def post_features(
    df: DataFrame,
    *,
    text: str = "raw_text",
    tokens: str = "tokens",
    title: str = "title",
    body: str = "selftext",
    created: str = "created",
    weekend: tuple[int, ...] = (1, 7),
) -> DataFrame:
    """Add size, question and time features of each post. NULL texts count as empty.

    Tokens are those of the cleaned text; sentences and questions are looked for in the text
    before cleaning, since cleaned tokens have no punctuation. Where the time comes from another
    table, call the two parts instead, with the join between them: it then carries no text.
    """
    measured = post_text_features(df, text=text, tokens=tokens, title=title, body=body)
    return post_time_features(measured, created, weekend)


def post_text_features(
    df: DataFrame, *, text: str = "raw_text", tokens: str = "tokens", title: str = "title", body: str = "selftext"
) -> DataFrame:
    """Size and question features, which need the texts only."""
    whole = F.coalesce(text, F.lit(""))
    return df.withColumns(
        {
            "token_count": F.coalesce(F.size(tokens), F.lit(0)),
            "sentence_count": F.size(F.split(whole, r"\.")),
            "has_question_mark": has_mark(text, "?"),
            "char_len_clean": F.length(whole),
            "title_token_count": space_pieces(title),
            "title_char_len": F.length(F.coalesce(title, F.lit(""))),
            "title_has_question_mark": has_mark(title, "?"),
            "selftext_token_count": space_pieces(body),
            "selftext_char_len": F.length(F.coalesce(body, F.lit(""))),
        }
    )


def post_time_features(df: DataFrame, created: str = "created", weekend: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Time features; 0 for posts without a time."""
    out = df.withColumns(
        {
            "post_hour": F.hour(created),
            "post_dow": F.dayofweek(created),
            "is_weekend": is_weekend(F.dayofweek(created), weekend),
        }
    )
    return out.fillna(0, subset=list(POST_FEATURES))


def keyword_flag(text: str, words: Sequence[str] = NEGATIVE_WORDS):
    """1 where the lower-cased text contains one of the words, else 0."""
    hit = F.lower(text).rlike("|".join(words))
    return F.coalesce(hit.cast("int"), F.lit(0))


def comment_row_features(
    comments: DataFrame, *, body: str = "body", created: str = "created", first_word: bool = False
) -> DataFrame:
    """Add text, place and time features and the `label` of each comment.

    One function serves training and scoring.
    """
    return context_features(body_features(comments, body=body, first_word=first_word), created)


def body_features(comments: DataFrame, *, body: str = "body", first_word: bool = False) -> DataFrame:
    """Features of the comment's text.

    `num_words` counts words; `first_word` instead gives the length of the first word, as older
    models were trained on.
    """
    words = F.length(F.regexp_extract(body, r"(\S+)", 1)) if first_word else F.regexp_count(
        body, F.lit(r"\S+")
    )
    return comments.withColumns(
        {
            "body_length": F.length(body),
            "punctuation_count": F.col(body).rlike("[!?]").cast("int"),
            "contains_question": has_mark(body, "?"),
            "negativity": keyword_flag(body),
            "num_words": words,
        }
    )


def context_features(comments: DataFrame, created: str = "created") -> DataFrame:
    """Place in the thread, hour, and the controversy label."""
    return comments.withColumns(
        {
            "is_top_level": is_direct_reply("parent_id"),
            "hour": F.hour(created),
            "label": F.col("controversiality").cast("int"),
        }
    )


def thread_depth(comments: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """(id, depth): 1 for a reply to the post, one more than the parent's for other comments.

    A comment whose chain ends at a missing parent counts from there. Every comment points at an
    ancestor and each round replaces it by the ancestor's ancestor, so the number of rounds grows
    with the logarithm of the depth. Comments that reached the top leave the joins. A parent with
    very many replies is split over tasks. Comments in a reply cycle, and those below it, get NULL:
    after k rounds only 2**k comments of a chain with an end are no longer open, so once at most
    2**k are open, one more round ends every such chain, and what is left is in a cycle.
    """
    parent = F.when(is_direct_reply("parent_id") == 0, strip_kind("parent_id"))
    state = comments.select(
        F.col("id").cast("string").alias("id"), parent.alias("up"), F.lit(1).cast("long").alias("depth")
    )
    finished, open_rows = None, stored(state)
    rounds, ending = 0, False
    while True:
        done = open_rows.where(F.col("up").isNull())
        waiting = open_rows.where(F.col("up").isNotNull())
        finished = done if finished is None else finished.unionByName(done)
        n_open = waiting.count()
        if n_open == 0:
            return finished.select("id", "depth")
        if ending or rounds == max_rounds:
            break
        ending = n_open <= 2**rounds
        rounds += 1
        # An ancestor is either finished or itself on the way up.
        ancestors = finished.unionByName(waiting).select(
            F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth")
        )
        moved = spread_join(waiting, ancestors, ["up"], "left").select(
            "id",
            F.col("_up").alias("up"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        )
        open_rows = stored(moved)
    stuck = waiting.select("id", F.lit(None).cast("long").alias("depth"))
    return finished.select("id", "depth").unionByName(stuck)
