"""Text columns: markup removal, tokens, counts of marks and words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# How a removed text is spelled, and the token joiner of the compatibility view.
REMOVED_MARKS = ("[removed]", "[deleted]")
TOKEN_JOINER = "@"

# The markup that is blanked out, in order.
MARKUP_PATTERNS = (
    r"http\S+|www\S+",
    r"&amp;|&quot;|&gt;|&lt;",
    r"[\*\_>\[\]\(\)]",
)

# Escape sequences that arrive as two visible characters, and their replacement.
ESCAPE_REPLACEMENTS = (
    (r"\\n", " "),
    (r"\\t", " "),
    (r"\\\"", '"'),
    (r"&nbsp;", " "),
    (r"[\{\}]", " "),
)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def json_safe(value: str | Column) -> Column:
    """Text without literal escape sequences, hard spaces and braces."""
    out = _column(value).cast("string")
    for pattern, replacement in ESCAPE_REPLACEMENTS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def strip_markup(value: str | Column) -> Column:
    """Blank out links, HTML entities and markdown marks, then make the text JSON-safe."""
    out = _column(value).cast("string")
    for pattern in MARKUP_PATTERNS:
        out = F.regexp_replace(out, pattern, " ")
    return json_safe(out)


def document_text(*parts: str | Column) -> Column:
    """Title and body joined by a space; NULL parts are skipped."""
    return F.concat_ws(" ", *[_column(p) for p in parts])


def tokenize(value: str | Column) -> Column:
    """Lower-case, split on white space, keep letters only, drop what is left empty.

    A NULL text has no tokens.
    """
    # Other characters go from the whole text at once, which is one pass instead of one per word.
    letters = F.regexp_replace(F.lower(_column(value)), r"[^\p{L}\s]+", "")
    kept = F.filter(F.split(letters, r"\s+"), lambda w: w != "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def drop_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are not in a word list of fixed, small size."""
    return F.filter(tokens, lambda w: ~w.isin(*words))


def each_word(df: DataFrame, tokens: Column | str, *keep: Column | str) -> DataFrame:
    """One row per non-empty token, as `word`, next to the `keep` columns.

    A plain explode makes the optimizer test the array for rows beforehand, which would compute
    the tokens a second and third time; the outer form does not.
    """
    exploded = df.select(*keep, F.explode_outer(tokens).alias("word"))
    return exploded.where(F.col("word").isNotNull() & (F.col("word") != ""))


def joined_tokens(tokens: str | Column) -> Column:
    """The one-string view of a token array."""
    return F.array_join(_column(tokens), TOKEN_JOINER)


def tokens_of(joined: str | Column, keep_empty: bool = False) -> Column:
    """Tokens of the one-string view; NULL and '' give no tokens.

    `keep_empty` keeps the empty tokens between two joiners.
    """
    joined = _column(joined)
    parts = F.split(joined, TOKEN_JOINER)
    if not keep_empty:
        parts = F.filter(parts, lambda w: w != "")
    none = F.array().cast("array<string>")
    return F.when(joined.isNull() | (joined == ""), none).otherwise(parts)


def is_removed(value: str | Column) -> Column:
    return _column(value).isin(*REMOVED_MARKS)


def word_count(*parts: str | Column) -> Column:
    """Words of the parts together: runs of ASCII letters and digits, split on what is between.

    A text that starts or ends with another character counts one empty piece there, and an empty
    text counts 1.
    """
    whole = F.concat_ws(" ", *[F.coalesce(_column(p), F.lit("")) for p in parts])
    # The same as [^A-Za-z0-9]+, which Java matches several times more slowly.
    return F.size(F.split(whole, r"\P{Alnum}+"))


def space_pieces(value: str | Column) -> Column:
    """Pieces between white space; '' and NULL count 1."""
    return F.size(F.split(F.coalesce(_column(value), F.lit("")), r"\s+"))


def count_marks(value: str | Column, marks: str) -> Column:
    """How many characters of the text are one of the characters in `marks`."""
    value = _column(value)
    return F.length(value) - F.length(F.translate(value, marks, ""))


def has_mark(value: str | Column, mark: str) -> Column:
    return F.coalesce(_column(value).contains(mark).cast("int"), F.lit(0))


def first_match(value: str | Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule (label, pattern) whose pattern is found in the lower-cased text."""
    lowered = F.lower(_column(value))
    out: Column | None = None
    for label, pattern in rules:
        hit = lowered.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit(default) if out is None else out.otherwise(default)
