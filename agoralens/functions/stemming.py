"""Porter's suffix-stripping stemmer (1980) as Spark column expressions.

The steps are regular expressions over arrays, so stemming stays in the JVM, is a map-only
transformation of each row and needs neither a Python worker nor a shuffle of tokens.

While a word is worked on, a `y` that acts as a vowel is written `Y`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

# Letter classes and word shapes of the published algorithm.
VOWEL = "[aeiouY]"
CONSONANT = "[^aeiouY]"
MEASURE_ABOVE_0 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}"
MEASURE_ABOVE_1 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}+{VOWEL}+{CONSONANT}"
SHORT_ENDING = f"{CONSONANT}{VOWEL}[^aeiouYwxy]$"

# Suffix -> replacement of steps 2 and 3 (where the rest has measure above 0).
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
# Suffixes dropped in step 4 (where the rest has measure above 1); `ion` also needs
# an s or t before it.
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def longest_first(suffixes) -> list[str]:
    return sorted(suffixes, key=lambda s: (-len(s), s))


def _but(word: Column, count: int) -> Column:
    """The word without its last `count` letters."""
    return F.substr(word, F.lit(1), F.length(word) - F.lit(count))


def _ends_double(word: Column) -> Column:
    last = F.substring(word, -1, 1)
    return (F.substring(word, -2, 1) == last) & (F.length(word) > 1) & last.rlike(CONSONANT)


def _plural(word: Column) -> Column:
    return (
        F.when(word.endswith("sses") | word.endswith("ies"), _but(word, 2))
        .when(word.endswith("ss"), word)
        .when(word.endswith("s"), _but(word, 1))
        .otherwise(word)
    )


# A word from which step 1b took `ed` or `ing` carries this mark into the tidy-up step.
_TAKEN = "+"


def _past_and_progressive(word: Column) -> Column:
    def drop(count: int) -> Column:
        rest = _but(word, count)
        return F.when(rest.rlike(VOWEL), F.concat(rest, F.lit(_TAKEN))).otherwise(word)

    eed = F.when(_but(word, 3).rlike(MEASURE_ABOVE_0), _but(word, 1)).otherwise(word)
    return (
        F.when(word.endswith("eed"), eed)
        .when(word.endswith("ed"), drop(2))
        .when(word.endswith("ing"), drop(3))
        .otherwise(word)
    )


def _tidy_up(word: Column) -> Column:
    rest = _but(word, 1)
    short = ~rest.rlike(MEASURE_ABOVE_1) & rest.rlike(MEASURE_ABOVE_0) & rest.rlike(SHORT_ENDING)
    return (
        F.when(~word.endswith(_TAKEN), word)
        .when(rest.rlike("(at|bl|iz)$"), F.concat(rest, F.lit("e")))
        .when(_ends_double(rest) & ~rest.rlike("[lsz]$"), _but(rest, 1))
        .when(short, F.concat(rest, F.lit("e")))
        .otherwise(rest)
    )


def _final_y(word: Column) -> Column:
    rest = _but(word, 1)
    ends = word.endswith("y") | word.endswith("Y")
    return F.when(ends & rest.rlike(VOWEL), F.concat(rest, F.lit("i"))).otherwise(word)


def _by_suffix(
    word: Column, suffixes: Iterable[str], shortest: int, change: Callable[[str, Column], Column]
) -> Column:
    """Apply `change(suffix, rest)` for the longest suffix the word has.

    Words below the shortest length that could change are left at once, and suffixes are tried only
    among those with the word's last letter, since most words have none of them.
    """
    by_letter: dict[str, list[str]] = {}
    for suffix in longest_first(suffixes):
        by_letter.setdefault(suffix[-1], []).append(suffix)
    out = F.when(F.length(word) < shortest, word)
    for letter, group in by_letter.items():
        tried = None
        for suffix in group:
            new = change(suffix, _but(word, len(suffix)))
            hit = word.endswith(suffix)
            tried = F.when(hit, new) if tried is None else tried.when(hit, new)
        out = out.when(word.endswith(letter), tried.otherwise(word))
    return out.otherwise(word)


def _replace_suffix(table: dict[str, str]) -> Callable[[Column], Column]:
    # A rest with measure above 0 has two letters at least.
    shortest = min(map(len, table)) + 2

    def step(word: Column) -> Column:
        def change(suffix: str, rest: Column) -> Column:
            new = F.concat(rest, F.lit(table[suffix]))
            return F.when(rest.rlike(MEASURE_ABOVE_0), new).otherwise(word)

        return _by_suffix(word, table, shortest, change)

    return step


def _drop_suffix(word: Column) -> Column:
    def change(suffix: str, rest: Column) -> Column:
        fits = rest.rlike(MEASURE_ABOVE_1)
        if suffix == "ion":
            fits = fits & rest.rlike("[st]$")
        return F.when(fits, rest).otherwise(word)

    # A rest with measure above 1 has four letters at least.
    return _by_suffix(word, STEP_4, min(map(len, STEP_4)) + 4, change)


def _final_e(word: Column) -> Column:
    rest = _but(word, 1)
    long = rest.rlike(MEASURE_ABOVE_1)
    medium = rest.rlike(MEASURE_ABOVE_0) & ~rest.rlike(SHORT_ENDING)
    return F.when(word.endswith("e") & (long | medium), rest).otherwise(word)


def _final_double_l(word: Column) -> Column:
    double = word.endswith("ll") & word.rlike(MEASURE_ABOVE_1)
    return F.when(double, _but(word, 1)).otherwise(word)


def stem_tokens(tokens: Column) -> Column:
    """Stem every token of an array of lower-case words. Words of one or two letters stay.

    Each step is its own pass over the array: a step reads its word several times, and nesting
    the steps inside one pass would multiply the expression.
    """
    def guarded(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda w: F.when(F.length(w) > 2, step(w)).otherwise(w)

    def mark(w: Column) -> Column:
        marked = F.regexp_replace(w, "([^aeiou])y", "$1Y")
        return F.when(w.contains("y"), marked).otherwise(w)

    tokens = F.transform(tokens, guarded(mark))
    tokens = F.transform(tokens, guarded(_plural))
    tokens = F.transform(tokens, lambda w: _past_and_progressive(w))
    tokens = F.transform(tokens, lambda w: _tidy_up(w))
    for step in (
        _final_y, _replace_suffix(STEP_2), _replace_suffix(STEP_3), _drop_suffix, _final_e,
        _final_double_l,
    ):
        tokens = F.transform(tokens, step)
    def unmark(w: Column) -> Column:
        return F.when(w.contains("Y"), F.replace(w, F.lit("Y"), F.lit("y"))).otherwise(w)

    return F.transform(tokens, unmark)


def stem(word: str | Column) -> Column:
    word = F.col(word) if isinstance(word, str) else word
    return F.when(word.isNotNull(), F.element_at(stem_tokens(F.array(word)), 1))
