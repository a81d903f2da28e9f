"""URL verdicts: rules for hosts and paths first, then a list of canonical URLs.

The list is held as a blocked Bloom filter: each listed URL sets eight bits, one in each 32-bit word
of one 256-bit block. A page reads one block; pages whose eight bits are all set go on to an exact
join with the list, which removes the false positives. Everything is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from agoralens.operators.lookups import fits_broadcast, lookup_join
from agoralens.sources.scratch import stored

WORDS = 8
#: Listed URLs per block on average: 256 bits for 16 URLs pass about 0.2 % of other URLs.
PER_BLOCK = 16


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def host(url: str | Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: str | Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: str | Column) -> Column:
    """Host without a leading `www.`, then the path without an ending `.html` or `/`. Scheme, query
    and fragment do not count. NULL without `://`."""
    where = F.regexp_replace(host(url), r"^www\.", "")
    place = F.regexp_replace(path(url), r"(\.html|/)$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(where, place))


def matching_rule(host_col: Column, path_col: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (ties: the one that sorts first); NULLs if
    none does. A rule fits its host and all subdomains if the path starts with the rule's."""
    def longest_first(rule: Rule) -> tuple[int, str]:
        return -len(rule.host + rule.path), rule.host + rule.path

    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=longest_first)):
        fits = ((host_col == rule.host) | host_col.endswith("." + rule.host)) & path_col.startswith(rule.path)
        text = F.when(fits, F.lit(rule.host + rule.path)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _block(url: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("block")), blocks)


def _bits(url: Column) -> list[Column]:
    """One bit for each word of the block, from five bits each of one hash."""
    h = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def bloom(listed: DataFrame, url_col: str = "canonical") -> DataFrame:
    """`block`, its words `w0` to `w7` and the number of `blocks`; 40 bytes a row of distinct URLs / 16."""
    blocks = listed.agg(F.ceil((F.count(url_col) + 1) / F.lit(PER_BLOCK)).alias("blocks"))
    return (
        listed.withColumn("blocks", blocks.scalar())
        .withColumn("block", _block(F.col(url_col), F.col("blocks")))
        .groupBy("block", "blocks")
        .agg(*[F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(_bits(F.col(url_col)))])
    )


def is_listed(pages: DataFrame, listed: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """`pages` with `listed`, whether the canonical URL in column `url_key` is on the list.

    `listed` has one column `canonical`, distinct and without NULL, and is stored. The filter is broadcast
    if it is counted to fit, and then every page asks it where it lies; else URLs that occur are joined
    by their block numbers, which are spread evenly whatever the URLs are. Only possible hits are made
    distinct and take part in the exact join; those on the list are looked up with frequent URLs split.
    NULL URLs are not listed.
    """
    listed = stored(listed, "listed")
    filters = stored(bloom(listed), "filter")
    probe = pages.select("url_key").where(F.col("url_key").isNotNull())
    side = filters.drop("blocks")
    if fits_broadcast(side, max_rows):
        side = F.broadcast(side)
    else:
        probe = probe.distinct()
    probe = probe.withColumn("blocks", filters.agg(F.max("blocks")).scalar()).where("blocks IS NOT NULL")
    probe = probe.withColumn("block", _block(F.col("url_key"), F.col("blocks"))).drop("blocks")
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col("url_key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    possible = probe.join(side, "block").where(hit).select("url_key").distinct()
    sure = possible.join(listed.withColumnRenamed("canonical", "url_key"), "url_key")
    sure = stored(sure.withColumn("listed", F.lit(True)), "sure")
    known = lookup_join(pages.where(F.col("url_key").isNotNull()), sure, ["url_key"], "left")
    known = known.withColumn("listed", F.coalesce("listed", F.lit(False)))
    return known.unionByName(pages.where(F.col("url_key").isNull()).withColumn("listed", F.lit(False)))


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: `id_col`, `host`, `path`, `rule`, `verdict` and `listed`.

    The longest fitting rule decides; without one, listed URLs are blocked and all others allowed.
    URLs that are NULL or have no `://` have an empty host and path and are allowed. Repeated rows
    stay repeated. Other columns are not read.
    """
    keyed = pages.select(id_col, host(url_col).alias("host"), path(url_col).alias("path"), canonical(url_col).alias("url_key"))
    known = is_listed(keyed, listed)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    fallback = F.when(F.col("listed"), "block").otherwise("allow")
    return known.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, fallback).alias("verdict"), "listed")


def urls_with_terms(
    pages: DataFrame, terms: Sequence[str], *, url_col: str = "url", text_col: str = "html"
) -> DataFrame:
    """A list: canonical URLs under which a page holds one of the lower-case `terms` as a word."""
    pattern = r"(^|[^a-z])(" + "|".join(terms) + r")([^a-z]|$)"
    bad = pages.where(F.lower(text_col).rlike(pattern))
    return bad.select(canonical(url_col).alias("canonical")).where("canonical IS NOT NULL").distinct()
