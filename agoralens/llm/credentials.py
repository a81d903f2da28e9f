"""Secrets and the credentials they belong to, with built-in expressions only.

A credential has several parts: an identifier (access key id, user name), a secret (a value that is
assigned to a name such as `token`, or a bare string of hex or mixed letters) and an endpoint (host,
URL). Some parts are plain by themselves and are always reported: the base kinds. All others are weak
candidates: a user name, a short password, a random-looking word or a host means nothing alone, and is
reported only if a part that completes it lies nearby in the same scope.

Scopes are the stretches of a text between empty lines. The interval join of parts within a scope asks
for the nearest part of each role before and behind every part, so it is one sweep over the sorted
borders in either direction, and no pairs are made. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agoralens.sources.scratch import stored

#: Code points that may lie between two parts of one credential.
REACH = 200
#: Matches whose positions are added up at a time.
BLOCK = 256


def either_case(words: str) -> str:
    """A pattern for a list of words whose ASCII letters may have either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c for c in words)


_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""
_BASE_NAMES = either_case("password|passwd|secret|token|api_?key")
_USER_NAMES = either_case("access_?key_?id|client_?id|user_?name|user|login")
_PASS_NAMES = either_case("pass|pwd|passphrase|password|passwd|secret_?key|secret|private_?key|token|api_?key|auth")
_HOST_NAMES = either_case("hostname|host|server|endpoint")

#: kind: (pattern, role). The base kinds come first; the order is that of spans with equal starts.
BASE = ("assign", "access", "hex")
PARTS: dict[str, tuple[str, str]] = {
    "assign": (rf"(?:{_BASE_NAMES}){_ASSIGNED}[A-Za-z0-9+/_.=-]+", "named"),
    "access": (r"AKIA[A-Z0-9]{14,}", "identifier"),
    "hex": (r"[0-9a-f]{16,}", "bare"),
    "user": (rf"(?:{_USER_NAMES}){_ASSIGNED}[A-Za-z0-9@._-]{{3,}}", "identifier"),
    "pass": (rf"(?:{_PASS_NAMES}){_ASSIGNED}[^\x00-\x20\x22\x27,;]{{4,}}", "named"),
    "blob": (r"[A-Za-z0-9+/_-]{20,}", "bare"),
    "host": (rf"(?:{_HOST_NAMES}){_ASSIGNED}[A-Za-z0-9][A-Za-z0-9._-]*(?::[0-9]+)?", "endpoint"),
    "url": (r"[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\x00-\x20\x22\x27<>]+", "endpoint"),
}
KINDS = tuple(PARTS)
ROLES = ("identifier", "named", "bare", "endpoint")
#: role of a weak part: roles one of which must be near.
COMPLETED_BY = {"identifier": ("named", "bare"), "named": ("identifier", "endpoint"), "bare": ("identifier",), "endpoint": ("named",)}
#: Further conditions on a whole match: group 2 of `assign` has 12 characters, a `blob` is mixed.
_VALUE = rf"^(?:{_BASE_NAMES}){_ASSIGNED}"
EMPTY_LINE = r"\n[\x20\x09\x0D]*\n"

_SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern (no empty ones) from left to right: array of start, end and value.

    What lies between matches is measured by splitting at the same pattern. Lengths are added up
    within blocks, so the work is not quadratic in the number of matches.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    sized = F.filter(
        F.zip_with(gaps, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda g, v: F.struct(g.alias("gap"), v.alias("value"))),
        lambda x: x["value"].isNotNull(),
    )

    def ends(array: Column, start: Column) -> Column:
        """The running position after each item of a short array, with `start` before the first."""
        return F.aggregate(
            array, F.array(start), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
        )

    def in_blocks(sized: Column) -> Column:
        widths = F.transform(sized, lambda x: x["gap"] + F.length(x["value"]))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sized) - 1) / BLOCK).cast("int")), lambda b: F.slice(sized, b * BLOCK + 1, BLOCK))
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["value"])))
        starts = ends(totals, F.lit(0))
        after = F.flatten(
            F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), lambda b, s: F.slice(ends(F.transform(b, lambda x: x["gap"] + F.length(x["value"])), s), 2, BLOCK))
        )
        return F.zip_with(sized, after, lambda x, e: F.struct((e - F.length(x["value"])).alias("start"), e.alias("end"), x["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    # Most texts have no match: one search tells, and nothing is split.
    found = F.transform(F.array(sized), in_blocks)[0]
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), found).otherwise(none)


def _spans(text: Column, kind: str) -> Column:
    found = matches(text, PARTS[kind][0])
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(F.regexp_replace(m["value"], _VALUE, "")) >= 12)
    if kind == "blob":
        found = F.filter(found, lambda m: m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]") & m["value"].rlike("[0-9]"))
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _edges(text: Column) -> Column:
    return F.transform(
        matches(text, EMPTY_LINE), lambda m: F.struct(m["start"].alias("start"), F.lit(-1).alias("place"), m["end"].alias("end"), F.lit("edge").alias("kind"))
    )


def find_parts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: `_row` (a number of its own), `id_col`, `base` (spans of the base
    kinds, sorted), `weak` (all candidates) and `edges` (empty lines of texts with candidates). Stored,
    so that row numbers stay as they are."""
    text = F.col(text_col)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col), text)
    rows = rows.select(
        "_row", id_col, text_col,
        F.sort_array(F.concat(*[_spans(text, k) for k in BASE])).cast(_SPAN).alias("base"),
        F.concat(*[_spans(text, k) for k in KINDS if k not in BASE]).cast(_SPAN).alias("weak"),
    )
    edges = F.when(F.size("weak") > 0, _edges(text)).cast(_SPAN).alias("edges")
    return stored(rows.select("_row", id_col, "base", "weak", edges), "parts")


def swept(found: DataFrame) -> DataFrame:
    """Every part of rows with weak candidates: `_row`, `start`, `place`, `end`, `kind`, `role`, and per
    role the nearest part before and behind it in its scope and within reach (`before_<role>`,
    `behind_<role>`: structs or NULL), and whether it overlaps a base span (`covered`).

    Windows run over the parts of one text; a text's parts are bounded by the text.
    """
    events = found.where(F.size("weak") > 0).select("_row", F.explode(F.concat("base", "weak", "edges")).alias("part")).select("_row", "part.*")
    role = F.create_map(*[F.lit(v) for k in KINDS for v in (k, PARTS[k][1])])[F.col("kind")]
    events = events.withColumn("role", role)
    order = ["start", "place", "end"]
    ahead = W.partitionBy("_row").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy("_row").orderBy(*[F.desc(c) for c in order]).rowsBetween(W.unboundedPreceding, -1)
    base = F.col("kind").isin(*BASE)
    edge = F.col("kind") == "edge"
    before = {r: F.max(F.when(F.col("role") == r, F.struct("end", "start", "kind"))).over(ahead) for r in ROLES}
    behind = {r: F.min(F.when(F.col("role") == r, F.struct("start", "end", "kind"))).over(back) for r in ROLES}
    seen = events.withColumns(
        {f"before_{r}": c for r, c in before.items()}
        | {
            "_scope": F.coalesce(F.max(F.when(edge, F.col("end"))).over(ahead), F.lit(0)),
            "_base_end": F.coalesce(F.max(F.when(base, F.col("end"))).over(ahead), F.lit(0)),
        }
    ).withColumns(
        {f"behind_{r}": c for r, c in behind.items()}
        | {
            "_scope_end": F.min(F.when(edge, F.col("start"))).over(back),
            "_base_start": F.min(F.when(base, F.col("start"))).over(back),
        }
    )
    near = {}
    for r in ROLES:
        b, a = F.col(f"before_{r}"), F.col(f"behind_{r}")
        near[f"before_{r}"] = F.when((b["end"] >= F.col("_scope")) & (F.col("start") - b["end"] <= REACH), b)
        inside = F.col("_scope_end").isNull() | (a["start"] < F.col("_scope_end"))
        near[f"behind_{r}"] = F.when(inside & (a["start"] - F.col("end") <= REACH), a)
    covered = (F.col("_base_end") > F.col("start")) | F.coalesce(F.col("_base_start") < F.col("end"), F.lit(False))
    return (
        seen.where("kind != 'edge'").withColumns(near).withColumn("covered", covered)
        .drop("_scope", "_scope_end", "_base_end", "_base_start")
    )


def _completed() -> Column:
    """Whether a part that completes this one is near."""
    cases = F.lit(False)
    for role, needed in COMPLETED_BY.items():
        some = F.coalesce(*[F.col(f"{side}_{r}.kind") for r in needed for side in ("before", "behind")]).isNotNull()
        cases = F.when(F.col("role") == role, some).otherwise(cases)
    return cases


def _reported() -> Column:
    """Weak parts that are reported: completed, and, but for endpoints, outside of base spans."""
    return ~F.col("kind").isin(*BASE) & _completed() & (~F.col("covered") | (F.col("role") == "endpoint"))


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and `spans` (start, place, end, kind; sorted) of every whole text, one row per input row.

    NULL and empty texts have no spans; repeated rows and ids, and rows without an id, are each searched;
    an empty table gives an empty result. Other columns are not read, so their names do not matter.
    """
    found = find_parts(docs, id_col=id_col, text_col=text_col)
    added = swept(found).where(_reported()).select("_row", F.struct("start", "place", "end", "kind").alias("part"))
    added = added.groupBy("_row").agg(F.collect_list("part").alias("added"))
    few = found.where(F.size("weak") == 0).select(id_col, F.col("base").alias("spans"))
    none = F.array().cast(_SPAN)
    more = found.where(F.size("weak") > 0).select("_row", id_col, "base").join(added, "_row", "left")
    return few.unionByName(more.select(id_col, F.sort_array(F.concat("base", F.coalesce(F.col("added").cast(_SPAN), none))).alias("spans")))


def credentials(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per reported secret of texts with several parts: `id_col`, `secret`, `identifier` and
    `endpoint` (structs of kind, start, end; the nearest ones, NULL where there is none near). A tie in
    distance goes to the part before."""
    found = find_parts(docs, id_col=id_col, text_col=text_col)
    parts = swept(found).where(F.col("role").isin("named", "bare") & (F.col("kind").isin(*BASE) | _reported()))

    def nearest(role: str) -> Column:
        b, a = F.col(f"before_{role}"), F.col(f"behind_{role}")
        gap_b, gap_a = F.col("start") - b["end"], a["start"] - F.col("end")
        chosen = F.when(a.isNull() | (b.isNotNull() & (gap_b <= gap_a)), F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
        chosen = chosen.otherwise(F.struct(a["kind"].alias("kind"), a["start"].alias("start"), a["end"].alias("end")))
        return F.when(a.isNotNull() | b.isNotNull(), chosen).alias(role)

    linked = parts.select("_row", F.struct("kind", "start", "end").alias("secret"), nearest("identifier"), nearest("endpoint"))
    linked = linked.where("identifier IS NOT NULL OR endpoint IS NOT NULL")
    return linked.join(found.select("_row", id_col), "_row").drop("_row")


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, and all spans as text, of `find_secrets`' result."""

    def joined(column: Column) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return spans.select(id_col, *map(number, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
