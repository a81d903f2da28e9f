"""One query per operator, over its whole table, with its SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.llm import credentials, language, minhash, mixing, personal_data, piece_codec, prefix_trie, quality, spelling, spots, substrings, url_filter, word_model
from agoralens.operators.lookups import lookup_join

Question = Callable[[SparkSession, str], DataFrame]

QUESTIONS: dict[str, Question] = {}
SQL: dict[str, str] = {}


def question(sql: str | None = None) -> Callable[[Question], Question]:
    def add(function: Question) -> Question:
        QUESTIONS[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- 1: SentencePiece encoding and decoding ----------------------------------------------------


def _piece_digests(coder: piece_codec.Codec, ids: list[list[int]], texts: list[str]) -> list[pa.Array]:
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    return [
        pa.array([len(i) for i in ids], pa.int64()),
        pa.array([sha(",".join([coder.digits[k] for k in i])) for i in ids], pa.string()),
        pa.array([sha(t) for t in texts], pa.string()),
    ]


@question()
def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests are made next to the ids and texts, which need not leave the workers for them."""
    return piece_codec.encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        _piece_digests,
        "n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


# ---- 2: near duplicates ------------------------------------------------------------------------


WORDS_SQL = "coalesce(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+'), [])"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@question(f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL.format(text=_LOWERED)} AS words FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS items
  FROM w),
items AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n_both
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * n_both >= 85 * (na + nb - n_both)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
tops AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT doc_id, len(items)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
FROM sets LEFT JOIN tops ON a = doc_id""")
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), percent=85)


# ---- 3: URL filters ----------------------------------------------------------------------------

RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]
#: Pages that hold one of these words put their canonical URL on the list.
TERMS = ["stupid", "idiot", "moron", "scum", "pathetic", "loser", "vermin", "worthless"]


def _rules_sql(what: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{r.host + r.path if what == 'rule' else r.verdict}'"
        for r in sorted(RULES, key=lambda r: -len(r.host + r.path))
    )
    return f"CASE{cases} END"


@question(f"""
WITH parts AS (
  SELECT page_id, html, instr(url, '://') > 0 AS whole,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN whole THEN regexp_replace(host, '^www[.]', '') || regexp_replace(path, '([.]html|/)$', '') END AS url_key
  FROM parts),
listed AS (
  SELECT DISTINCT url_key FROM keyed
  WHERE url_key IS NOT NULL AND regexp_matches(lower(html), '(^|[^a-z])({"|".join(TERMS)})([^a-z]|$)'))
SELECT page_id, host, path, {_rules_sql("rule")} AS rule,
  coalesce({_rules_sql("verdict")}, CASE WHEN url_key IN (SELECT url_key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(url_key IN (SELECT url_key FROM listed), false) AS listed
FROM keyed""")
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.urls_with_terms(pages, TERMS), RULES)


# ---- 4: language-model scores ------------------------------------------------------------------


@question()
def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled as good and not toxic. Background: all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    good = labels.where("quality = 1 AND toxic = 0").select("doc_id", F.lit(True).alias("good")).distinct()
    return word_model.score(docs, word_model.count(lookup_join(docs, good, ["doc_id"], "left"), "good"))


# ---- 5: language -------------------------------------------------------------------------------


@question()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out("doc_id")))
    return language.predict(docs, model).select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


# ---- 6: personal data --------------------------------------------------------------------------


@question()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find_spans(table(spark, sf_dir, "documents")))


# ---- 7: fingerprints ---------------------------------------------------------------------------


@question()
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.fingerprint_and_edited(table(spark, sf_dir, "documents"))


# ---- 8: substring dedup ------------------------------------------------------------------------


@question(f"""
WITH w AS (SELECT doc_id, {WORDS_SQL.format(text="text")} AS words FROM documents),
runs AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
firsts AS (SELECT run, min(doc_id) AS lo FROM runs GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
  FROM (SELECT r.doc_id, i FROM runs r JOIN firsts f USING (run) WHERE lo < r.doc_id)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


# ---- 9: quality rules --------------------------------------------------------------------------


@question()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---- 10: mixing --------------------------------------------------------------------------------


@question("""
WITH sized AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
bounded AS (SELECT *, 2.0::DOUBLE * source_size AS bound FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(bound) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bound / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM bounded),
targets AS (
  SELECT source, source_size, coalesce(least(bound, weight *
      (SELECT arg_min(level, bound / weight) FROM levels WHERE bound > level * weight)), bound) AS target
  FROM levels),
run AS (
  SELECT d.*, t.source_size, t.target, coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS rounds,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  (rounds * size + greatest(0, least(size, floor(target)::BIGINT - rounds * source_size - before)))::BIGINT AS taken
FROM run""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


# ---- 11: secrets -------------------------------------------------------------------------------


def _secrets_sql() -> str:
    """Parts by splitting at each pattern, nearest parts of every role by windows over one text."""

    def quoted(pattern: str) -> str:
        return pattern.replace("'", "''")

    def places(name: str, pattern: str) -> str:
        return f"""{name} AS (
  SELECT r, value, last - length(value) AS s, last AS e FROM (
    SELECT r, value, sum(length(gap) + coalesce(length(value), 0)) OVER (PARTITION BY r ORDER BY i)::BIGINT AS last FROM (
      SELECT r, unnest(string_split_regex(t, '{quoted(pattern)}')) AS gap, unnest(regexp_extract_all(t, '{quoted(pattern)}')) AS value,
        unnest(range(len(string_split_regex(t, '{quoted(pattern)}')))) AS i
      FROM docs WHERE regexp_matches(t, '{quoted(pattern)}'))) WHERE value IS NOT NULL)"""

    extra = {
        "assign": f" WHERE length(regexp_replace(value, '{quoted(credentials._VALUE)}', '')) >= 12",
        "blob": " WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')",
    }
    base = ", ".join(f"'{k}'" for k in credentials.BASE)
    found = ",\n".join(places(f"f_{k}", pattern) for k, (pattern, _) in credentials.PARTS.items())
    parts = " UNION ALL ".join(
        f"SELECT r, s, e, {i} AS place, '{k}' AS kind, '{role}' AS role FROM f_{k}{extra.get(k, '')}"
        for i, (k, (_, role)) in enumerate(credentials.PARTS.items())
    )
    near = ", ".join(
        f"max(e) FILTER (role = '{r}') OVER ahead AS before_{r}, min(s) FILTER (role = '{r}') OVER back AS behind_{r}" for r in credentials.ROLES
    )
    completed = " OR ".join(
        f"(role = '{role}' AND ("
        + " OR ".join(
            f"coalesce(before_{r} >= coalesce(scope, 0) AND s - before_{r} <= {credentials.REACH}, false)"
            f" OR coalesce((scope_end IS NULL OR behind_{r} < scope_end) AND behind_{r} - e <= {credentials.REACH}, false)"
            for r in needed
        )
        + "))"
        for role, needed in credentials.COMPLETED_BY.items()
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in credentials.BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{found},
{places("f_edge", credentials.EMPTY_LINE)},
parts AS (SELECT * FROM ({parts}) UNION ALL SELECT r, s, e, -1, 'edge', 'edge' FROM f_edge),
swept AS (
  SELECT *, {near},
    max(e) FILTER (kind = 'edge') OVER ahead AS scope, min(s) FILTER (kind = 'edge') OVER back AS scope_end,
    max(e) FILTER (kind IN ({base})) OVER ahead AS base_end, min(s) FILTER (kind IN ({base})) OVER back AS base_start
  FROM parts
  WINDOW ahead AS (PARTITION BY r ORDER BY s, place, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    back AS (PARTITION BY r ORDER BY s, place, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
told AS (
  SELECT r, s, e, place, kind, kind || ':' || s || ':' || e AS span FROM swept
  WHERE kind IN ({base}) OR (kind <> 'edge' AND ({completed})
    AND (role = 'endpoint' OR NOT (coalesce(base_end > s, false) OR coalesce(base_start < e, false))))),
summed AS (
  SELECT r, {counts}, string_agg(span, ',' ORDER BY s, place) FILTER (kind IN ({base})) AS base, string_agg(span, ',' ORDER BY s, place) AS spans
  FROM told GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in credentials.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN summed USING (r)"""


@question(_secrets_sql())
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find_secrets(table(spark, sf_dir, "documents")))


# ---- 12: conversation prefix trie --------------------------------------------------------------


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes (code points up to U+07FF). Needs `crc_table`, a table
    of one row with the 256 remainders `t`."""
    wide = "CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END"
    bytes_of = f"flatten(list_transform(string_split({text}, ''), lambda c: {wide}))::BIGINT[]"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}),"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i)))"""


@question(f"""
WITH {CRC_TABLE},
turns AS (
  SELECT conv_id, list(v ORDER BY turn NULLS FIRST, m) AS own FROM (
    SELECT conv_id, turn, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS v,
      md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m
    FROM conversations WHERE conv_id IS NOT NULL) GROUP BY 1),
lent AS (SELECT a.conv_id, a.own, coalesce(b.own, []) AS base, {crc32_sql("a.conv_id::VARCHAR")} % 6 AS h
  FROM turns a CROSS JOIN crc_table LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 100),
paths AS (SELECT conv_id, base[1:h] || own[h + 1:] AS path FROM lent),
steps AS (SELECT conv_id, len(path) AS n, d, path[1:d] AS key, path[d].text AS last
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(length(last)) AS chars, max(n) > d AS inner_node,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends
  FROM steps GROUP BY d, key),
below AS (
  SELECT s.d, s.key, count(*) FILTER (NOT w.inner_node) AS n_leaves, sum((w.n_convs - 1) * coalesce(w.chars, 0)) AS saved
  FROM nodes w JOIN steps s ON s.conv_id = w.conv_id AND s.d <= w.d GROUP BY 1, 2),
children AS (SELECT d - 1 AS d, key[1:d - 1] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
  b.n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v LEFT JOIN nodes p ON p.d = v.d - 1 AND p.key = v.key[1:v.d - 1]
LEFT JOIN children c ON c.d = v.d AND c.key = v.key JOIN below b ON b.d = v.d AND b.key = v.key""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


# ---- 13: spelling variants ---------------------------------------------------------------------


@question(f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY 1, 2),
hashed AS (SELECT run, times, {crc32_sql("id || ':' || run")} AS h FROM runs, crc_table),
written AS (
  SELECT times, CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= 5 GROUP BY 1 HAVING sum(times) >= 3),
shorter AS (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON b.word = a.rest),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
    CASE WHEN other_n >= 2 * w.n THEN other_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM formed UNION ALL SELECT y.word, f.form FROM ways y JOIN formed f ON f.word = y.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, y.root, f.n, f.n_near, f.form_n
FROM formed f JOIN ways y USING (word) JOIN formed e ON e.word = y.root AND e.form IS NULL""")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
