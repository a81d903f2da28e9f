"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, URL schemes, plus signs, digits and
identifier cues. A local parser per kind then expands each anchor to both sides, finds the borders
and validates what lies between them. Offsets are code points, ends exclusive. Spans of one kind
never overlap; spans of different kinds may.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agoralens.llm.batches import map_rows, string_column

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "account", "key", "url")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GAP = r"[\x20:#=]{1,3}(?:(?:no|number)[.:]?[\x20#]{0,2})?"
_IBAN = re.compile(_GAP + r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])", re.I)
_SSN = re.compile(_GAP + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])", re.I)
_ACCOUNT = re.compile(_GAP + r"([A-Z]{0,3}[0-9](?:[\x20-]?[0-9]){5,19})(?![0-9A-Za-z])", re.I)
_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_URL = re.compile(r"(?://)([^\s/?#@]*@)?[^\s<>\"'/?#]+([^\s<>\"']*)")
_URL_SECRET = re.compile(r"[?&](?:e?mail|user|token|key|password|session)=[^&#\s]+", re.I)
CUES = {"iban": "iban", "ssn": "ssn", "account": "account", "acct": "account", "passport": "account", "konto": "account"}


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    found.add_word("://", ("url", 3))
    found.add_word("AKIA", ("key", 4))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for cue, kind in CUES.items():
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    letters = text.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in letters[4:] + letters[:4])) % 97 == 1


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def find(text: str) -> list[Span]:
    """All spans of a text, by kind as listed in `KINDS`, then by start."""
    spans: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    free = dict.fromkeys(KINDS, 0)

    def put(kind: str, start: int, end: int, valid: bool = True) -> None:
        free[kind] = end
        if valid:
            spans[kind].append(Span(kind, start, end))

    for last, (kind, length) in anchors().iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= free["ip"] and not (at and text[at - 1] in "0123456789"):
                if m := _IP.match(text, at):
                    put("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")))
            if at >= free["card"] and (m := _CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                put("card", at, m.end(), 16 <= len(digits) <= 19 and luhn(digits))
        elif kind == "email":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                put("email", start, m.end())
        elif kind == "phone":
            if at >= free["phone"] and (m := _PHONE.match(text, at)):
                put("phone", at, m.end(), 8 <= sum(c in "0123456789" for c in m[0]) <= 15)
        elif kind == "key":
            if at >= free["key"] and (m := _KEY.match(text, at)) and not (at and text[at - 1].isalnum()):
                put("key", at, m.end())
        elif kind == "url":
            start = at
            while start > free["url"] and at - start < 16 and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and (m := _URL.match(text, at + 1)):
                put("url", start, m.end(), bool(m[1] or _URL_SECRET.search(m[2])))
        elif at >= free[kind] and not (at and text[at - 1].isalnum()):
            pattern = {"iban": _IBAN, "ssn": _SSN, "account": _ACCOUNT}[kind]
            if m := pattern.match(text, last + 1):
                put(kind, m.start(1), m.end(1), kind != "iban" or iban_valid(m[1]))
    return [span for kind in KINDS for span in spans[kind]]


def find_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and `spans` (array of kind, start, end) of every whole text, one row per input row.

    NULL and empty texts have no spans; repeated rows are each searched. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = string_column(batch, text_col)
            found = [[s._asdict() for s in find(t.as_py() or "")] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], names=[id_col, "spans"])

    schema = f"`{id_col}` {kind}, spans array<struct<kind:string,start:int,end:int>>"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def masked(text: str) -> str:
    """The text with every span replaced by its kind, overlapping spans by the first one's."""
    parts, done = [], 0
    for span in sorted(find(text), key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            parts += [text[done : span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """`docs` with personal data in `text_col` replaced by `<EMAIL>` and the like; NULL stays."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if (s := t.as_py()) is None else masked(s) for t in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return map_rows(docs, run)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, and all spans as text, of `find_spans`' result."""

    def joined(column):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return spans.select(id_col, *map(number, BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
