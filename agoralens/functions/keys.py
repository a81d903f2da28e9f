"""Key helpers: repeatable buckets and forum identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def md5_bucket(key: str | Column, buckets: int = 100, seed: str = "") -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of md5(key || seed).

    Depends on the key alone, so a row stays in its bucket whatever the file layout or engine.
    """
    key = F.col(key) if isinstance(key, str) else key
    text = F.concat(key.cast("string"), F.lit(seed)) if seed else key.cast("string")
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets)).cast("int")


def strip_kind(key: str | Column) -> Column:
    """`t3_abc` or `t1_abc` to `abc`; other values are unchanged."""
    key = F.col(key) if isinstance(key, str) else key
    return F.regexp_replace(key, r"^t\d_", "")


def is_direct_reply(parent: str | Column) -> Column:
    """1 where the parent is the post itself (kind prefix `t3_`), else 0."""
    parent = F.col(parent) if isinstance(parent, str) else parent
    return F.coalesce(parent.startswith("t3_").cast("int"), F.lit(0))
