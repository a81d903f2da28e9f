"""Joins of texts with the ids of those rows that are needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from agoralens.operators.lookups import fits_broadcast


def only_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose key is in `ids` (a stored table). If the ids are counted to fit,
    they are broadcast and texts that are not needed are dropped before any shuffle."""
    side = ids.select(key).distinct()
    return docs.join(F.broadcast(side) if fits_broadcast(side) else side, key, "left_semi")
