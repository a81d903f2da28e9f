"""Tables whose layout changed over time, read as one."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: From narrow to wide; a type takes all values of those before it in its row.
_WIDENING = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType(), T.TimestampType()),
)
MISFITS = "misfits"


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that takes all values of both; None if only text does."""
    if a == b:
        return a
    for row in _WIDENING:
        if a in row and b in row:
            return row[max(row.index(a), row.index(b))]
    if {a, b} <= {*_WIDENING[0], *_WIDENING[1]}:
        return T.DoubleType()
    return None


def fold_schemas(schemas: Iterable[T.StructType], contract: T.StructType | None = None) -> T.StructType:
    """One schema for all: columns in the order in which they first occur, each as wide as needed.

    Where types do not fit together (a number here, text there), the first type that is not text stays,
    and text is read as that. `contract` fixes the types of its columns.
    """
    fixed = {} if contract is None else {f.name: f.dataType for f in contract.fields}
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            kind = fixed.get(field.name, field.dataType)
            have = types.get(field.name)
            if have is None or (isinstance(have, (T.StringType, T.NullType)) and not isinstance(kind, T.NullType)):
                types[field.name] = kind
            elif not isinstance(kind, (T.StringType, T.NullType)):
                types[field.name] = wider(have, kind) or have
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def read_drifting(
    spark: SparkSession, folders: Sequence[str], contract: T.StructType | None = None, *, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Folders with layouts of their own (one each) as one table, with columns and types of `fold_schemas`.

    A column that a folder lacks is NULL there. A value that is not of the column's type becomes NULL and
    goes, as text, to the map `misfits` under the column's name; `misfits` is NULL where all fit. Of each
    folder only the footers are read beforehand.
    """
    frames = [spark.read.format(fmt).options(**options).load(folder) for folder in folders]
    whole = fold_schemas([df.schema for df in frames], contract)
    parts = []
    for df in frames:
        have = {f.name: f.dataType for f in df.schema.fields}
        columns, lost = [], []
        for field in whole.fields:
            name = F.col(f"`{field.name}`")
            if field.name not in have:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
                continue
            value = name if have[field.name] == field.dataType else name.try_cast(field.dataType)
            columns.append(value.alias(field.name))
            if have[field.name] != field.dataType:
                lost.append(F.when(name.isNotNull() & value.isNull(), F.struct(F.lit(field.name).alias("key"), name.cast("string").alias("value"))))
        entry = "array<struct<key:string,value:string>>"
        found = F.filter(F.array(*lost), lambda e: e.isNotNull()) if lost else F.array().cast(entry)
        misfits = F.when(F.size(found) > 0, F.map_from_entries(found.cast(entry))).cast("map<string,string>")
        parts.append(df.select(*columns, misfits.alias(MISFITS)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
