"""Run registered questions next to their SQL in DuckDB and compare all rows.

    python -m tests.compare SF_DIR [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def difference(spark_df, connection, sql: str) -> str | None:
    """None if both sides hold the same columns, value kinds and rows, else what differs."""
    names = sorted(spark_df.columns)
    cursor = connection.execute(sql)
    other = [d[0] for d in cursor.description]
    if sorted(other) != names:
        return f"columns {names} != {sorted(other)}"
    order = [other.index(n) for n in names]
    theirs = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    ours = Counter(tuple(plain(r[n]) for n in names) for r in spark_df.collect())
    kinds = [{type(v[i]).__name__ for v in side if v[i] is not None} for i in range(len(names)) for side in (ours, theirs)]
    for i, name in enumerate(names):
        a, b = kinds[2 * i], kinds[2 * i + 1]
        if a and b and a != b:
            return f"column {name} is {a} here and {b} in SQL"
    if ours != theirs:
        only_us, only_them = list((ours - theirs).items()), list((theirs - ours).items())
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; {len(only_us)} only here "
            f"{sorted(map(str, only_us))[:3]}; {len(only_them)} only in SQL {sorted(map(str, only_them))[:3]}; {names}"
        )
    return None


def main() -> None:
    import __spark_entry__ as entry
    from agoralens.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                result = difference(df, connection, sql[name]) or "same"
            else:
                result = f"rows only: {df.count()}"
        except Exception as error:  # show all failures of a run
            result = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {result}", flush=True)


if __name__ == "__main__":
    main()
