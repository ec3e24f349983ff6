"""Compare every query with its SQL on the given tables."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return names, sorted(cells, key=repr)


def difference(spark_df, con, sql) -> str | None:
    left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a} != {b}"
    return None


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from clickloom.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8,
                          **{"spark.ui.enabled": "false",
                             "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                found = difference(run(spark, sf_dir), con, sql[name]) or "ok"
            else:
                found = f"rows only: {run(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            found = f"ERROR {type(error).__name__}: {str(error)[:int(os.environ.get('ERROR_CHARS', 300))]}"
        bad += not found.startswith(("ok", "rows only"))
        print(f"{name:26s} {time.time() - start:6.1f}s {found}", flush=True)
    print("unmatched:", sorted(set(sql) - set(entry.queries())))
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
