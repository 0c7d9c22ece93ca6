"""Compare registered queries with their SQL run by DuckDB: columns, types, rows, values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.15g}")
    return value


def compare(spark: SparkSession, con, name: str, run, sql: str, sf_dir: str) -> list[str]:
    """Differences found; empty when the query and its SQL agree."""
    df = run(spark, sf_dir)
    got_columns = dict(df.dtypes)
    columns = sorted(got_columns)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_columns = {r[0]: r[1] for r in described}
    problems = []
    if columns != sorted(want_columns):
        return [f"columns {columns} != {sorted(want_columns)}"]
    for c in columns:
        if TYPES.get(got_columns[c]) != want_columns[c]:
            problems.append(f"type of {c}: {got_columns[c]} vs {want_columns[c]}")
    got = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    order = [want_columns_i for want_columns_i, _ in sorted(enumerate(r[0] for r in described), key=lambda x: x[1])]
    want = [tuple(_plain(r[i]) for i in order) for r in con.execute(sql).fetchall()]
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    missing, extra = Counter(want) - Counter(got), Counter(got) - Counter(want)
    if missing or extra:
        problems.append(
            f"{sum(missing.values())} missing, {sum(extra.values())} extra; "
            f"want {sorted(missing, key=str)[:2]} got {sorted(extra, key=str)[:2]}"
        )
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries

    from martloom.session import get_session

    spark = get_session(
        "oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, runs, sqls = duck(sf_dir), queries(), oracle_sql()
    bad = 0
    for name in names or runs:
        start = time.time()
        try:
            if name in sqls:
                problems = compare(spark, con, name, runs[name], sqls[name], sf_dir)
            else:
                problems = [] if runs[name](spark, sf_dir).count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:700]}"]
        bad += bool(problems)
        kind = "sql" if name in sqls else "rows"
        print(f"{'BAD ' if problems else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(names or runs)} queries, {len(sqls)} with SQL, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
