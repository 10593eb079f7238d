"""Run registered queries next to their SQL on the same tables and compare.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def sql_session(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark_df, con, sql: str) -> str | None:
    """None when names and rows agree, else what differs."""
    got = rows_of(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in spark_df.dtypes}
    if kinds != types:
        return f"types {types} against {kinds}"
    if got != want:
        first = next(((a, b) for a, b in zip(got, want) if a != b), None)
        return f"{len(got)} rows against {len(want)}; first difference {first}; types {kinds}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from siltlake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = sql_session(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
