"""Compare registered queries with their SQL in DuckDB on the same files."""

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(rows: list[tuple], names: list[str]) -> list[tuple]:
    """Rows with columns in name order, sorted, independent of row order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return round(value, 9)
    return value


def spark_rows(df):
    return normal([tuple(r) for r in df.collect()], df.columns)


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return normal(result.fetchall(), names), sorted(names)
