"""Named queries and, where SQL can say the same, the SQL that must give the same rows."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import configure

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

_GROUPS = ("state", "filters", "lookups", "changes", "codec", "expiry", "storage", "streams")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query.  Times leave it as UTC wall-clock values, as in the SQL."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return _wall_clock(build(spark, sf_dir))

        if name in _queries:
            raise ValueError(f"query {name!r} is registered twice")
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return build

    return register


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_sql)


def _load() -> None:
    for group in _GROUPS:
        import_module(f"tidemark.workload.{group}")


def _wall_clock(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )
