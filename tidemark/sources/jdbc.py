"""Bulk load and unload of a table in a SQL database."""

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options.  With a partition column the range is read in parallel.

    Rows below ``lower`` or above ``upper`` are read too, by the first and the last
    task: the bounds only say how to divide the work.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if partition_column is not None:
        if lower is None or upper is None or partitions is None:
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table; filters and column choices are sent to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 10_000,
    connections: int = 16,
    driver: str | None = None,
) -> None:
    """Write rows into a database table, best a staging table for the database to merge.

    At most ``connections`` tasks write at the same time.
    """
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }
    if driver:
        options["driver"] = driver
    df.write.format("jdbc").mode(mode).options(**options).save()
