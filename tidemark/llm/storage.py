"""Intermediate tables in the folder that the driver and all executors share."""

from pyspark.sql import DataFrame

from tidemark.plans import scratch_path

#: Spark's setting for dropping the shuffle files of a query when it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: cuts the lineage and survives lost executors.

    The shuffle files of the job are freed as soon as the table is there.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def freed(table: DataFrame) -> None:
    """Remove the files of a table that :func:`written` has returned and nobody reads any more."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(conf).delete(path, True)
