"""Storage for intermediate tables and streaming checkpoints.

It is the shared folder named by ``spark.checkpoint.dir``: every executor can reach it
and it outlives the loss of any of them.
"""

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session.

    Where the session names none, as in tests, it lies in the warehouse, which all
    executors share as well.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet.

    What is written there is removed when the session's JVM ends.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return path
