"""Session settings the operators count on."""

from pyspark.sql import SparkSession

#: Text without a zone is UTC; AQE splits skewed join sides and skewed
#: rebalanced partitions and picks the number of reducers from real sizes.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built.

    The number of shuffle partitions is the caller's: adaptive execution merges small
    ones, so it may be set for the largest input.
    """
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever storage it names."""
    fs, location = _storage(spark, path)
    return fs.exists(location)


def _storage(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
