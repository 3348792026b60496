from tidemark.plans import configure, scratch_path, shared_dir


def test_scratch_is_in_the_folder_the_session_names(spark, tmp_path):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "x").startswith(f"{named}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_configure_leaves_the_number_of_shuffle_partitions_alone(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    configure(spark)
    assert spark.conf.get(name) == before
