"""Scratch tables."""

from docloom.runtime import FILE_CLEANUP, materialize


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_of_a_written_stage_are_deleted(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    stage = materialize(spark.range(0, 50_000, 1, 4).repartition(3, "id"), "stage")
    assert not shuffle_files(spark) - before
    assert stage.count() == 50_000 and spark.conf.get(FILE_CLEANUP, None) == setting
