import time

from pyspark.sql import functions as F

from sightline.session import DROP_SHUFFLES, materialise


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_when_the_table_is_written(spark):
    numbers = spark.range(1000).withColumn("n", F.col("id") % 7)
    held = spark.conf.get(DROP_SHUFFLES)
    before = shuffle_files(spark)
    for counted in (False, True):
        out = materialise(numbers.repartition(3, "n").groupBy("n").count(), "dropped", counted=counted)
        assert {tuple(r) for r in out.collect()} == {(i, 143 - (i == 6)) for i in range(7)}
    for _ in range(50):  # they are dropped in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(DROP_SHUFFLES) == held
