"""Heavy keys in joins."""

from conftest import rows
from pyspark.sql import functions as F

from sightline.operators.skew import heavy_keys, salted_join


def test_heavy_keys_are_those_above_their_share(spark):
    df = spark.range(3000).selectExpr("if(id < 1000, 7, id) AS mid", "if(id % 2 = 0, 'a', cast(id AS string)) AS sid")
    assert heavy_keys(df, ["mid", "sid"], least_rows=100) == {"mid": [(7, 10)], "sid": [("a", 15)]}
    assert heavy_keys(df, ["mid"], least_rows=1, most=10) == {"mid": [(7, 4)]}  # above a tenth of all rows
    assert heavy_keys(df.limit(0), ["mid", "sid"]) == {"mid": [], "sid": []}


def test_salted_join_is_a_join_with_even_tasks(spark):
    many = spark.range(6000).selectExpr("if(id % 3 = 0, 7, if(id % 11 = 0, null, id)) AS mid", "id AS sid")
    many = many.unionByName(many.filter("sid < 50"))  # repeated rows
    few = spark.createDataFrame([(7, "x"), (7, "y"), (7, "y"), (1, "z"), (None, "n"), (9999, "q")], "mid BIGINT, face STRING")
    heavy = heavy_keys(many, ["mid"], least_rows=100)["mid"]
    assert heavy == [(7, 21)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain, salted = many.join(few, "mid"), salted_join(many, few, "mid", heavy)
        assert salted.columns == plain.columns and rows(salted) == rows(plain)
        largest = [df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0] for df in (plain, salted)]
        assert largest[0] >= 6051 and largest[1] < 1500  # 17 keys of about 290 rows in 16 tasks
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
