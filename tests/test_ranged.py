from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.operators import ranged


def previous(df):
    w = Window.partitionBy("g", "h").orderBy(F.asc_nulls_last("k"))
    return df.withColumn("before", F.lag("v").over(w))


def test_a_group_over_many_partitions(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = [("big" if i % 3 == 0 else f"g{i % 40}", None if i % 5 == 0 else "h", None if i == 7 else i * 7919 % 3001, None if i % 11 == 0 else i) for i in range(3000)]
        df = spark.createDataFrame(data, "g string, h string, k int, v int").repartition(5)
        found = ranged.with_previous(df, ["g", "h"], [F.asc_nulls_last("k")], "v", "before")
        assert rows(found) == rows(previous(df)) and found.columns == ["g", "h", "k", "v", "before"]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "_part" in plan.split("Window")[1]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_few_rows_and_none(spark, rows):
    df = spark.createDataFrame([("a", None, 1, 5), ("a", None, 2, None), ("a", None, 3, 7), ("b", "x", 1, 1)], "g string, h string, k int, v int")
    assert rows(ranged.with_previous(df, ["g", "h"], [F.asc_nulls_last("k")], "v", "before")) == rows(previous(df))
    assert ranged.with_previous(df.limit(0), ["g", "h"], [F.asc_nulls_last("k")], "v", "before").count() == 0
