import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators.lookup import rank_lookup
from clickloom.operators import lookup
from clickloom.operators.ordering import with_rank, with_row_index, with_running_totals


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i * 7 % 1009, rng.choice("aaabbc"), rng.randint(0, 50)) for i in range(1000)]
    return spark.createDataFrame(rows, "k bigint, g string, x int").repartition(7)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_index_of_few_rows(spark, n):
    got = with_row_index(spark.range(n), ["id"]).collect()
    assert sorted((r.id, r.row_index) for r in got) == [(i, i) for i in range(n)]


def test_index_equals_row_number(table):
    got = with_row_index(table, [F.desc("k")], "i")
    want = F.row_number().over(Window.orderBy(F.desc("k"))) - 1
    assert got.withColumn("w", want).where("i != w").count() == 0 and got.count() == 1000


def test_index_without_order_is_gapless_and_needs_no_shuffle(table):
    got = [r.row_index for r in with_row_index(table).collect()]
    assert sorted(got) == list(range(1000))


def test_index_skips_empty_partitions(spark):
    df = spark.range(100).repartition(9, F.col("id") % 2)
    assert sorted(r.row_index for r in with_row_index(df).collect()) == list(range(100))


def test_rank_equals_window(table):
    got = with_rank(table, ["g"], ["x", "k"])
    want = F.row_number().over(Window.partitionBy("g").orderBy("x", "k")) - 1
    assert got.withColumn("w", want).where("rank != w").count() == 0 and got.count() == 1000


def test_running_totals_equal_window(table):
    got = with_running_totals(table, ["g"], ["k"], {"t": F.col("x"), "n": F.lit(1)})
    w = Window.partitionBy("g").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    wrong = got.withColumn("wt", F.sum("x").over(w)).withColumn("wn", F.count("*").over(w))
    assert wrong.where("t != wt or n != wn").count() == 0 and got.count() == 1000


@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
def test_lookup_with_a_hot_key_unknown_keys_and_null(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(lookup, "HOT_ROWS", 3)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 25)
    df = spark.range(3000).withColumn("k", key)
    table = spark.range(20).select(
        F.col("id").alias("key"), (F.col("id") * 10).alias("v"), F.col("id").alias("rank")
    )
    got = rank_lookup(df, F.col("k"), table, "key", "v", "rank", 20, broadcast_rows, "found")
    want = F.when(F.col("k") < 20, F.col("k") * 10)
    assert got.count() == 3000
    assert got.where(~F.col("found").eqNullSafe(want)).count() == 0


def test_lookup_spreads_the_hot_key(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_ROWS", 3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(4000).withColumn("k", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 20))
        table = spark.range(20).select(F.col("id").alias("key"), F.col("id").alias("v"), F.col("id").alias("rank"))
        got = rank_lookup(df, F.col("k"), table, "key", "v", "rank", 20, 0, "found")
        where = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(where) == 4 and max(r["count"] for r in where) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
