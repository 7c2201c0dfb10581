import pytest
from pyspark.sql import functions as F

from clickloom.operators import encode as en
from clickloom.operators.lookup import _most_rows, long_lookup
from clickloom.operators.profile import value_counts
from clickloom.session import freeze


def many_rows(spark, n=9000):
    """A third of the rows on an unseen key, a third on the key of rank 1,001, and NULLs."""
    key = F.when(F.col("id") % 3 == 0, -7).when(F.col("id") % 3 == 1, 1001).when(F.col("id") % 30 == 2, None).otherwise(F.col("id") % 1500)
    return spark.range(n).select(
        "id", key.cast("string").alias("k"), (F.col("id") % 40).cast("string").alias("name"), F.lit(5).alias("__answers_")
    )


def entries(spark):
    a = spark.range(1500).selectExpr("'a' as name", "cast(id as string) as key", "id * 10 as value")
    b = spark.range(30).selectExpr("'b' as name", "cast(id as string) as key", "id + 1000 as value")
    return a.union(b).union(spark.range(5).selectExpr("'other' as name", "cast(id as string) as key", "-1L as value"))


@pytest.mark.parametrize("max_bytes", [1 << 20, 8 * 20, 1])
def test_all_columns_at_once(spark, max_bytes):
    df = many_rows(spark)
    found = long_lookup(df, {"a": F.col("k"), "b": F.col("name")}, entries(spark), 8, max_bytes)
    assert found.columns == [*df.columns, "a", "b"]
    rows = found.collect()
    assert len(rows) == 9000 and len({r.id for r in rows}) == 9000
    for r in rows:
        k = None if r.k is None else int(r.k)
        assert r.a == (None if k is None or k < 0 else 10 * k)
        assert r.b == (int(r.name) + 1000 if int(r.name) < 30 else None)


def test_no_key_that_meets_the_table_has_many_rows(spark):
    counts = freeze(many_rows(spark).where("k is not null").groupBy("k").agg(F.count("*").alias("n")))
    least = _most_rows(counts, 8, 1 << 20)
    heavy = {r.k for r in counts.where(F.col("n") > least).collect()}
    assert heavy == {"-7", "1001"} and least <= 9000 / 4
    # as many answers as fit the bytes
    assert counts.where(F.col("n") > _most_rows(counts, 8, 8)).count() <= 1


def test_rows_move_once(spark):
    found = long_lookup(many_rows(spark), {"a": F.col("k"), "b": F.col("name")}, entries(spark), 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # rows and their answers to the row's number, long keys and the table to the key
    assert plan.count("hashpartitioning(__row") <= 2 and plan.count("hashpartitioning(__i") <= 2


def test_empty_tables(spark):
    df, none = many_rows(spark, 0), entries(spark).limit(0)
    assert long_lookup(df, {"a": F.col("k")}, entries(spark), 8).count() == 0
    rows = long_lookup(many_rows(spark, 5), {"a": F.col("k")}, none, 8).collect()
    assert len(rows) == 5 and all(r.a is None for r in rows)


def test_vocabularies_are_bound_in_bytes(spark, monkeypatch):
    df = spark.range(600).selectExpr(
        "id", "cast(id % 2 as int) as click", "concat(repeat('x', 50), id % 300) as long", "concat('y', id % 200) as short"
    )
    counts = freeze(value_counts(df, ["long", "short", "click"]))
    fitted = en.fit_encoding(counts, [], [("long", 4), ("short", 4)])
    assert fitted.sizes_in_bytes["long"] > 300 * 50 and fitted.is_broadcast("long")
    want = sorted(map(tuple, fitted.index(df).collect()))
    monkeypatch.setattr(en, "BROADCAST_BYTES", 12_000)
    assert not fitted.is_broadcast("long") and fitted.is_broadcast("short")
    assert sorted(map(tuple, fitted.index(df).collect())) == want


def test_partitions_follow_the_bytes_of_the_answers(spark, monkeypatch):
    from clickloom.operators import lookup

    monkeypatch.setattr(lookup, "TASK_BYTES", 9000 * 2 * 8 // 40, raising=False)
    found = long_lookup(many_rows(spark), {"a": F.col("k"), "b": F.col("name")}, entries(spark), 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__row" in plan and ", 40), REPARTITION_BY_NUM" in plan
    assert found.where("a is not null").count() == sum(i % 3 == 1 or i % 3 == 2 and i % 30 != 2 for i in range(9000))
