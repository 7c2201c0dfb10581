import pytest
from pyspark.sql import functions as F

from clickloom.operators import profile as pf


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, "abc"[i % 3], None if i % 4 == 0 else i % 5, i % 2, "same", float(i)) for i in range(60)]
    return spark.createDataFrame(
        rows, "id bigint, s string, n int, click int, one string, d double"
    )


def test_candidates_are_strings_and_ints(table):
    assert pf.candidates(table) == ["s", "n", "click", "one"]
    rows = [tuple(r) for r in pf.columns_by_type(table).orderBy("pos").collect()]
    assert rows == [(1, "s", "string"), (2, "n", "int"), (3, "click", "int"), (4, "one", "string")]


def test_profile_equals_one_count_per_column(table):
    found = {r.name: (r.ndv, r.has_null) for r in pf.profile(table).collect()}
    for c in pf.candidates(table):
        ndv, nulls = table.agg(F.countDistinct(c), F.count_if(F.col(c).isNull())).first()
        assert found[c] == (ndv, nulls > 0)


def test_vocabulary_counts_null_as_a_value(table):
    found = [tuple(r) for r in pf.vocab_sizes(table, ["n", "s"]).orderBy("pos").collect()]
    assert found == [(0, "n", 6), (1, "s", 3)]


def test_empty_table_has_a_profile(table):
    rows = pf.profile(table.limit(0)).collect()
    assert len(rows) == 4 and all(r.ndv == 0 and not r.has_null for r in rows)
    assert pf.screen(table.limit(0), pf.candidates(table), 100) == pf.candidates(table)


def make_profile(spark, rows):
    rows = [(i, n, t, ndv, False) for i, (n, t, ndv) in enumerate(rows)]
    return spark.createDataFrame(rows, pf.PROFILE_SCHEMA)


def test_selection_order_bound_ties_and_constants(spark):
    p = make_profile(spark, [
        ("i1", "int", 3), ("s1", "string", 5), ("click", "int", 2), ("s2", "string", 100),
        ("s3", "string", 101), ("s4", "string", 5), ("i2", "int", 7), ("one", "string", 1),
    ])
    chosen = pf.select_wide(p).orderBy("rank").collect()
    assert [r["name"] for r in chosen] == ["s2", "s1", "s4", "i2", "i1"]
    assert [r["rank"] for r in chosen] == [0, 1, 2, 3, 4]
    assert pf.wide_dim(pf.select_wide(p)).first()[0] == 99 + 4 + 4 + 6 + 2
    assert [r["name"] for r in pf.constant_columns(p).collect()] == ["one"]
    ranked = {(r["type"], r["rank"]): r["name"] for r in pf.rank_columns(p).collect()}
    assert ranked[("string", 0)] == "s3" and ranked[("string", 2)] == "s1"
    assert ranked[("string", 3)] == "s4" and ranked[("int", 0)] == "i2"


def test_absent_label_is_an_error(spark):
    p = make_profile(spark, [("s1", "string", 5), ("click", "int", 200)])
    with pytest.raises(Exception, match="click is not among"):
        pf.select_wide(p).collect()


def test_screen_drops_only_what_is_far_above(spark):
    df = spark.range(5000).select(
        (F.col("id") % 100).cast("string").alias("at"),
        (F.col("id") % 101).cast("string").alias("just_above"),
        F.col("id").cast("string").alias("far"),
    )
    kept = pf.screen(df, df.columns, 100)
    assert "at" in kept and "far" not in kept


def test_profile_is_one_scan_with_partial_sums(spark, table):
    plan = pf.value_counts(table, ["s", "n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 1
    assert "partial_count" in plan


def test_id_like_columns_are_never_grouped(spark, monkeypatch):
    """A column that looks like one of few values at first, for the rows are sorted by it."""
    df = spark.range(0, 30_000, 1, 1).selectExpr(
        "id", "cast(id as string) as key", "cast(greatest(id - 15000, 0) as int) as late", "cast(id % 100 as int) as n",
        "cast(id % 130 as string) as over", "cast(null as string) as none",
    )
    assert pf.screen(df, ["key", "late", "n", "over", "none"], 100) == ["n", "none"]
    counted = []
    monkeypatch.setattr(pf, "value_counts", lambda d, cols, real=pf.value_counts: (counted.append(list(cols)), real(d, cols))[1])
    kept = pf.sketch_files(df, ["late", "n"], F.lit("f"))
    assert pf.screen(df, ["late", "n"], 100, kept) == ["n"] and counted == [["late", "n"]]


def test_sketches_of_new_files_only_add(spark):
    from clickloom.session import scratch_dir

    path = scratch_dir(spark)
    first = spark.range(0, 500, 1, 1).selectExpr("cast(id % 60 as string) as a", "cast(id as int) as b")
    second = spark.range(500, 900, 1, 1).selectExpr("cast(id % 80 as string) as a", "cast(id as int) as b")
    first.write.parquet(path)
    kept = pf.freeze_sketches(pf.sketch_files(spark.read.parquet(path), ["a", "b"]))
    second.write.mode("append").parquet(path)
    both = pf.sketch_files(spark.read.parquet(path), ["a", "b"])
    grown = pf.add_files(kept, both)
    assert grown.select("file").distinct().count() == 2 and grown.count() == 4
    found = {r.name: r.ndv for r in pf.estimated_sizes(grown).collect()}
    assert found == {r.name: r.ndv for r in pf.estimated_sizes(both).collect()}
    assert found["a"] == 80 and abs(found["b"] - 900) < 60
    # files that are known already change nothing
    assert pf.add_files(grown, both).count() == 4
