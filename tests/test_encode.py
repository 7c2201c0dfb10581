import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from clickloom.operators import encode as en
from clickloom.operators import profile as pf
from clickloom.plans.feature_job import featurize
from clickloom.session import freeze, scratch_dir


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    rows = [
        (i, rng.choice("aabbccdef"), rng.choice([1, 2, 2, 3]), rng.choice("xyyz"), int(rng.random() < 0.3))
        for i in range(400)
    ]
    return spark.createDataFrame(rows, "id bigint, s string, n int, d string, click int")


def test_index_equals_the_library_indexer(spark, table):
    rows = en.fit_transform(table, en.build_pipeline(["s", "n"], [en.Deep("d", 3, 4)]))
    library = StringIndexer(inputCols=["s", "n", "d", "click"], outputCols=["a", "b", "c", "e"])
    both = library.fit(table).transform(rows)
    wrong = both.where(
        (F.col("a") != F.col("s_idx")) | (F.col("b") != F.col("n_idx"))
        | (F.col("c") != F.col("dSEP3SEP4")) | (F.col("e") != F.col("label"))
    )
    assert both.count() == 400 and wrong.count() == 0


def test_equal_frequencies_are_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in "cabcab"], "v string")
    got = {r.value: r.idx for r in en.string_index(df, ["v"]).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_large_vocabularies_rank_alike(spark, table, monkeypatch):
    def ranks():
        return sorted((r.name, r.value, r.idx) for r in en.string_index(table, ["s", "n", "d"]).collect())

    expected = ranks()
    monkeypatch.setattr(en, "MAX_RANKED_IN_TASK", 2)
    assert ranks() == expected


def test_label_follows_frequency_or_alphabet(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (0, "a")], "click int, s string")
    flipped = en.fit_transform(df, en.build_pipeline(["s"], []))
    assert sorted((r.click, r.label) for r in flipped.collect()) == [(0, 1.0), (1, 0.0), (1, 0.0)]
    kept = en.fit_transform(df, en.build_pipeline(["s"], [], label_order="alphabetAsc"))
    assert all(r.click == r.label for r in kept.collect())


@pytest.mark.parametrize("max_labels", [128, 1])
def test_null_policies(spark, max_labels):
    df = spark.createDataFrame(
        [(1, "a", "p", 0), (2, "b", "q", 1), (3, "a", None, 0), (4, "b", "p", 1)],
        "id bigint, s string, d string, click int",
    )
    run = lambda policy: featurize(
        df, [("d", 4)], on_invalid=policy, max_labels=max_labels
    )
    with pytest.raises(Exception):
        run("error").rows.collect()
    assert {r.id for r in run("skip").rows.collect()} == {1, 2, 4}
    kept = run("keep")
    assert kept.rows.count() == 4
    assert kept.encoding.wide_dim == 4 and kept.encoding.spec[0].vocab == 3
    assert {r.id: r.deep for r in kept.rows.collect()}[3] == [2]


@pytest.mark.parametrize("broadcast_rows", [0, 100])
@pytest.mark.parametrize("policy,ids", [("skip", {1, 2, 4}), ("keep", {1, 2, 3, 4})])
def test_null_policies_of_joined_columns(spark, policy, ids, broadcast_rows):
    df = spark.createDataFrame(
        [(1, "a", "p", 0), (2, "b", "q", 1), (3, "a", None, 0), (4, "b", "p", 1)],
        "id bigint, s string, d string, click int",
    )
    counts = freeze(pf.value_counts(df, ["s", "d", "click"]))
    fitted = en.fit_encoding(
        counts, ["s"], [("d", 4)], on_invalid=policy, max_labels=1, broadcast_rows=broadcast_rows
    )
    assert fitted.joined_sizes == {"s": 2, "d": 2}
    rows = {r.id: r.deep for r in fitted.transform(df).collect()}
    assert set(rows) == ids and rows[1] == [0] and rows[2] == [1]
    assert rows.get(3, [2]) == [2]
    strict = en.fit_encoding(counts, ["s"], [("d", 4)], max_labels=1)
    with pytest.raises(Exception, match="NULL or unseen value in d"):
        strict.transform(df).collect()


def test_joined_index_equals_indexer(spark, table):
    counts = freeze(pf.value_counts(table, ["s", "n", "d", "click"]))
    small = en.fit_encoding(counts, ["n"], [("s", 4), ("d", 4)])
    large = en.fit_encoding(counts, ["n"], [("s", 4), ("d", 4)], max_labels=2, broadcast_rows=3)
    assert large.joined_sizes == {"n": 3, "s": 6, "d": 3}
    assert small.spec == large.spec
    key = lambda e: sorted((r.id, tuple(r.slots), tuple(r.deep), r.label) for r in e.transform(table).collect())
    assert key(small) == key(large)


def test_vectors_and_slots_agree(spark, table):
    wide = ["s", "n"]
    rows = en.vector_array(en.fit_transform(table, en.build_pipeline(wide, [en.Deep("d", 3, 4)])))
    counts = freeze(pf.value_counts(table, ["s", "n", "d", "click"]))
    fitted = en.fit_encoding(counts, wide, [("d", 4)])
    assert fitted.wide_dim == (6 - 1) + (3 - 1)
    vectors = {r.id: r.wide_features for r in rows.collect()}
    for r in fitted.transform(table).collect():
        assert vectors[r.id] == [float(i in r.slots) for i in range(fitted.wide_dim)]
        assert sum(i < 5 for i in r.slots) <= 1 and sum(i >= 5 for i in r.slots) <= 1
    dense = en.dense_rows(fitted.transform(table), fitted.wide_dim, fitted.spec)
    reference = en.training_row(rows, 7, "label", ["dSEP3SEP4"])
    assert dense.columns == reference.columns
    assert dense.exceptAll(reference).count() == 0 and dense.count() == 400


def test_encoders_fit_without_reading_rows_again(spark, table):
    model = en.build_pipeline(["s", "n"], []).fit(table)
    path = scratch_dir(spark)
    model.write().save(path)
    again = PipelineModel.load(path).transform(table).select("id", "wide_features_v", "label")
    assert again.exceptAll(model.transform(table).select("id", "wide_features_v", "label")).isEmpty()


def test_one_value_cannot_be_one_hot_encoded(spark, table):
    with_one = table.withColumn("one", F.lit("v"))
    counts = freeze(pf.value_counts(with_one, ["one", "s", "click"]))
    with pytest.raises(ValueError, match="single value"):
        en.fit_encoding(counts, ["one"], [("s", 4)])
    f = featurize(with_one, [("s", 4)])
    assert "one" not in f.encoding.wide and f.rows.count() == 400


def test_wide_columns_of_very_many_values_are_left_out(spark):
    df = spark.range(1000).select(
        "id", F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("string").alias("s"),
        (F.col("id") % 2).cast("int").alias("click"),
    )
    f = featurize(df, [("key", 4)])
    assert f.encoding.wide == ["s"] and f.encoding.spec[0].vocab == 1000


def test_fit_on_train_with_unseen_values(spark, table):
    train = table.where(F.col("s") != "f")
    with pytest.raises(Exception):
        en.fit_transform(table, en.build_pipeline(["s"], []), "train", train).collect()
    rows = en.fit_transform(table, en.build_pipeline(["s"], [], on_invalid="keep"), "train", train)
    assert rows.count() == 400
    f = featurize(table, [("s", 4)], on_invalid="keep", fit_on=train)
    unseen = f.rows.where(F.col("s") == "f").select("deep").distinct().collect()
    assert [r.deep for r in unseen] == [[5]]


def test_labels_are_checked_before_the_driver_takes_them(spark, table):
    counts = freeze(pf.value_counts(table, ["s", "click"]))
    with pytest.raises(ValueError, match="exceed"):
        en.indexer_from_counts(counts, ["s", "click"], ["a", "b"], max_labels=3)


def test_feature_names(spark):
    names = spark.createDataFrame(
        [(0, "device_modelSEP8251SEP256"), (1, "SEP_oddSEP7SEP8")], "pos int, feature string"
    )
    got = [tuple(r) for r in en.feature_spec(names).orderBy("pos").collect()]
    assert got == [(0, "device_model", 8251, 256), (1, "SEP_odd", 7, 8)]
    assert en.parse_feature("device_modelSEP8251SEP256") == en.Deep("device_model", 8251, 256)
    assert en.Deep("app_id", 8552, 256).feature == "app_idSEP8552SEP256"


def test_slot_past_the_array_raises(spark):
    df = spark.createDataFrame([([1.0, 0.0],)], "wide_features array<double>")
    assert en.wide_columns(df, 2).columns == ["wide_feature_0", "wide_feature_1"]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        en.wide_columns(df, 3).collect()


def test_arrays_names_and_floats(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0, 5.0)], "a double, b double, c double, d double")
    named = en.rename_positional(df, en.feature_names(2, [en.Deep("k", 9, 4)]))
    assert named.columns == ["wide_feature_0", "wide_feature_1", "label", "kSEP9SEP4"]
    assert {t for _, t in en.cast_float(named).dtypes} == {"float"}
    row = en.active_slots(en.group_arrays(named, 2, ["kSEP9SEP4"])).first()
    assert row.slots == [0] and row.deep == [5] and row.label == 1.0


def test_short_vocabularies_are_literals_in_the_plan(spark, table):
    odd = table.withColumn("s", F.concat("s", F.lit('",\\u0001 é')))
    counts = freeze(pf.value_counts(odd, ["s", "d", "click"]))
    fitted = en.fit_encoding(counts, ["s"], [("d", 4)])
    rows = fitted.transform(odd)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "Join" not in plan and "UDF" not in plan
    want = {r.value: r.idx for r in en.string_index(odd, ["s"]).where("name = 's'").collect()}
    for r in rows.collect():
        assert r.slots == ([want[r.s]] if want[r.s] < 5 else [])


def wide_table(spark, width=300):
    columns = [((F.col("id") + i) % 3).cast("double").alias(f"wide_feature_{i}") for i in range(width)]
    return spark.range(20).select("id", *columns, F.lit(1.0).alias("label"))


def compiled_projections(df):
    """Projections of the plan that are one method of generated code."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "*(" in line and "Project [" in line]


def test_arrays_of_many_columns_are_not_one_method(spark):
    arrays = en.group_arrays(wide_table(spark), 300, [], keep=["id"])
    assert not [p for p in compiled_projections(arrays) if "wide" in p]
    row = arrays.where("id = 4").first()
    assert row.wide == [float((4 + i) % 3) for i in range(300)] and row.label == 1.0
    assert dict(arrays.dtypes)["wide"] == "array<float>"
