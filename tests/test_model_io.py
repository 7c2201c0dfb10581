import pytest
from pyspark.sql import functions as F

from clickloom.operators import network as nw
from clickloom.operators.encode import fit_encoding
from clickloom.operators.profile import value_counts
from clickloom.session import freeze, scratch_dir
from clickloom.sources.model_io import load_model, save_model, versions


def rows(spark, n=300):
    return spark.range(n).select(
        "id", (F.col("id") % 2).cast("int").alias("click"), (F.col("id") % 5).cast("int").alias("a b`c"),
        F.concat(F.lit("v,'\"\n"), F.col("id") % 7).alias("text"), F.concat(F.lit("big"), F.col("id") % 200).alias("many"),
    )


def fitted(spark, on_invalid="error", n=300):
    names = ["a b`c", "text", "many", "click"]
    counts = freeze(value_counts(rows(spark, n), names))
    return fit_encoding(counts, ["a b`c", "text"], [("many", 4), ("text", 2)], on_invalid=on_invalid)


@pytest.mark.parametrize("on_invalid", ["error", "keep", "skip"])
def test_another_session_scores_raw_rows(spark, on_invalid):
    encoding, path = fitted(spark, on_invalid), scratch_dir(spark)
    assert encoding.joined is not None and "text" in encoding.labels
    params = nw.parameter_table(spark, nw.init_parameters(encoding.spec, encoding.wide_dim, (4, 3)))
    assert save_model(encoding, params, path) == 1
    raw = rows(spark).unionByName(
        rows(spark, 3).withColumn("many", F.lit("unseen")) if on_invalid != "error" else rows(spark, 0)
    )
    want = nw.score_table(encoding.transform(raw), params, encoding.spec).collect()
    other = spark.newSession()
    raw.write.parquet(f"{path}/raw")
    model = load_model(other, path)
    got = model.score(other.read.parquet(f"{path}/raw")).collect()
    for a, b in zip(sorted(got), sorted(want)):
        assert tuple(a)[:2] == tuple(b)[:2] and a.logit == pytest.approx(b.logit, abs=1e-6)
    assert len(got) == len(want) == (303 if on_invalid == "keep" else 300)
    assert model.encoding.spec == encoding.spec and model.encoding.wide_dim == encoding.wide_dim


def test_unseen_values_are_an_error_after_loading(spark):
    encoding, path = fitted(spark), scratch_dir(spark)
    save_model(encoding, nw.parameter_table(spark, nw.init_parameters(encoding.spec, encoding.wide_dim, (2,))), path)
    with pytest.raises(Exception, match="NULL or unseen value in many"):
        load_model(spark, path).score(rows(spark, 2).withColumn("many", F.lit("x"))).collect()


def test_versions_stand_side_by_side(spark):
    path = scratch_dir(spark)
    assert versions(spark, path) == []
    with pytest.raises(ValueError, match="no version"):
        load_model(spark, path)
    first, second = fitted(spark), fitted(spark, n=150)
    make = lambda e, seed: nw.parameter_table(spark, nw.init_parameters(e.spec, e.wide_dim, (2,), seed=seed))
    assert (save_model(first, make(first, 1), path), save_model(second, make(second, 2), path)) == (1, 2)
    # a save that broke off before its end
    make(first, 3).write.parquet(f"{path}/v000003/parameters")
    assert versions(spark, path) == [1, 2]
    assert load_model(spark, path).encoding.sizes["many"] == 150
    assert load_model(spark, path, 1).encoding.sizes["many"] == 200
    assert save_model(first, make(first, 4), path) == 4
    with pytest.raises(ValueError, match="no version 3"):
        load_model(spark, path, 3)
