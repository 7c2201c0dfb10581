from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import batches as bt
from clickloom.operators.permutation import permuted, permuted_number
from clickloom.session import freeze, scratch_dir
from clickloom.sources import features_io as io


def test_a_permutation_for_every_size():
    for n in range(1001):
        assert sorted(permuted_number(i, n, 42, 1) for i in range(n)) == list(range(n))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 257])
def test_column_and_number_agree(spark, n):
    df = spark.range(n).crossJoin(spark.range(1, 3).withColumnRenamed("id", "epoch"))
    for r in df.select("id", "epoch", permuted(F.col("id"), n, 7, F.col("epoch")).alias("at")).collect():
        assert r["at"] == permuted_number(r.id, n, 7, r.epoch)


def test_places_look_random():
    seen = Counter()
    for seed in range(400):
        seen.update((i, permuted_number(i, 8, seed)) for i in range(8))
    assert len(seen) == 64 and all(20 < k < 90 for k in seen.values())


def test_batches_are_ordered_without_a_shuffle(spark):
    rows = [(w, b, 5) for w in range(3) for b in range(7 if w < 2 else 4)]
    plan = freeze(spark.createDataFrame(rows, "worker int, batch bigint, rows bigint"))
    order = bt.shuffle_batches(plan, 2)
    assert "Exchange" not in order._jdf.queryExecution().executedPlan().toString()
    found = order.collect()
    for e in (1, 2):
        mine = [r for r in found if r.epoch == e]
        assert sorted(r.position for r in mine) == list(range(18))
    assert [r.position for r in found if r.epoch == 1] != [r.position for r in found if r.epoch == 2]
    with pytest.raises(ValueError, match="gap"):
        bt.shuffle_batches(plan.where("worker <> 1 or batch <> 3"), 2)
    assert bt.shuffle_batches(plan.limit(0), 2).count() == 0


def test_one_batch_is_one_file(spark):
    path = scratch_dir(spark)
    io.write_features(spark.range(700), path, n_files=7)
    read = io.read_features(spark, path, ["id"])
    numbered = bt.file_batches(read).collect()
    for k in (0, 3, 6):
        batch = io.read_batch(spark, path, ["id"], k)
        assert len(batch.inputFiles()) == 1
        assert sorted(r.id for r in batch.collect()) == sorted(r.id for r in numbered if r.batch == k)
    assert io.batch_files(spark, scratch_dir(spark)) == []
    with pytest.raises(IndexError):
        io.read_batch(spark, path, ["id"], 7)
