import math

import pytest
from pyspark.sql import functions as F

from clickloom.operators import batches as bt
from clickloom.operators import split as sp
from clickloom.operators.ordering import with_row_index
from clickloom.session import freeze, scratch_dir
from clickloom.sources import features_io as io


@pytest.mark.parametrize("n", [0, 1, 2, 10, 11, 30, 31])
def test_every_row_is_in_one_batch(spark, n, workers=3, chunk=10):
    rows = bt.batch_rows(bt.shard_rows(with_row_index(spark.range(n), ["id"]), workers), chunk)
    got = sorted((r.id, r.worker, r.batch) for r in rows.collect())
    share = max(1, math.ceil(n / workers))
    assert got == [(i, i // share, i % share // chunk) for i in range(n)]


@pytest.mark.parametrize("n,workers,chunk", [(100, 4, 10), (101, 4, 10), (7, 8, 3)])
def test_plan_counts_batches(spark, n, workers, chunk):
    rows = bt.shard_rows(with_row_index(spark.range(n), ["id"]), workers)
    plan = bt.batch_plan(rows, workers, chunk).first()
    exact = rows.select("worker", F.expr(f"worker_row div {chunk}")).distinct().count()
    per_worker = math.ceil(math.ceil(n / workers) / chunk)
    assert (plan.rows, plan.per_worker, plan.total, plan.batches) == (
        n, per_worker, per_worker * workers, exact
    )


def test_every_epoch_is_another_permutation(spark):
    rows = bt.batch_rows(bt.shard_rows(with_row_index(spark.range(200), ["id"]), 2), 10)
    sizes = bt.batch_sizes(rows)
    got = bt.shuffle_batches(sizes, epochs=2, seed=1).collect()
    orders = [
        [(r.worker, r.batch) for r in sorted(got, key=lambda r: r.position) if r.epoch == e]
        for e in (1, 2)
    ]
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])
    assert sorted(r.position for r in got if r.epoch == 1) == list(range(20))
    other = bt.shuffle_batches(sizes, epochs=1, seed=2).collect()
    assert [(r.worker, r.batch) for r in sorted(other, key=lambda r: r.position)] != orders[0]


def test_files_are_batches(spark):
    path = scratch_dir(spark)
    io.write_features(spark.range(100), path, n_files=4)
    rows = bt.file_batches(io.read_features(spark, path, ["id"]))
    per_file = rows.groupBy("file", "batch").agg(F.count("*").alias("n")).orderBy("file").collect()
    assert [r.batch for r in per_file] == [0, 1, 2, 3] and sum(r.n for r in per_file) == 100


def test_random_split_is_disjoint_and_complete(spark):
    parts = sp.random_split(freeze(spark.range(2000)))
    ids = [[r.id for r in p.collect()] for p in parts]
    assert sorted(ids[0] + ids[1]) == list(range(2000)) and 1300 < len(ids[0]) < 1500


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000)
    a = {r.id: r.split for r in sp.hash_split(df, "id").collect()}
    b = {r.id: r.split for r in sp.hash_split(df.repartition(7), "id").collect()}
    assert a == b and set(a.values()) == {"train", "validation"}
    counts = {r.split: r.rows for r in sp.row_counts(sp.hash_split(df, "id")).collect()}
    assert sum(counts.values()) == 2000 and 1300 < counts["train"] < 1500
