import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import evaluate as ev
from clickloom.operators import network as nw
from clickloom.operators import parts as parts_of
from clickloom.operators import train as tr
from clickloom.operators.embedding_table import EmbeddingTable, coasted, drawn_embeddings, init_embeddings
from clickloom.operators.encode import Deep
from clickloom.session import scratch_dir
from clickloom.sources.features_io import load_parameters
from test_network import HIDDEN, SPEC, WIDE, make_rows


def dense_adam(params, batches, lr):
    """Plain Adam over every parameter, one batch after another."""
    p = {k: v.astype(np.float64) for k, v in params.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    for t, rows in enumerate(batches, 1):
        deep = np.array([r[2] for r in rows])
        at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
        slots = np.array([s for r in rows for s in r[1]], dtype=int)
        label = np.array([r[3] for r in rows])
        g = tr.gradient(p, ["a", "b"], deep, at, slots, 1.0, label)
        full = {k: x / len(rows) for k, x in g.dense.items()}
        for k, (index, x) in g.sparse.items():
            full[k] = np.zeros_like(p[k])
            full[k][index] = x / len(rows)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * full[k]
            v[k] = 0.999 * v[k] + 0.001 * full[k] ** 2
            p[k] -= lr * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return p


def test_one_worker_is_sequential_adam(spark):
    rows, df = make_rows(spark, 130)
    df = spark.createDataFrame(rows, "id bigint, slots array<int>, deep array<int>, label double")
    params = nw.init_parameters(SPEC, WIDE, HIDDEN, seed=5)
    moments, steps = tr._moments(params), 0
    p = params
    for _ in range(2):
        p, moments, steps, loss, n = tr.train_round(
            df.coalesce(1), p, moments, steps, SPEC, 0.01, 32, 0.0, [1]
        )
    assert (steps, n) == (10, 130)
    batches = [rows[i : i + 32] for i in range(0, 130, 32)] * 2
    want = dense_adam(params, batches, 0.01)
    for k in params:
        assert np.allclose(p[k], want[k], atol=2e-4), k


@pytest.mark.parametrize("workers,rounds,dropout,batch_size", [(1, 1, 0.0, 64), (3, 2, 0.3, 32), (4, 1, 0.5, 50)])
def test_same_parameters_on_both_sides_of_the_bound(spark, workers, rounds, dropout, batch_size):
    """Embeddings sent to the workers or kept as a table: the same steps, losses and parameters."""
    df = tr.freeze(planted(spark, 700))
    run = lambda max_bytes: tr.fit(
        df, SPEC, WIDE, hidden=HIDDEN, epochs=2, batch_size=batch_size, lr=0.02, dropout=dropout,
        workers=workers, rounds=rounds, max_bytes=max_bytes, key="id",
    )
    sent, kept = run(1 << 28), run(10)
    a, b = nw.collect_parameters(sent.params), nw.collect_parameters(kept.params)
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], atol=1e-5), k
    for x, y in zip(sent.history.orderBy("epoch").collect(), kept.history.orderBy("epoch").collect()):
        assert x.train_loss == pytest.approx(y.train_loss, abs=1e-6)
    by = ["epoch", "round", "worker", "batch"]
    x, y = (f.losses.orderBy(*by).toPandas() for f in (sent, kept))
    assert x[by + ["rows"]].equals(y[by + ["rows"]]) and np.allclose(x.loss, y.loss, atol=1e-5)


def test_history_is_the_mean_of_the_batches(spark):
    df = tr.freeze(planted(spark, 500))
    fitted = tr.fit(df, SPEC, WIDE, hidden=HIDDEN, epochs=2, batch_size=32, workers=2, rounds=2, key="id")
    running = ev.running_loss(
        fitted.losses.select("epoch", F.lit("train").alias("split"), F.struct("round", "worker", "batch").alias("batch"), "rows", "loss")
    )
    last = {r.epoch: r.running_loss for r in running.orderBy("batch").collect()}
    rows = fitted.losses.groupBy("epoch").agg(F.sum("rows").alias("n"), F.max("rows").alias("most")).collect()
    assert [(r.n, r.most) for r in rows] == [(500, 32)] * 2
    for r in fitted.history.collect():
        assert r.train_loss == pytest.approx(last[r.epoch], abs=1e-6)


def test_rows_that_nobody_meets_go_on_by_their_moments(spark):
    """Three rounds that meet different rows, next to plain Adam over everything."""
    rows, _ = make_rows(spark, 90)
    df = spark.createDataFrame(rows, "id bigint, slots array<int>, deep array<int>, label double")
    staged = df.select(
        "slots", "deep", F.col("label").cast("float").alias("label"), F.col("id").alias("turn"),
        F.floor(F.col("deep")[0] / 3).cast("int").alias("round"), F.lit(0).alias("worker"),
    )
    model = tr._TableModel(spark, SPEC, WIDE, HIDDEN, 5, 1, 1000, staged)
    start, batches = nw.collect_parameters(model.params()), []
    for r in (0, 1, 2, 0):
        _, loss, n = model.round(staged.where(F.col("round") == r), 0.01, 0.0, [1, 0, r])
        batches.append([x for x in rows if x[2][0] // 3 == r])
        assert n == len(batches[-1])
    got, want = nw.collect_parameters(model.params()), dense_adam(start, batches, 0.01)
    for k in want:
        assert np.allclose(got[k], want[k], atol=2e-4), k


def test_the_table_is_not_shuffled(spark):
    table = EmbeddingTable.drawn(spark, [Deep("a", 5000, 4), Deep("b", 30, 2)], seed=1)
    keys = spark.range(400).selectExpr("cast(id % 3 as int) as worker", "concat('emb:', if(id < 390, 'a', 'b')) as tensor", "cast(id % 390 as int) as row")
    joined = table.touched(keys)
    assert joined.count() == 400
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    sums = spark.createDataFrame([("emb:a", 7, [1.0] * 12 + [4.0])], "tensor string, row int, values array<float>")
    after = table.moved(sums, 0, 0.1, {1: 4.0})
    assert after.rows.count() == 5030
    a, b = nw.collect_parameters(table.rows.select("tensor", "row", "values")), nw.collect_parameters(after.rows.select("tensor", "row", "values"))
    assert np.allclose(b["emb:a"][7], a["emb:a"][7] + 0.25)
    assert np.array_equal(np.delete(a["emb:a"], 7, 0), np.delete(b["emb:a"], 7, 0))
    assert np.array_equal(a["emb:b"], b["emb:b"])


def test_moments_alone_move_like_plain_adam():
    rng = np.random.default_rng(2)
    p, m = rng.normal(size=(5, 3)), rng.normal(size=(5, 3))
    v = m * m
    q, found = p.copy(), coasted(p, m, v, 4, 0.1, [2, 5])
    mm, vv = m.copy(), v.copy()
    for t in range(5, 10):
        mm, vv = 0.9 * mm, 0.999 * vv
        q -= 0.1 * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.999**t)) + 1e-8)
        if t in (6, 9):
            got = found[(t - 5) // 3]
            assert all(np.allclose(a, b) for a, b in zip(got, (q - p, mm - m, vv - v)))


@pytest.mark.parametrize("tasks", [1, 17, 40])
def test_sums_are_a_tree(spark, tasks):
    """No group reads more parts than about the square root of the tasks, and sums are the same."""
    def send(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                yield parts_of.part("t", np.arange(3), 2, np.full((3, 2), float(i)))
                yield parts_of.part("e", np.array([i % 5]), 1, np.ones((1, 4)))

    sent = spark.range(0, tasks, 1, tasks).mapInArrow(send, parts_of.PART_SCHEMA)
    assert parts_of.task_number(spark.range(0, tasks, 1, tasks)) == tasks
    found = {(r.tensor, r.row): (r.n, r["values"]) for r in parts_of.sum_parts(sent, tasks).collect()}
    total = float(sum(range(tasks)))
    assert all(found["t", k] == (2.0 * tasks, [total, total]) for k in range(3))
    assert sum(found["e", k][0] for k in range(5) if ("e", k) in found) == tasks
    lane = F.pmod(F.spark_partition_id(), F.lit(parts_of.lanes(tasks)))
    most = sent.where("tensor = 't' and row = 0").groupBy(lane.alias("lane")).count().agg(F.max("count")).first()[0]
    bound = max(parts_of.FEW_TASKS, math.ceil(math.sqrt(tasks)))
    assert most <= bound and parts_of.lanes(tasks) <= bound


def test_made_embeddings_look_normal(spark):
    spec = [Deep("a", 5000, 40), Deep("b", 30, 4)]
    found = nw.collect_parameters(init_embeddings(spark, spec, seed=1).select("tensor", "row", "values"))
    drawn = drawn_embeddings(spec, 1)
    assert found.keys() == drawn.keys() and all(np.array_equal(found[k], drawn[k]) for k in found)
    a = found["emb:a"]
    assert a.shape == (5000, 40) and found["emb:b"].shape == (30, 4)
    assert abs(a.mean()) < 0.03 and abs(a.std() - 1) < 0.03
    assert abs(np.corrcoef(a[:, 0], a[:, 1])[0, 1]) < 0.2


def test_workers_are_averaged_by_rows(spark):
    _, df = make_rows(spark, 200)
    params = nw.init_parameters(SPEC, WIDE, HIDDEN, seed=5)
    zero = tr._moments(params)
    run = lambda d: tr.train_round(d, params, zero, 0, SPEC, 0.01, 64, 0.0, [1])
    parts = df.repartition(2).withColumn("at", F.spark_partition_id())
    written = tr.freeze(parts)
    one = run(written.where("at = 0").coalesce(1))
    two = run(written.where("at = 1").coalesce(1))
    both = run(written.repartitionByRange(2, "at").sortWithinPartitions("at"))
    assert one[4] + two[4] == both[4] == 200
    for k in params:
        want = (one[0][k] * one[4] + two[0][k] * two[4]) / 200
        assert np.allclose(both[0][k], want, atol=0.02), k


def planted(spark, n=4000):
    key = F.xxhash64("id")
    a, b = F.pmod(key, F.lit(7)).cast("int"), F.pmod(F.shiftright(key, 8), F.lit(5)).cast("int")
    slot = F.pmod(F.shiftright(key, 16), F.lit(WIDE)).cast("int")
    signal = (F.pmod(a + slot, F.lit(2)) == 0) | (F.pmod(F.shiftright(key, 24), F.lit(10)) == 0)
    return spark.range(n).select(
        "id", F.array(slot).alias("slots"), F.array(a, b).alias("deep"), signal.cast("double").alias("label")
    )


@pytest.mark.parametrize("workers,rounds,max_bytes,lr", [(1, 1, 1 << 28, 0.02), (3, 2, 1 << 28, 0.03), (2, 4, 10, 0.05)])
def test_planted_signal_is_learned(spark, workers, rounds, max_bytes, lr):
    df = tr.freeze(planted(spark))
    train, held_out = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    path = scratch_dir(spark)
    fitted = tr.fit(
        train, SPEC, WIDE, held_out, hidden=(16, 8), epochs=3, batch_size=64, lr=lr,
        dropout=0.2, workers=workers, rounds=rounds, path=path, max_bytes=max_bytes,
    )
    history = fitted.history.orderBy("epoch").collect()
    assert min(r.val_loss for r in history) < math.log(2)
    assert [r.is_best for r in history][0]
    scored = nw.score_table(held_out, load_parameters(spark, path), SPEC)
    assert ev.roc_auc(scored).first()[0] > 0.5
    best = tr.best_epoch(fitted.history).first()
    assert ev.log_loss(scored).first()[0] == pytest.approx(best.val_loss, abs=1e-6)


def test_same_seed_same_parameters(spark):
    df = tr.freeze(planted(spark, 500))
    run = lambda seed: nw.collect_parameters(
        tr.fit(df, SPEC, WIDE, hidden=HIDDEN, epochs=1, batch_size=64, workers=1, seed=seed).params
    )
    a, b, c = run(1), run(1), run(2)
    assert all(np.array_equal(a[k], b[k]) for k in a)
    assert any(not np.array_equal(a[k], c[k]) for k in a)


def test_more_rounds_than_rows(spark):
    fitted = tr.fit(planted(spark, 3), SPEC, WIDE, hidden=HIDDEN, epochs=1, workers=2, rounds=4)
    assert fitted.history.count() == 1
    with pytest.raises(ValueError, match="no training rows"):
        tr.fit(planted(spark, 0), SPEC, WIDE, hidden=HIDDEN, epochs=1)


def test_learning_rate_steps(spark):
    df = spark.range(12).select(F.col("id").alias("epoch"))
    got = {r.epoch: r.lr for r in tr.lr_schedule(df).collect()}
    for e in range(12):
        assert got[e] == pytest.approx(1e-3 * 0.1 ** (e // 5))
        assert tr.learning_rate(1e-3, e) == pytest.approx(got[e])


def test_best_is_the_first_lowest_epoch(spark):
    rows = [(1, 0.5), (2, 0.4), (3, 0.4), (4, 0.45), (5, 0.39)]
    history = spark.createDataFrame(rows, "epoch int, val_loss double")
    assert [r.is_best for r in tr.mark_best(history).orderBy("epoch").collect()] == [
        True, True, False, False, True,
    ]
    assert tuple(tr.best_epoch(history.where("epoch < 5")).first()) == (2, 0.4)


def test_stage_spreads_equal_rows(spark):
    df = spark.range(0, 4000, 1, 8).select(
        F.array(F.lit(1)).alias("slots"), F.array(F.lit(0), F.lit(0)).alias("deep"), F.lit(1.0).alias("label")
    )
    rows = tr.stage(df, workers=2, rounds=2)
    assert rows.count() == 4000
    assert rows.groupBy("round").count().count() == 2


@pytest.mark.parametrize("workers", [2, 4, 8])
def test_workers_are_balanced_and_do_not_depend_on_splits(spark, workers):
    df = planted(spark, 4000)
    found = []
    for parts in (1, 7):
        rows = tr.stage(df.repartition(parts), workers, 1, key="id")
        laid = rows.repartitionById(workers, F.col("worker")).withColumn("part", F.spark_partition_id())
        sizes = {r.part: r["count"] for r in laid.groupBy("part").count().collect()}
        assert len(sizes) == workers and min(sizes.values()) > 0.7 * 4000 / workers
        found.append({(r.turn, r.worker) for r in rows.collect()})
        assert tr.lay_out(rows, workers, [1]).rdd.getNumPartitions() == workers
    assert found[0] == found[1]


def test_order_changes_each_epoch(spark):
    rows = tr.stage(planted(spark, 300), 1, 1, key="id")
    orders = [[tuple(map(str, r)) for r in tr.lay_out(rows, 1, [5, e, 0]).collect()] for e in (0, 0, 1)]
    assert orders[0] == orders[1] != orders[2] and sorted(orders[0]) == sorted(orders[2])


def test_losses_that_are_no_numbers_are_never_best(spark):
    nan = float("nan")
    history = spark.createDataFrame([(1, nan), (2, 0.5), (3, nan), (4, 0.4)], "epoch int, val_loss double")
    assert [r.is_best for r in tr.mark_best(history).orderBy("epoch").collect()] == [False, True, False, True]
    with pytest.raises(ValueError, match="no validation rows"):
        df = planted(spark, 50)
        tr.fit(df, SPEC, WIDE, df.limit(0), hidden=HIDDEN, epochs=1)


@pytest.mark.parametrize("width", [1, 7, 256, 1 << 20])
def test_neighbouring_rows_fall_to_different_blocks(width):
    index = np.arange(1000, 3000)
    block, inside = parts_of.place(index, width)
    assert len(set(block)) >= parts_of.STRIDE and max(np.bincount(block)) <= parts_of.block_rows(width) + 1
    assert inside.max() < parts_of.block_rows(width)
    assert all(parts_of.rows_of(int(b), i, width) == row for b, i, row in zip(block[:300], inside, index))


def test_superseded_tables_are_deleted(spark):
    rows = tr.stage(planted(spark, 60), 2, 1, key="id")
    model = tr._TableModel(spark, SPEC, WIDE, HIDDEN, 5, 2, 16, rows)
    first = model.table
    model.round(rows, 0.01, 0.0, [1, 0, 0])
    best = model.keep()
    for k in (1, 2):
        model.round(rows, 0.01, 0.0, [1, k, 0])
    assert best.count() == model.params().count()
    with pytest.raises(Exception, match="exist"):
        spark.read.parquet(first.path)
    assert not spark.catalog.tableExists(first.name)


def test_gradient_of_many_rows_holds_a_bounded_number_of_them(spark, monkeypatch):
    sums = tr._RowSums(5000, 4)
    monkeypatch.setattr(tr, "HELD_BYTES", 0)
    small, sent = tr._RowSums(5000, 4), []
    rng = np.random.default_rng(3)
    for _ in range(6):
        index = rng.permutation(5000)[:2000]
        values = rng.integers(0, 9, (2000, 4)).astype(np.float32)
        assert sums.add(index, values) is None
        if (full := small.add(index, values)) is not None:
            sent.append(full)
    assert len(small.sums) == tr.CHUNK_ROWS and sent
    total = np.zeros((5000, 4))
    for index, values in [*sent, small.taken()]:
        assert len(index) <= tr.CHUNK_ROWS and len(set(index)) == len(index)
        total[index] += values
    whole = np.zeros((5000, 4))
    index, values = sums.taken()
    whole[index] = values
    assert (total == whole).all() and len(small.taken()[0]) == 0


def test_moves_in_blocks_of_rows_are_those_of_all_rows(monkeypatch):
    from clickloom.operators import embedding_table as et

    rng = np.random.default_rng(5)
    p, m, v = (rng.random((50, 8), dtype=np.float32) for _ in range(3))
    m[::3], v[::3] = 0, 0
    whole = et.coasted(p, m, v, 3, 1e-3, [2, 5])
    monkeypatch.setattr(et, "BLOCK_VALUES", 64)
    assert [s.stop - s.start for s in et.row_blocks(50, 8)] == [8] * 6 + [2]
    for a, b in zip(whole, et.coasted(p, m, v, 3, 1e-3, [2, 5])):
        assert all((x == y).all() for x, y in zip(a, b)) and not a[0][::3].any() and a[0][1::3].any(axis=1).all()
    change, m1, v1 = et.adam_move(p, m, v, np.float32(0), *et.rate_and_root(1e-3, 4))
    one = et.coasted(p, m, v, 3, 1e-3, [1])[0]
    assert np.allclose(one[0], -change, atol=1e-6) and np.allclose(one[1], m1 - m, atol=1e-6)


def test_rows_of_the_table_travel_as_bytes(spark):
    rows = tr.stage(planted(spark, 60), 2, 1, key="id")
    model = tr._TableModel(spark, SPEC, WIDE, HIDDEN, 5, 2, 16, rows)
    assert dict(model.table.states.dtypes) == {"tensor": "string", "row": "int", "state": "binary"}
    parts = tr.table_round_parts(rows, model.table, model.dense, model.moments, 0, SPEC, 0.01, 16, 0.0, [1, 0, 0], 2, [2])
    assert dict(parts.dtypes)["values"] == "binary"
    told, loss, n = model.round(rows, 0.01, 0.0, [1, 0, 0])
    assert n == sum(b[2] for b in told) == 60 and loss == pytest.approx(sum(b[2] * b[3] for b in told), rel=1e-5)


@pytest.mark.parametrize("steps,count", [(0, 1), (0, 16), (3, 7), (40, 16), (5000, 16)])
def test_steps_without_gradient_are_taken_at_once(steps, count):
    from clickloom.operators import embedding_table as et

    rng = np.random.default_rng(7)
    p, m = rng.normal(size=(9, 4)), rng.normal(size=(9, 4)) * 1e-6
    v = rng.random((9, 4)) * 10.0 ** rng.integers(-18, -8, (9, 4))
    v[0] = m[0] = 0
    at_once = p.copy(), m.copy(), v.copy()
    plan = et.Coasting(steps, 1e-3, count)
    plan.move(*at_once)
    assert plan.terms is None or len(plan.terms) < count
    for t in range(steps + 1, steps + count + 1):
        change, m, v = et.adam_move(p, m, v, 0.0, *et.rate_and_root(1e-3, t))
        p = p - change
    for a, b in zip(at_once, (p, m, v)):
        assert np.allclose(a, b, rtol=1e-7, atol=1e-12)


def test_rows_that_a_batch_does_not_meet_are_moved_when_they_are_met():
    params = {"emb:a": np.ones((6, 2)), "out.bias": np.zeros((1, 1))}
    moments = {f"{k}:{t}": np.full_like(v, 1e-3) for k in "mv" for t, v in params.items()}
    moments["m:emb:a"][5], moments["v:emb:a"][5] = 0, 0
    adam = tr.Adam({t: v.copy() for t, v in params.items()}, {t: v.copy() for t, v in moments.items()}, 3, 0.01)
    for _ in range(4):
        adam.ready("emb:a", np.array([1]))
        adam.step(tr.Gradient({"out.bias": np.zeros((1, 1))}, {"emb:a": (np.array([1]), np.zeros((1, 2)))}, 0.0, 1))
    assert (adam.at["emb:a"] == [3, 7, 3, 3, 3, 3]).all() and (adam.p["emb:a"][0] == 1).all()
    adam.finish()
    assert np.allclose(adam.p["emb:a"][:5], adam.p["emb:a"][1], atol=1e-9) and (adam.p["emb:a"][5] == 1).all()


@pytest.mark.parametrize("values,rows", [(3, 100), (60, 100), (5000, 100)])
def test_sums_over_equal_rows(values, rows):
    rng = np.random.default_rng(9)
    index, x = rng.integers(0, values, rows), rng.integers(0, 9, (rows, 3)).astype(np.float32)
    index[: rows // 3] = 1
    for column in (index, np.arange(rows)):
        met = tr._Met(column)
        want = [x[column == i].sum(axis=0) for i in met.index]
        assert (met.sums(x) == want).all() and (met.index[met.place()] == column).all()


def test_batches_do_not_part_equal_rows():
    import pyarrow as pa

    from clickloom.operators import embedding_table as et

    row, tensor = np.array([1, 1, 2, 2, 2, 2, 2, 1], np.int32), ["a"] * 7 + ["b"]
    whole = pa.RecordBatch.from_arrays([pa.array(tensor), pa.array(row)], names=["tensor", "row"])
    for size in (1, 2, 3, 8):
        found = list(et._grouped(iter([whole.slice(i, size) for i in range(0, 8, size)])))
        keys = [set(zip(b.column("tensor").to_pylist(), b.column("row").to_pylist())) for b in found]
        assert sum(b.num_rows for b in found) == 8 and sum(map(len, keys)) == 3


def test_files_and_table_take_the_same_steps(spark):
    """Three workers, two rounds that share only some rows, with and without a file to open."""
    from clickloom.session import opened_path

    rows = tr.stage(planted(spark, 300), 3, 2, key="id")
    table = tr._TableModel(spark, SPEC, WIDE, HIDDEN, 5, 3, 16, rows)
    files = tr._FileModel(spark, SPEC, WIDE, HIDDEN, 5, 3, 16, opened_path(spark, scratch_dir(spark)))
    for seed in ([1, 0, 0], [1, 0, 1], [1, 1, 0]):
        of = rows.where(F.col("round") == seed[-1])
        (told, loss, n), (told2, loss2, n2) = table.round(of, 0.01, 0.3, seed), files.round(of, 0.01, 0.3, seed)
        assert n == n2 == of.count() and loss == pytest.approx(loss2, rel=1e-6)
        assert sorted(t[:3] for t in told) == sorted(t[:3] for t in told2)
        assert (table.steps, len(told)) == (files.steps, len(told2))
    a, b = nw.collect_parameters(table.params()), nw.collect_parameters(files.params())
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-6) for k in a)
    assert files.round(rows.limit(0), 0.01, 0.3, [1, 2, 0]) == ([], 0.0, 0)
    best, kept = files.keep(), files.files.folder
    files.round(rows, 0.01, 0.0, [1, 3, 0])
    files.round(rows, 0.01, 0.0, [1, 3, 1])
    assert best.count() == files.params().count()
    import os

    assert sorted(os.listdir(files.folder)) == sorted([os.path.basename(kept), str(files.rounds)])


def test_ranges_of_files_hold_the_rows_of_the_table(spark, monkeypatch):
    from clickloom.operators import embedding_files as ef
    from clickloom.session import opened_path

    monkeypatch.setattr(ef, "RANGE_BYTES", 1)
    spec = [Deep("a", 2500, 40), Deep("b", 30, 4), Deep("c", 0, 4)]
    files = ef.EmbeddingFiles.drawn(spark, opened_path(spark, scratch_dir(spark)), spec, 1)
    assert [(r.first, r.end) for r in files.ranges] == [(0, 1024), (1024, 2048), (2048, 2500), (0, 30)]
    drawn, found = drawn_embeddings(spec, 1), nw.collect_parameters(files.values())
    assert all(np.array_equal(found[k], drawn[k]) for k in ("emb:a", "emb:b"))
    rows = np.array([0, 1023, 1024, 2499])
    assert np.array_equal(files.states("emb:a", rows)[:, :40], drawn["emb:a"][rows])
    assert files.states("emb:c", rows[:0]).shape == (0, 12)
