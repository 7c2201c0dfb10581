import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clickloom.operators import evaluate as ev


def auc(spark, rows):
    df = spark.createDataFrame([(float(s), float(y)) for s, y in rows], "probability double, label double")
    return ev.roc_auc(df.repartition(3)).first()[0]


def brute(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([(0.5, 0), (0.5, 1), (0.5, 1)], 0.5),
        ([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], 1.0),
        ([(0.1, 1), (0.2, 1), (0.8, 0), (0.9, 0)], 0.0),
        ([(0.1, 1), (0.2, 1)], None),
        ([(0.1, 0)], None),
        ([], None),
    ],
)
def test_auc_edges(spark, rows, expected):
    assert auc(spark, rows) == expected


@pytest.mark.parametrize("values", [5, 100_000])
def test_auc_with_and_without_ties(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values), int(rng.random() < 0.3)) for _ in range(600)]
    want = brute(rows)
    assert auc(spark, rows) == pytest.approx(want, abs=1e-12)
    assert auc(spark, [(-s, y) for s, y in rows]) == pytest.approx(1 - want, abs=1e-12)
    assert auc(spark, [(math.atan(s), y) for s, y in rows]) == pytest.approx(want, abs=1e-12)
    df = spark.createDataFrame([(float(s), float(y)) for s, y in rows], "rawPrediction double, label double")
    assert BinaryClassificationEvaluator(numBins=0).evaluate(df) == pytest.approx(want, abs=1e-12)


def test_auc_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(1)
        rows = [(rng.random(), int(rng.random() < 0.5)) for _ in range(500)]
        assert auc(spark, rows) == pytest.approx(brute(rows), abs=1e-12)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_log_loss_is_stable(spark):
    def loss(x, y):
        df = spark.createDataFrame([(float(x), float(y))], "logit double, label double")
        return ev.log_loss(df).first()[0]

    assert loss(0, 1) == pytest.approx(math.log(2)) and loss(0, 0) == pytest.approx(math.log(2))
    assert loss(800, 1) == 0 and loss(800, 0) == 800 and loss(-800, 1) == 800
    assert loss(50, 1) == pytest.approx(math.exp(-50)) and loss(-50, 0) == pytest.approx(math.exp(-50))


def test_probability(spark):
    df = spark.createDataFrame([(0.0,), (800.0,), (-800.0,)], "logit double")
    assert [r.probability for r in ev.probability(df).collect()] == [0.5, 1.0, 0.0]


def test_running_loss(spark):
    rows = [(e, "train", b, (b + 1) * 0.1, 10 - b) for e in (1, 2) for b in range(5)]
    df = spark.createDataFrame(rows, "epoch int, split string, batch int, loss double, rows int")
    got = {(r.epoch, r.batch): r.running_loss for r in ev.running_loss(df).collect()}
    for e in (1, 2):
        for b in range(5):
            part = [r for r in rows if r[0] == e and r[2] <= b]
            want = sum(r[3] * r[4] for r in part) / sum(r[4] for r in part)
            assert got[e, b] == pytest.approx(want)


@pytest.mark.parametrize("row", [(None, 1.0), (float("nan"), 1.0), (0.5, None), (0.5, 2.0)])
def test_rows_without_score_or_label_are_refused(spark, row):
    df = spark.createDataFrame([(0.1, 0.0), (0.9, 1.0), row], "logit double, label double")
    for run in (ev.log_loss, lambda d: ev.roc_auc(d, "logit", "label")):
        with pytest.raises(Exception, match="is missing|neither 0 nor 1"):
            run(df).collect()
