"""Probability, log loss, running loss, ROC AUC."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.scalar import logistic_loss, sigmoid
from clickloom.operators.ordering import with_running_totals
from clickloom.session import col


def probability(df: DataFrame, logit: str = "logit") -> DataFrame:
    return df.withColumn("probability", sigmoid(col(logit)))


def _checked(df: DataFrame, score: str, label: str) -> tuple[Column, Column]:
    """Score and label as doubles; a NULL or NaN score and labels other than 0 and 1 are errors."""
    value, truth = col(score).cast("double"), col(label).cast("double")
    valued = F.when(value.isNotNull() & ~F.isnan(value), value)
    labelled = F.when(truth.isin(0.0, 1.0), truth)
    return (
        F.coalesce(valued, F.raise_error(F.lit(f"{score} is missing in a row")).cast("double")),
        F.coalesce(labelled, F.raise_error(F.lit(f"{label} is neither 0 nor 1 in a row")).cast("double")),
    )


def log_loss(df: DataFrame, logit: str = "logit", label: str = "label") -> DataFrame:
    """(log_loss): mean binary cross-entropy. Every row needs a logit and a label 0 or 1."""
    value, truth = _checked(df, logit, label)
    rows = df.select(value.alias("logit"), truth.alias("label"))
    return rows.agg(F.avg(logistic_loss(F.col("logit"), F.col("label"))).alias("log_loss"))


def running_loss(
    batches: DataFrame, by: Sequence[str] = ("epoch", "split"), order: Sequence[str] = ("batch",)
) -> DataFrame:
    """Add ``running_loss``: the row-weighted mean of ``loss`` over the batches so far.

    ``batches`` has one row per batch with ``loss`` (its mean) and ``rows``.
    """
    weighted = with_running_totals(
        batches, list(by), list(order),
        {"__loss": F.col("loss") * F.col("rows"), "__rows": F.col("rows")},
    )
    return weighted.select(
        *[col(c) for c in batches.columns], (F.col("__loss") / F.col("__rows")).alias("running_loss")
    )


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range of ascending scores: totals and pairs won within the range."""
    first, positives, negatives, won = None, 0.0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        pos = batch.column("pos").to_numpy().astype(np.float64)
        neg = batch.column("neg").to_numpy().astype(np.float64)
        if first is None:
            first = float(batch.column("score")[0].as_py())
        below = negatives + np.cumsum(neg) - neg
        won += float(np.dot(pos, below + neg / 2))
        positives += float(pos.sum())
        negatives += float(neg.sum())
    if first is not None:
        yield pa.RecordBatch.from_pydict(
            {"first": [first], "pos": [positives], "neg": [negatives], "won": [won]}
        )


def roc_auc(df: DataFrame, score: str = "probability", label: str = "label") -> DataFrame:
    """(roc_auc): share of positive-negative pairs ranked rightly, ties counting half.

    Equal scores are added up first, so a score that a third of the rows share is one row. The
    distinct scores are laid out in ranges, each range adds up its own pairs in order, and only
    the ranges' totals, one row each, meet. NULL if one class is absent. Every row needs a score
    and a label 0 or 1.
    """
    value, truth = _checked(df, score, label)
    positive = F.col("label") == 1.0
    points = (
        df.select(value.alias("score"), truth.alias("label"))
        .groupBy("score")
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
        .repartitionByRange("score")
        .sortWithinPartitions("score")
    )
    ranges = points.mapInArrow(_pair_counts, "first double, pos double, neg double, won double")
    before = F.coalesce(
        F.sum("neg").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0.0),
    )
    pairs = F.sum("pos") * F.sum("neg")
    return (
        ranges.withColumn("won", F.col("won") + F.col("pos") * before)
        .agg(F.try_divide(F.sum("won"), pairs).alias("roc_auc"))
    )
