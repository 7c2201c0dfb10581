"""Row numbers, ranks and running totals over the whole table without a one-task window.

The table is laid out in ranges of the sort key, each range is numbered on its own, and the
totals of the ranges before it are added. The layout is written to the shared folder first:
range bounds come from a sample and may differ from one execution to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import col, freeze

PART, POS = "__part", "__pos"
# monotonically_increasing_id keeps the row's position within its partition in its low 33 bits.
POSITION_MASK = (1 << 33) - 1

Order = Sequence[str | Column]


def _columns(order: Order) -> list[Column]:
    return [col(o) if isinstance(o, str) else o for o in order]


def _ranges(df: DataFrame, order: Order) -> DataFrame:
    keys = _columns(order)
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def with_row_index(
    df: DataFrame, order: Order | None = None, name: str = "row_index"
) -> DataFrame:
    """Add a gapless index from 0.

    ``order`` should end in a unique key, so that equal keys cannot pile up in one range.
    Without ``order`` the rows are numbered as they lie and nothing is shuffled.
    """
    laid = df if order is None else _ranges(df, order)
    frozen = freeze(
        laid.select(
            "*",
            F.spark_partition_id().alias(PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)).alias(POS),
        )
    )
    # One row per partition: small whatever the table holds, so the window and broadcast are.
    size = F.col("size")
    offsets = (
        frozen.groupBy(PART)
        .agg(F.count("*").alias("size"))
        .select(PART, (F.sum(size).over(Window.orderBy(PART)) - size).alias("offset"))
    )
    return frozen.join(F.broadcast(offsets), PART).select(
        *[col(c) for c in df.columns], (F.col("offset") + F.col(POS)).alias(name)
    )


def with_rank(df: DataFrame, by: Sequence[str], order: Order, name: str = "rank") -> DataFrame:
    """Add the position from 0 within each group; a group may be larger than a task."""
    indexed = with_row_index(df, [*by, *order], "__index")
    starts = indexed.groupBy(*[col(b) for b in by]).agg(F.min("__index").alias("__start"))
    return indexed.join(starts, list(by)).select(
        *[col(c) for c in df.columns], (F.col("__index") - F.col("__start")).alias(name)
    )


def with_running_totals(
    df: DataFrame, by: Sequence[str], order: Order, totals: dict[str, Column]
) -> DataFrame:
    """Add running sums over ``order`` within each group, the current row included.

    ``order`` must be unique within a group.
    """
    laid = _ranges(df.select("*", *[v.alias(f"__v_{k}") for k, v in totals.items()]), [*by, *order])
    frozen = freeze(laid.select("*", F.spark_partition_id().alias(PART)))
    keys = [col(b) for b in by]
    partial = frozen.groupBy(PART, *keys).agg(
        *[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in totals]
    )
    # One row per range and group met in it; by group the ranges in order.
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = partial.select(
        PART, *keys, *[F.sum(f"__t_{k}").over(before).alias(f"__o_{k}") for k in totals]
    )
    inside = (
        Window.partitionBy(F.col(PART), *keys)
        .orderBy(*_columns(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        frozen.select(
            PART,
            *[col(c) for c in df.columns],
            *[F.sum(f"__v_{k}").over(inside).alias(f"__r_{k}") for k in totals],
        )
        .join(offsets, [PART, *by])
        .select(
            *[col(c) for c in df.columns],
            *[
                (F.col(f"__r_{k}") + F.coalesce(F.col(f"__o_{k}"), F.lit(0))).alias(k)
                for k in totals
            ],
        )
    )
