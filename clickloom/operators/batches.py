"""Shards and batches: contiguous row ranges per worker, fixed-size chunks, files as batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordering import with_row_index
from clickloom.operators.permutation import permuted


def shard_rows(df: DataFrame, workers: int, index: str = "row_index") -> DataFrame:
    """Add ``worker`` and ``worker_row`` to rows numbered by ``with_row_index``.

    Worker w gets rows [w*p, min((w+1)*p, N)) with p = ceil(N / workers). N is read from the
    index column of the written table.
    """
    last = df.agg(F.max(index)).first()[0]
    share = 1 if last is None else -(-(last + 1) // workers)
    return df.select(
        *df.columns,
        F.expr(f"int(`{index}` div {share})").alias("worker"),
        (F.col(index) % F.lit(share)).alias("worker_row"),
    )


def batch_rows(df: DataFrame, chunk: int) -> DataFrame:
    """Add ``batch``: chunks of ``chunk`` rows within each worker, the last one short."""
    return df.select(*df.columns, F.expr(f"worker_row div {int(chunk)}").alias("batch"))


def batch_sizes(df: DataFrame) -> DataFrame:
    """(worker, batch, rows)."""
    return df.groupBy("worker", "batch").agg(F.count("*").alias("rows"))


def batch_plan(df: DataFrame, workers: int, chunk: int) -> DataFrame:
    """Batches per worker and in total: the plan from the row count, and the exact count.

    The plan gives every worker as many batches as the first one has; ``batches`` counts those
    that hold rows. ``df`` carries ``worker`` and ``worker_row``.
    """
    per_worker = F.ceil(F.ceil(F.sum("rows") / workers) / chunk)
    return (
        df.groupBy("worker")
        .agg(F.count("*").alias("rows"), F.max(F.expr(f"worker_row div {int(chunk)}") + 1).alias("batches"))
        .agg(
            F.sum("rows").alias("rows"),
            per_worker.alias("per_worker"),
            (per_worker * workers).alias("total"),
            F.sum("batches").alias("batches"),
        )
    )


def shuffle_batches(plan: DataFrame, epochs: int, seed: int = 42) -> DataFrame:
    """(epoch, worker, batch, rows, position): a new order of all batches for each epoch.

    ``plan`` has a row for each batch of each worker, numbered from 0; only the last workers may
    have fewer. A position is computed from the batch's number, so nothing is shuffled.
    """
    per, total, last = plan.agg(
        F.max("batch") + 1, F.count("*"), F.max(F.struct("worker", "batch"))
    ).first()
    if total and (last.worker * per + last.batch + 1 != total):
        raise ValueError("the numbers of the batches have a gap")
    number = F.col("worker") * F.lit(per or 0) + F.col("batch")
    each = plan.select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "*")
    return each.withColumn("position", permuted(number, total, seed, F.col("epoch")))


def file_batches(df: DataFrame) -> DataFrame:
    """Add ``batch``: the number, from 0, of the file a row was read from, in name order.

    ``df`` is read straight from files.
    """
    located = df.select("*", F.col("_metadata.file_path").alias("file"))
    files = with_row_index(located.select("file").distinct(), ["file"], "batch")
    # One row per file, joined without a hint so that Spark weighs the number of files.
    return located.join(files, "file")
