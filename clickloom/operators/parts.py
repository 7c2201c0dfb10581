"""Sums of tensors over tasks, as a tree of groups.

A task sends parts: rows of a tensor with what is to be added to them. Rows of a tensor fall into
blocks of bounded size, and a block is added up in one group, or first in lanes of tasks where
there are many tasks, so that no group reads more than about the square root of their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.network import list_array, matrix, packed_array

# Values of one tensor that are added up in one group.
BLOCK_VALUES = 1 << 18
# Blocks over which neighbouring rows are spread.
STRIDE = 16
# Tasks whose parts one group may read without lanes.
FEW_TASKS = 16
PART_SCHEMA = "tensor string, block int, row int, n double, values array<float>"
PACKED_SCHEMA = "tensor string, block int, row int, n double, values binary"


def block_rows(width: int) -> int:
    return max(1, BLOCK_VALUES // width)


def place(index: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, row within it) of rows of a tensor: neighbouring rows, which are alike frequent,
    fall to different blocks, and a block has at most ``block_rows`` rows."""
    over = block_rows(width) * STRIDE
    return index // over * STRIDE + index % STRIDE, index % over // STRIDE


def rows_of(block: int, inside: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``place``."""
    return block // STRIDE * (block_rows(width) * STRIDE) + inside * STRIDE + block % STRIDE


def part(tensor: str, index: np.ndarray, n: float, values: np.ndarray, array=list_array) -> pa.RecordBatch:
    """``array`` is ``list_array`` or ``packed_array``."""
    size = len(index)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([tensor] * size, pa.string()),
            pa.array(place(index, values.shape[1])[0].astype(np.int32)),
            pa.array(index.astype(np.int32)),
            pa.array(np.full(size, float(n))),
            array(values),
        ],
        names=["tensor", "block", "row", "n", "values"],
    )


def _sum_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the values of equal rows of one block; holds one block, however many parts come."""
    tensor, block, size, total, count, seen, array = None, 0, 0, None, None, None, list_array
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = matrix(batch.column("values"))
        if total is None:
            tensor, block = batch.column("tensor")[0].as_py(), batch.column("block")[0].as_py()
            array = list_array if pa.types.is_list(batch.column("values").type) else packed_array
            size = block_rows(values.shape[1])
            total = np.zeros((size, values.shape[1]))
            count, seen = np.zeros(size), np.zeros(size, dtype=bool)
        index = place(batch.column("row").to_numpy(), values.shape[1])[1]
        # equal rows of different parts are added up first, then each row once
        order = np.argsort(index, kind="stable")
        starts = np.flatnonzero(np.diff(index[order], prepend=-1))
        rows = index[order][starts]
        total[rows] += np.add.reduceat(values[order].astype(np.float64), starts, axis=0)
        count[rows] += np.add.reduceat(batch.column("n").to_numpy()[order], starts)
        seen[rows] = True
    if total is not None:
        kept = np.flatnonzero(seen)
        out = part(tensor, rows_of(block, kept, total.shape[1]), 0.0, total[kept], array)
        yield out.set_column(3, "n", pa.array(count[kept]))


def lanes(tasks: int) -> int:
    """Groups that share the parts of one block at first."""
    return 1 if tasks <= FEW_TASKS else math.ceil(math.sqrt(tasks))


def task_number(df: DataFrame) -> int:
    """Tasks that read ``df``, by a scan of no columns."""
    most = df.select(F.spark_partition_id().alias("task")).agg(F.max("task")).first()[0]
    return 0 if most is None else most + 1


def lane_sums(parts: DataFrame, tasks: int) -> DataFrame:
    """Parts, sent by about ``tasks`` tasks, added up in lanes: at most ``FEW_TASKS`` or the square
    root of ``tasks`` are left of each (tensor, row)."""
    if lanes(tasks) == 1:
        return parts
    lane = F.pmod(F.spark_partition_id(), F.lit(lanes(tasks)))
    return parts.withColumn("lane", lane).groupBy("tensor", "block", "lane").applyInArrow(
        _sum_block, parts.schema
    )


def sum_parts(parts: DataFrame, tasks: int) -> DataFrame:
    """Sum parts, sent by about ``tasks`` tasks, by (tensor, row)."""
    return lane_sums(parts, tasks).groupBy("tensor", "block").applyInArrow(_sum_block, parts.schema)
