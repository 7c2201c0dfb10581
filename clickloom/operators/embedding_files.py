"""Embeddings with their Adam moments as files in the shared folder, where tasks can open them.

A file holds a range of the rows of a tensor: values, m and v of each, 32-bit floats. A worker reads
only the rows that it touches and writes its changes to files of its own; a task for each range adds
them up and writes the range anew. Nothing is shuffled. Every file has a name of its own, so that a
repeated task does not disturb another, and tasks report the names. It does the same as
``EmbeddingTable``, which asks nothing of the folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.embedding_table import DRAWN, Coasting, averaged_rows, drawn_rows, row_blocks
from clickloom.operators.encode import Deep
from clickloom.operators.network import embedding, list_array
from clickloom.session import delete_folder, ship_package
from clickloom.sources.features_io import PARAMETER_SCHEMA

# Bytes of a range.
RANGE_BYTES = 16 << 20


@dataclass(frozen=True)
class Range:
    """Rows ``first`` to ``end`` of a tensor."""

    tensor: str
    first: int
    end: int
    dim: int
    file: str = ""

    def read(self, rows: np.ndarray | None = None) -> np.ndarray:
        """States of some rows, or of all of them."""
        if rows is None:
            return np.fromfile(self.file, np.float32).reshape(-1, 3 * self.dim)
        return np.memmap(self.file, np.float32, "r", shape=(self.end - self.first, 3 * self.dim))[rows - self.first]


def range_rows(dim: int) -> int:
    """Rows of a range: whole blocks of rows that are drawn together."""
    return max(1, RANGE_BYTES // (12 * dim) // DRAWN) * DRAWN


def new_file(folder: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Changes:
    """What a worker changed: files (rows, changes of their states) by tensor, its rows and steps."""

    files: str
    n: int
    steps: int

    def write(self, tensor: int, rows: np.ndarray, change: np.ndarray) -> None:
        """``rows`` in rising order."""
        rows.astype(np.int32).tofile(f"{self.files}.{tensor}.rows")
        change.tofile(f"{self.files}.{tensor}.changes")

    def read(self, tensor: int, first: int, end: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, changes) of the rows from ``first`` to ``end``."""
        name = f"{self.files}.{tensor}"
        if not os.path.getsize(f"{name}.rows"):
            return np.zeros(0, np.int32), np.zeros((0, 3 * dim), np.float32)
        rows = np.memmap(f"{name}.rows", np.int32, "r")
        a, b = np.searchsorted(rows, [first, end])
        if a == b:
            return np.zeros(0, np.int32), np.zeros((0, 3 * dim), np.float32)
        whole = np.memmap(f"{name}.changes", np.float32, "r", shape=(len(rows), 3 * dim))
        return np.array(rows[a:b]), whole[a:b]


class EmbeddingFiles:
    """The ranges of all embeddings in one folder; each round makes a new one."""

    def __init__(self, spark: SparkSession, folder: str, spec: Sequence[Deep], ranges: list[Range]):
        self.spark, self.folder, self.spec, self.ranges = spark, folder, spec, ranges

    @classmethod
    def drawn(cls, spark: SparkSession, folder: str, spec: Sequence[Deep], seed: int) -> EmbeddingFiles:
        ranges = [
            Range(embedding(d.name), first, min(first + range_rows(d.dim), d.vocab), d.dim)
            for d in spec for first in range(0, d.vocab, range_rows(d.dim))
        ]

        def make(r: Range) -> np.ndarray:
            blocks = range(r.first // DRAWN, -(-r.end // DRAWN))
            values = np.concatenate([drawn_rows(seed, r.tensor, b, r.dim) for b in blocks])[: r.end - r.first]
            return np.concatenate([values, np.zeros((len(values), 2 * r.dim), np.float32)], axis=1)

        return cls._made(spark, folder, spec, ranges, make)

    @classmethod
    def _made(cls, spark, folder: str, spec, ranges: list[Range], make) -> EmbeddingFiles:
        """A task for each range writes what ``make`` gives for it."""
        ship_package(spark)
        os.makedirs(folder, exist_ok=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    file = new_file(folder)
                    make(ranges[i]).tofile(file)
                    yield pa.RecordBatch.from_pydict({"id": [i], "file": [file]})

        tasks = spark.range(0, len(ranges), 1, max(1, len(ranges)))
        files = {r.id: r.file for r in tasks.mapInArrow(run, "id bigint, file string").collect()}
        made = [Range(r.tensor, r.first, r.end, r.dim, files[i]) for i, r in enumerate(ranges)]
        return cls(spark, folder, spec, made)

    def moved(
        self, folder: str, changes: Sequence[Changes], steps: int, lr: float
    ) -> EmbeddingFiles:
        """The files after a round in which every worker of ``changes`` went on from step ``steps``.

        The changes are averaged by the rows of the workers. A worker that did not meet a row moved
        it by its moments alone.
        """
        counts = sorted({c.steps for c in changes})
        all_rows = np.array([float(sum(c.n for c in changes if c.steps == k)) for k in counts])
        plans = [Coasting(steps, lr, k) for k in counts]
        place = {embedding(d.name): i for i, d in enumerate(self.spec)}

        def make(r: Range) -> np.ndarray:
            state, met = r.read(), [c.read(place[r.tensor], r.first, r.end, r.dim) for c in changes]
            for block in row_blocks(len(state), 3 * r.dim):
                old = state[block]
                change, left = np.zeros(old.shape), np.tile(all_rows, (len(old), 1))
                for c, (rows, values) in zip(changes, met):
                    a, b = np.searchsorted(rows, [r.first + block.start, r.first + block.stop])
                    at = rows[a:b] - (r.first + block.start)
                    change[at] += values[a:b]
                    left[at, counts.index(c.steps)] -= c.n
                state[block] = averaged_rows(old, change, left, plans, all_rows.sum())
            return state

        return self._made(self.spark, folder, self.spec, self.ranges, make)

    def states(self, tensor: str, rows: np.ndarray) -> np.ndarray:
        """States of the rows, which rise, of a tensor."""
        mine = [r for r in self.ranges if r.tensor == tensor]
        ends = np.searchsorted(rows, [r.first for r in mine] + [mine[-1].end if mine else 0])
        found = [r.read(rows[a:b]) for r, a, b in zip(mine, ends[:-1], ends[1:]) if a < b]
        dim = next(d.dim for d in self.spec if embedding(d.name) == tensor)
        return np.concatenate(found) if found else np.zeros((0, 3 * dim), np.float32)

    def values(self) -> DataFrame:
        """(tensor, row, values)"""
        ranges = self.ranges

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    r = ranges[i]
                    rows = pa.array(np.arange(r.first, r.end, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.tensor] * len(rows)), rows, list_array(r.read()[:, : r.dim])],
                        names=["tensor", "row", "values"],
                    )

        return self.spark.range(0, len(ranges), 1, max(1, len(ranges))).mapInArrow(run, PARAMETER_SCHEMA)

    def drop(self) -> None:
        delete_folder(self.spark, self.folder)

    def __getstate__(self):
        """What tasks need."""
        return self.__dict__ | {"spark": None}
