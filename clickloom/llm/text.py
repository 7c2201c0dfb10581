"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.session import col, ship_package

#: Rows that a task turns into Python objects at a time.
SLICE = 512

#: The bytes that separate words.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_slice(
    df: DataFrame, names: list[str], make: Callable[[], Callable], schema: str
) -> DataFrame:
    """One Arrow pass over columns ``names``: ``make()`` gives, once per task, the function that
    turns a list of column value lists into a list of result columns."""
    ship_package(df.sparkSession)
    fields = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, arrow = make(), to_arrow_schema(fields)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = step(*[c.to_pylist() for c in part.columns])
                arrays = [
                    pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, arrow)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*[col(n) for n in names]).mapInArrow(run, fields)


def filter_rows(docs: DataFrame, name: str, make: Callable[[], Callable]) -> DataFrame:
    """The rows of ``docs``, all columns, for which the function that ``make()`` gives says True
    on a list of values of column ``name``. No join and no shuffle."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                yield part.filter(pa.array(step(part.column(at).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, target: str, per_class: int, held_out: bool = True
) -> DataFrame:
    """(text, y) of at most ``per_class`` labelled documents of each class.

    The choice is the smallest hashes of doc_id, so it does not depend on file order. With
    ``held_out`` rows whose crc32(doc_id as text) mod 5 is 0 are left out. A document labelled
    twice takes its lower label; other labels than 0 and 1 are ignored. The ids are at most
    2 * per_class and therefore broadcast; only their texts are shuffled.
    """
    key = F.col("doc_id").cast("string")
    rows = (
        labels.select("doc_id", col(target).alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("y").alias("y"))
    )
    if held_out:
        rows = rows.where(F.crc32(key) % 5 != 0)
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    picked = None
    for y in (0, 1):
        part = rows.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    return documents.select("doc_id", "text").join(
        F.broadcast(picked.drop("h")), "doc_id"
    )


def fit_in_one_task(sample: DataFrame, train: Callable, columns: list[str]) -> bytes:
    """The bytes that ``train`` makes of a bounded sample, in one task of the cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), schema) if (batches := list(batches)) else None
        lists = [rows.column(i).to_pylist() for i in range(len(columns))] if rows else [[]] * len(columns)
        yield pa.RecordBatch.from_arrays([pa.array([train(*lists)], pa.binary())], names=["model"])

    ship_package(sample.sparkSession)
    picked = sample.select(*[col(c) for c in columns])
    schema = to_arrow_schema(picked.schema)
    made = picked.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(made[0].model) if made else train(*[[]] * len(columns))


def shipped(spark: SparkSession, payload: bytes):
    """A broadcast of a model; its size is a parameter's, not the data's."""
    return spark.sparkContext.broadcast(payload)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes spread by multiplication and shifts."""
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
