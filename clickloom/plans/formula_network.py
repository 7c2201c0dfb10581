"""A network of the published widths whose weights follow a formula that SQL can repeat.

Weights are halves, so all sums are exact. A unit reads READS inputs only. The network is two
equal halves side by side, each embedding's too: with output weights that are opposite in the
halves every logit is 0, and all gradients are exact as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.encode import Deep
from clickloom.operators.network import HIDDEN, Params, embedding, list_array, parameter_table
from clickloom.sources.features_io import PARAMETER_SCHEMA

# Inputs of a unit, and the steps from one to the next.
READS, STRIDE = 4, 37
# Weights of a row that is told as one number.
CYCLE = 5
# Rows of an embedding that are made at once.
MADE = 1024


def halves(spec: list[Deep]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first halves of all embeddings side by side, and of their counterparts."""
    first, second, start = [], [], 0
    for d in spec:
        half = d.dim // 2
        first.append(np.arange(start, start + half))
        second.append(np.arange(start + half, start + d.dim))
        start += d.dim
    return np.concatenate(first), np.concatenate(second)


def formula_rows(t: int, d: Deep, first: int, n: int) -> np.ndarray:
    """``n`` rows of the embedding of deep column number ``t``."""
    row, column = np.arange(first, first + n)[:, None], np.arange(d.dim)[None, :] % (d.dim // 2)
    return ((row * 7 + column * 3 + t) % 5 - 2).astype(np.float32) / np.float32(2)


def formula_parameters(
    spec: list[Deep], wide_dim: int, balanced: bool = False, embeddings: bool = True,
) -> Params:
    """The weights; ``balanced`` makes all logits 0."""
    params = {}
    if embeddings:
        params = {embedding(d.name): formula_rows(t, d, 0, d.vocab) for t, d in enumerate(spec)}
    inputs, sides = sum(d.dim for d in spec), halves(spec)
    for k, width in enumerate(HIDDEN, 1):
        weight, unit = np.zeros((width, inputs), np.float32), np.arange(width // 2)
        for j in range(READS):
            read = (unit * 5 + j * STRIDE) % (inputs // 2)
            value = ((unit * 3 + j * 5 + k) % 5 - 2) / 2
            for side in (0, 1):
                weight[unit + side * (width // 2), sides[side][read]] = value
        params[f"dense_{k}.weight"] = weight
        params[f"dense_{k}.bias"] = (((np.arange(width) % (width // 2) + k) % 3 - 1)[None, :] / 2).astype(np.float32)
        inputs, sides = width, (np.arange(width // 2), np.arange(width // 2, width))
    slot, unit = np.arange(wide_dim), np.arange(inputs)
    if balanced:
        top = ((unit % (inputs // 2)) % 3 - 1) / 2 * np.where(unit < inputs // 2, 1, -1)
        wide = np.zeros(wide_dim)
    else:
        top, wide = ((unit * 5) % 9 - 4) / 64, ((slot * 5) % 9 - 4) / 8
    params["out.weight"] = np.concatenate([wide, top])[None, :].astype(np.float32)
    params["out.bias"] = np.array([[0 if balanced else 0.125]], np.float32)
    return params


def formula_table(spark: SparkSession, spec: list[Deep], wide_dim: int, balanced: bool = False) -> DataFrame:
    """The weights as a table; embeddings are made where they lie."""
    starts = np.cumsum([0, *[-(-d.vocab // MADE) for d in spec]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                t = int(np.searchsorted(starts, at, side="right")) - 1
                first = (at - int(starts[t])) * MADE
                n = min(MADE, spec[t].vocab - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([embedding(spec[t].name)] * n), pa.array(np.arange(first, first + n, dtype=np.int32)),
                     list_array(formula_rows(t, spec[t], first, n))],
                    names=["tensor", "row", "values"],
                )

    made = spark.range(int(starts[-1])).mapInArrow(run, PARAMETER_SCHEMA)
    return made.unionByName(parameter_table(spark, formula_parameters(spec, wide_dim, balanced, False)))
