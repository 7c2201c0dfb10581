"""The wide-and-deep network as Spark operators.

Parameters are a table (tensor, row, values): ``emb:<column>`` with one row per index,
``dense_<k>.weight`` and ``dense_<k>.bias`` with one row per output unit resp. one row, and
``out.weight`` / ``out.bias``. The dense tensors have a size set by the column choice and the
layer widths. The embedding tables grow with the vocabularies, so their size is checked before
they are broadcast; beyond the bound they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.scalar import sigmoid
from clickloom.operators.encode import Deep
from clickloom.operators.lookup import long_lookup, rank_lookup
from clickloom.session import col
from clickloom.sources.features_io import PARAMETER_SCHEMA

# Widths of the dense layers.
HIDDEN = (512, 256, 128)
# Embedding bytes that may be sent to every executor.
BROADCAST_BYTES = 256 * 1024 * 1024
# Rows that a Python worker takes through the network at once.
CHUNK_ROWS = 2048

Params = dict[str, np.ndarray]


def embedding(name: str) -> str:
    return f"emb:{name}"


def embedding_bytes(spec: Sequence[Deep]) -> int:
    return sum(d.vocab * d.dim * 4 for d in spec)


def init_parameters(
    spec: Sequence[Deep], wide_dim: int, hidden: Sequence[int] = HIDDEN, seed: int = 42,
    embeddings: bool = True,
) -> Params:
    """Normal embeddings; dense weights uniform within 1/sqrt(inputs)."""
    rng = np.random.default_rng(seed)
    params: Params = {}
    if embeddings:
        for d in spec:
            params[embedding(d.name)] = rng.standard_normal((d.vocab, d.dim), dtype=np.float32)

    def linear(name: str, inputs: int, outputs: int) -> None:
        bound = 1 / np.sqrt(inputs)
        params[f"{name}.weight"] = rng.uniform(-bound, bound, (outputs, inputs)).astype(np.float32)
        params[f"{name}.bias"] = rng.uniform(-bound, bound, (1, outputs)).astype(np.float32)

    inputs = sum(d.dim for d in spec)
    for k, width in enumerate(hidden, 1):
        linear(f"dense_{k}", inputs, width)
        inputs = width
    linear("out", wide_dim + inputs, 1)
    return params


def parameter_table(spark: SparkSession, params: Params) -> DataFrame:
    """The parameters as a DataFrame; for tensors the driver holds anyway."""
    tables = []
    for name, values in params.items():
        n, width = values.shape
        tables.append(
            pa.table(
                {
                    "tensor": pa.array([name] * n, pa.string()),
                    "row": pa.array(np.arange(n, dtype=np.int32)),
                    "values": list_array(values),
                }
            )
        )
    return spark.createDataFrame(pa.concat_tables(tables), PARAMETER_SCHEMA)


def list_array(values: np.ndarray) -> pa.ListArray:
    """A matrix as a list column of 32-bit floats."""
    n, width = values.shape
    flat = np.ascontiguousarray(values, dtype=np.float32).reshape(-1)
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def packed_array(values: np.ndarray) -> pa.BinaryArray:
    """The same as a binary column: a row is the bytes of its 32-bit floats, which Spark moves as a
    whole and not value by value."""
    n, width = values.shape
    flat = np.ascontiguousarray(values, dtype=np.float32).reshape(-1)
    offsets = np.arange(n + 1, dtype=np.int64) * 4 * width
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError(f"{offsets[-1]} bytes do not fit one binary column")
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def matrix(column: pa.ListArray | pa.BinaryArray) -> np.ndarray:
    """A list column of equal lengths, or a packed one, as a matrix."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1] if len(column) else [0, 0]
        flat = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].view(np.float32)
    else:
        flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def collect_parameters(params: DataFrame | Params, max_bytes: int = BROADCAST_BYTES) -> Params:
    """Bring a parameter table to the driver after checking its size."""
    if isinstance(params, dict):
        return params
    size = params.agg(F.sum(F.size("values")) * 4).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{size} bytes of parameters exceed the bound of {max_bytes}")
    table = params.orderBy("tensor", "row").toArrow()
    names = table.column("tensor").to_numpy()
    found: Params = {}
    starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else []
    for start, end in zip(starts, np.r_[starts[1:], len(names)] if len(names) else []):
        rows = table.slice(start, end - start)
        index = rows.column("row").to_numpy()
        if index[-1] != len(index) - 1:
            raise ValueError(f"rows of {names[start]} are not 0..{len(index) - 1}")
        found[names[start]] = matrix(rows.column("values").combine_chunks())
    return found


def _is_embedding() -> Column:
    return F.col("tensor").startswith("emb:")


def layers(params: Params) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weight, bias) of the hidden layers in order."""
    found, k = [], 1
    while f"dense_{k}.weight" in params:
        found.append((params[f"dense_{k}.weight"], params[f"dense_{k}.bias"][0]))
        k += 1
    return found


def tower(params: Params, x: np.ndarray) -> list[np.ndarray]:
    """The input and the activations of every hidden layer."""
    outs = [x]
    for weight, bias in layers(params):
        outs.append(np.maximum(outs[-1] @ weight.T + bias, 0))
    return outs


def gather(params: Params, names: Sequence[str], deep: np.ndarray) -> np.ndarray:
    """Embedding rows side by side in column order."""
    return np.concatenate(
        [params[embedding(n)][deep[:, i]] for i, n in enumerate(names)], axis=1
    )


def slot_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every active slot."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    return rows, column.flatten().to_numpy(zero_copy_only=False)


def head(params: Params, rows: np.ndarray, slots: np.ndarray, scale, top: np.ndarray) -> np.ndarray:
    """Logits from active wide slots (each counted ``scale``) and the top activations."""
    weight = params["out.weight"][0]
    width = len(weight) - top.shape[1]
    wide = np.bincount(rows, weights=weight[slots] * scale, minlength=len(top))
    return wide + top @ weight[width:] + params["out.bias"][0, 0]


def embedding_lookup(
    df: DataFrame, params: DataFrame, spec: Sequence[Deep], max_bytes: int = BROADCAST_BYTES,
    name: str = "embedded",
) -> DataFrame:
    """Add the concatenated embedding rows of ``deep`` by joins to the parameter table.

    Tables within an even share of ``max_bytes`` are broadcast; the others are looked up together.
    """
    tables = params.where(_is_embedding())
    share = max_bytes // max(1, len(spec))
    kept, large = [col(c) for c in df.columns], {}
    for i, d in enumerate(spec):
        if d.vocab * d.dim * 4 > share:
            large[f"__e{i}"] = F.col("deep")[i]
    out = df
    if large:
        tensors = F.array(*[F.lit(embedding(spec[int(n[3:])].name)) for n in large])
        at = F.array_position(tensors, F.col("tensor"))
        entries = tables.where(at > 0).select(
            F.array(*map(F.lit, large))[(at - 1).cast("int")].alias("name"), F.col("row").alias("key"),
            F.col("values").alias("value"),
        )
        out = long_lookup(df, large, entries, 4 * max(d.dim for d in spec), max_bytes)
    for i, d in enumerate(spec):
        if f"__e{i}" not in large:
            table = tables.where(F.col("tensor") == embedding(d.name)).select("row", "values")
            out = rank_lookup(
                out, F.col("deep")[i], table, "row", "values", "row", d.vocab, d.vocab, f"__e{i}"
            )
    joined = F.concat(*[F.col(f"__e{i}") for i in range(len(spec))])
    return out.select(*kept, joined.alias(name))


def deep_tower(
    df: DataFrame, params: DataFrame, embedded: str = "embedded", name: str = "tower"
) -> DataFrame:
    """Add the activations of the last hidden layer for an array column of embeddings."""
    dense = collect_parameters(params.where(~_is_embedding()))
    shared = df.sparkSession.sparkContext.broadcast(dense)

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def run(x: pa.Array) -> pa.Array:
        return list_array(tower(shared.value, matrix(x).astype(np.float32))[-1])

    return df.withColumn(name, run(col(embedded)))


def logit(df: DataFrame, params: DataFrame, top: str = "tower") -> DataFrame:
    """Add ``logit`` from ``slots`` and the top activations."""
    dense = collect_parameters(params.where(F.col("tensor").startswith("out.")))
    shared = df.sparkSession.sparkContext.broadcast(dense)

    @F.arrow_udf(T.DoubleType())
    def run(slots: pa.Array, top: pa.Array) -> pa.Array:
        rows, active = slot_lists(slots)
        return pa.array(head(shared.value, rows, active, 1.0, matrix(top)).astype(np.float64))

    return df.withColumn("logit", run(F.col("slots"), col(top)))


def score_table(
    df: DataFrame, params: DataFrame | Params, spec: Sequence[Deep],
    keep: Sequence[str] = ("id", "label"),
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keep, logit, probability) of every row.

    With embeddings within ``max_bytes`` this is one pass over Arrow batches without join or
    shuffle. Larger tables are joined column by column.
    """
    if embedding_bytes(spec) > max_bytes:
        if isinstance(params, dict):
            params = parameter_table(df.sparkSession, params)
        embedded = embedding_lookup(df, params, spec, max_bytes)
        scored = logit(deep_tower(embedded, params), params)
    else:
        names = [d.name for d in spec]
        shared = df.sparkSession.sparkContext.broadcast(
            collect_parameters(params, max_bytes + BROADCAST_BYTES)
        )

        @F.arrow_udf(T.DoubleType())
        def run(slots: pa.Array, deep: pa.Array) -> pa.Array:
            p, found = shared.value, np.empty(len(deep))
            for start in range(0, len(deep), CHUNK_ROWS):
                top = tower(p, gather(p, names, matrix(deep.slice(start, CHUNK_ROWS))))[-1]
                rows, active = slot_lists(slots.slice(start, CHUNK_ROWS))
                found[start : start + CHUNK_ROWS] = head(p, rows, active, 1.0, top)
            return pa.array(found)

        scored = df.withColumn("logit", run(F.col("slots"), F.col("deep")))
    return scored.select(
        *[col(c) for c in keep], "logit", sigmoid(F.col("logit")).alias("probability")
    )
