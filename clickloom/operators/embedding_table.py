"""Embeddings with their Adam moments as a table that is never held by one machine.

The table is written in buckets by (tensor, row). Whatever is joined to it goes to the buckets;
the table itself is not shuffled, neither to look up the rows that a round touches nor to write
them back. Values and moments of a row are the bytes of one vector: Spark moves them as a whole,
and only Python looks inside.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.encode import Deep
from clickloom.operators.network import embedding, embedding_bytes, list_array, matrix, packed_array
from clickloom.session import discard, scratch_dir, ship_package

# Adam's decay rates and divisor guard.
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8

# Rows that are drawn from one seed; bytes of a bucket.
DRAWN, BUCKET_BYTES = 1024, 64 << 20
# Values that are moved at once, so that they stay in a processor's cache.
BLOCK_VALUES = 1 << 15
# As written: rows of the table (``state``: values, m and v) and, apart from them, sums of what else
# a round sent, with the row count ``n``.
STORED_SCHEMA = "tensor string, row int, n double, state binary, kind string"
STATE, SUM = "state", "sum"
# Neglected share of the steps that are taken without any gradient.
COAST_ERROR = 1e-9


def drawn_rows(seed: int, tensor: str, block: int, dim: int) -> np.ndarray:
    """The first values of rows DRAWN * block and following: normal, the same wherever drawn."""
    rng = np.random.default_rng([seed, zlib.crc32(tensor.encode()), block])
    return rng.standard_normal((DRAWN, dim), dtype=np.float32)


def drawn_embeddings(spec: Sequence[Deep], seed: int) -> dict[str, np.ndarray]:
    """All first values at once, for embeddings that fit one machine."""
    made = {}
    for d in spec:
        t = embedding(d.name)
        blocks = [drawn_rows(seed, t, b, d.dim) for b in range(-(-d.vocab // DRAWN))]
        made[t] = np.concatenate([np.zeros((0, d.dim), np.float32), *blocks])[: d.vocab]
    return made


def stored(tensor: pa.Array, row: pa.Array, state: np.ndarray, n=None, kind: str = STATE) -> pa.RecordBatch:
    size = len(state)
    return pa.RecordBatch.from_arrays(
        [tensor, row, pa.nulls(size, pa.float64()) if n is None else pa.array(n), packed_array(state), pa.array([kind] * size, pa.string())],
        names=["tensor", "row", "n", "state", "kind"],
    )


def unpacked(df: DataFrame, names: Sequence[str] = ("values", "m", "v")) -> DataFrame:
    """(tensor, row, names) of rows (tensor, row, state), as arrays; what is not named of values, m
    and v is left out."""
    places = [("values", "m", "v").index(n) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tensors = batch.column("tensor").to_numpy(zero_copy_only=False)
            for tensor in sorted(set(tensors)):
                rows = batch.take(pa.array(np.flatnonzero(tensors == tensor)))
                thirds = np.split(matrix(rows.column("state")), 3, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("tensor"), rows.column("row"), *[list_array(thirds[i]) for i in places]],
                    names=["tensor", "row", *names],
                )

    fields = ", ".join(["tensor string, row int", *[f"{n} array<float>" for n in names]])
    return df.select("tensor", "row", "state").mapInArrow(run, fields)


def init_embeddings(spark: SparkSession, spec: Sequence[Deep], seed: int = 42) -> DataFrame:
    """(tensor, row, values, m, v): the same first values and zero moments, made where they lie."""
    return unpacked(drawn_states(spark, spec, seed))


def drawn_states(spark: SparkSession, spec: Sequence[Deep], seed: int) -> DataFrame:
    """The same as rows of ``STORED_SCHEMA``."""
    ship_package(spark)
    sizes = [(embedding(d.name), d.vocab, d.dim) for d in spec]
    starts = np.cumsum([0, *[-(-vocab // DRAWN) for _, vocab, _ in sizes]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column("id").to_pylist():
                k = int(np.searchsorted(starts, at, side="right")) - 1
                tensor, vocab, dim = sizes[k]
                first = (at - int(starts[k])) * DRAWN
                values = drawn_rows(seed, tensor, at - int(starts[k]), dim)[: vocab - first]
                n = len(values)
                state = np.zeros((n, 3 * dim), np.float32)
                state[:, :dim] = values
                yield stored(pa.array([tensor] * n), pa.array(np.arange(first, first + n, dtype=np.int32)), state)

    return spark.range(int(starts[-1])).mapInArrow(run, STORED_SCHEMA)


def adam_move(p, m, v, grad, rate: float, root: float):
    """One Adam step: the change of the values, and the new moments."""
    m = BETA1 * m + (1 - BETA1) * grad
    v = BETA2 * v + (1 - BETA2) * grad * grad
    return rate * m / (np.sqrt(v) / root + EPSILON), m, v


def row_blocks(n: int, width: int) -> list[slice]:
    """Ranges of the rows of a matrix that have about BLOCK_VALUES values each."""
    size = max(1, BLOCK_VALUES // max(1, width))
    return [slice(start, min(start + size, n)) for start in range(0, n, size)]


def rate_and_root(lr: float, step: int) -> tuple[float, float]:
    return lr / (1 - BETA1**step), (1 - BETA2**step) ** 0.5


class Coasting:
    """``count`` steps without any gradient, from step ``steps`` on, at once.

    Step j takes a_j * m / (b_j * sqrt(v) + EPSILON) from a value, of the moments before the first.
    The b_j are alike: their mean b is put in place of them and the sum is a polynomial in
    b * sqrt(v) / (b * sqrt(v) + EPSILON), which lies between 0 and 1. It has as many terms as leave
    no more than COAST_ERROR of the sum; where these would be no fewer than steps, the steps
    themselves are added up.
    """

    def __init__(self, steps: int, lr: float, count: int):
        self.decay = BETA1**count, BETA2**count
        met = [rate_and_root(lr, steps + j) for j in range(1, count + 1)]
        self.a = [rate * BETA1**j for j, (rate, _) in enumerate(met, 1)]
        self.b = [BETA2 ** (j / 2) / root for j, (_, root) in enumerate(met, 1)]
        total = sum(self.a)
        self.mean = sum(a * b for a, b in zip(self.a, self.b)) / total if total else 1.0
        off = [b / self.mean - 1 for b in self.b]
        far, self.terms = max(map(abs, off), default=0.0), None
        for n in range(1, count - 1):
            left = sum(a * abs(x) ** n for a, x in zip(self.a, off))
            if far < 1 and left <= COAST_ERROR * (1 - far) * total:
                self.terms = [sum(a * (-x) ** k for a, x in zip(self.a, off)) for k in range(n)]
                break

    def taken(self, m: np.ndarray, v: np.ndarray) -> np.ndarray:
        """What the steps take from the values."""
        root = np.sqrt(v)
        if self.terms is None:
            share = np.zeros_like(root)
            for a, b in zip(self.a, self.b):
                share += a / (b * root + EPSILON)
            return share * m
        root *= self.mean
        below = root + EPSILON
        root /= below
        share = np.full_like(root, self.terms[-1])
        for term in self.terms[-2::-1]:
            share *= root
            share += term
        share *= m
        share /= below
        return share

    def move(self, p: np.ndarray, m: np.ndarray, v: np.ndarray) -> None:
        p -= self.taken(m, v)
        m *= self.decay[0]
        v *= self.decay[1]


def coasted(
    p: np.ndarray, m: np.ndarray, v: np.ndarray, steps: int, lr: float, counts: Sequence[int]
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Changes of values and moments without any gradient after each of the rising ``counts`` of
    steps: moments go on moving a row that a worker does not meet."""
    out = [tuple(np.zeros_like(x) for x in (p, m, v)) for _ in counts]
    plans = [Coasting(steps, lr, count) for count in counts]
    # a row without moments stays where it is
    moving = np.flatnonzero(m.any(axis=1) | v.any(axis=1))
    for block in row_blocks(len(moving), p.shape[1]):
        rows = moving[block]
        some = m[rows], v[rows]
        for plan, (dp, dm, dv) in zip(plans, out):
            dp[rows] = -plan.taken(*some)
            dm[rows], dv[rows] = some[0] * (plan.decay[0] - 1), some[1] * (plan.decay[1] - 1)
    return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, sorted by tensor and row, in batches that do not part equal ones."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        row, tensor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "tensor"))
        ended = np.flatnonzero((row != row[-1]) | (tensor != tensor[-1]))
        cut = ended[-1] + 1 if len(ended) else 0
        if cut:
            yield batch.slice(0, cut)
        held = batch.slice(cut)
    if held is not None:
        yield held


def _added(first: np.ndarray, number: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``number`` rows of ``values`` from ``first`` on."""
    total = np.zeros((len(number), values.shape[1]))
    for k in range(number.max(initial=0)):
        at = np.flatnonzero(number > k)
        total[at] += values[first[at] + k]
    return total


def averaged_rows(
    old: np.ndarray, change: np.ndarray, left: np.ndarray, plans: Sequence[Coasting], total: float
) -> np.ndarray:
    """States after a round of ``total`` rows: ``change`` is the sum over the workers that met a row,
    ``left[:, k]`` the rows of the others, which moved it by its moments alone as ``plans[k]`` says."""
    dim = old.shape[1] // 3
    # a row without moments stays where it is
    moving = old[:, dim:].any()
    for k, plan in enumerate(plans):
        alone = np.flatnonzero(left[:, k]) if moving else ()
        if len(alone):
            some, share = old[alone], left[alone, k : k + 1].astype(np.float32)
            m, v = some[:, dim : 2 * dim], some[:, 2 * dim :]
            change[alone, :dim] -= plan.taken(m, v) * share
            change[alone, dim : 2 * dim] += m * (share * np.float32(plan.decay[0] - 1))
            change[alone, 2 * dim :] += v * (share * np.float32(plan.decay[1] - 1))
    change /= total
    return (old + change).astype(np.float32)


class EmbeddingTable:
    """Rows (tensor, row, values, m, v) in buckets; each round makes a new one."""

    def __init__(self, df: DataFrame, buckets: int, dealt: bool = False):
        self.spark, self.buckets = df.sparkSession, buckets
        self.name, self.path = f"clickloom_{uuid.uuid4().hex}", scratch_dir(df.sparkSession)
        rows = df if dealt else df.repartition(buckets, "tensor", "row")
        # bytes of floats neither repeat nor shrink
        plain = {"compression": "none", "parquet.enable.dictionary": "false", "path": self.path}
        writer = rows.write.partitionBy("kind").bucketBy(buckets, "tensor", "row").options(**plain)
        writer.format("parquet").saveAsTable(self.name)
        self.states = self.spark.table(self.name).where(F.col("kind") == STATE).select("tensor", "row", "state")
        self.states.frozen_path = self.path
        self.rows = unpacked(self.states)

    @classmethod
    def drawn(cls, spark: SparkSession, spec: Sequence[Deep], seed: int) -> EmbeddingTable:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(drawn_states(spark, spec, seed), max(least, -(-3 * embedding_bytes(spec) // BUCKET_BYTES)))

    def values(self) -> DataFrame:
        return unpacked(self.states, ["values"])

    def sums(self) -> DataFrame:
        """(tensor, row, n, values), packed: sums of the parts of ``moved`` that are no rows of the table."""
        found = self.spark.table(self.name).where(F.col("kind") == SUM)
        return found.select("tensor", "row", "n", F.col("state").alias("values"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.states)

    def touched(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (tensor, row, ...) with ``state``: values and moments, packed."""
        return keys.join(self.states.hint("merge"), ["tensor", "row"])

    def moved(self, sums: DataFrame, steps: int, lr: float, weights: dict[int, float]) -> EmbeddingTable:
        """The table after a round in which workers with ``weights[k]`` rows in all took k steps
        from step ``steps`` on.

        ``sums`` holds (tensor, row, values) of the rows met: the changes of values, m and v, times
        the rows of the worker, then the rows of the workers that met the row, for each k in rising
        order; summed, or some parts of the sum. Workers that did not meet a row moved it by its
        moments alone. What is no row of the table is added up (and ``n``, if there is one) and kept
        beside it for ``sums``.
        """
        counts = sorted(weights)
        all_rows = np.array([weights[k] for k in counts])
        total = all_rows.sum()
        plans = [Coasting(steps, lr, k) for k in counts]

        def moved_tensor(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Rows of one tensor: a row comes once for each of its parts, or once without any."""
            row, n = batch.column("row").to_numpy(), batch.column("n").fill_null(0.0).to_numpy()
            starts = np.flatnonzero(np.diff(row, prepend=row[0] - 1))
            parts = batch.column("g").is_valid().to_numpy(zero_copy_only=False)
            number = np.add.reduceat(parts.astype(np.int64), starts)
            first, values = np.cumsum(number) - number, matrix(batch.column("g").drop_null())
            once = batch.take(pa.array(starts))
            ours = once.column("state").is_valid().to_numpy(zero_copy_only=False)
            if ours.any():
                at = np.flatnonzero(ours)
                mine = once.take(pa.array(at))
                state = moved_rows(matrix(mine.column("state")), first[at], number[at], values)
                yield stored(mine.column("tensor"), mine.column("row"), state)
            if not ours.all():
                at = np.flatnonzero(~ours)
                other = once.take(pa.array(at))
                total = _added(first[at], number[at], values)
                yield stored(other.column("tensor"), other.column("row"), total, np.add.reduceat(n, starts)[at], SUM)

        def moved_rows(state: np.ndarray, first: np.ndarray, number: np.ndarray, values: np.ndarray) -> np.ndarray:
            dim, new = state.shape[1] // 3, np.empty_like(state)
            for block in row_blocks(len(state), state.shape[1]):
                old, change = state[block], np.zeros(state[block].shape)
                left = np.tile(all_rows, (len(old), 1))
                if number[block].any():
                    g = _added(first[block], number[block], values)
                    change += g[:, : 3 * dim]
                    left -= g[:, 3 * dim :]
                new[block] = averaged_rows(old, change, left, plans, total)
            return new

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _grouped(batches):
                tensors = batch.column("tensor").to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(tensors[1:] != tensors[:-1]) + 1
                for start, end in zip([0, *starts], [*starts, len(tensors)]):
                    yield from moved_tensor(batch.slice(start, end - start))

        sent = self.states.join(sums.hint("merge"), ["tensor", "row"], "full").sortWithinPartitions("tensor", "row")
        n = F.col("n") if "n" in sums.columns else F.lit(0.0).alias("n")
        sent = sent.select("tensor", "row", n, "state", F.col("values").alias("g"))
        return EmbeddingTable(sent.mapInArrow(run, STORED_SCHEMA), self.buckets, dealt=True)
