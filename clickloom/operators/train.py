"""Training as Spark jobs: gradients, rounds of local Adam steps, history, tree baseline.

Rows stay on the executors. What travels is parameters, changes of parameters, and sums.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.embedding_files import Changes, EmbeddingFiles, new_file
from clickloom.operators.embedding_table import (
    Coasting, EmbeddingTable, adam_move, drawn_embeddings, rate_and_root, row_blocks,
)
from clickloom.operators.encode import Deep
from clickloom.operators.evaluate import log_loss
from clickloom.operators.lookup import HOT_ROWS
from clickloom.operators.network import (
    BROADCAST_BYTES, CHUNK_ROWS, HIDDEN, Params, collect_parameters, embedding, embedding_bytes,
    embedding_lookup, init_parameters, layers, matrix, packed_array, parameter_table, score_table,
    slot_lists, tower,
)
from clickloom.operators.parts import PACKED_SCHEMA, PART_SCHEMA, lane_sums, part, sum_parts, task_number
from clickloom.operators.permutation import permuted_number
from clickloom.session import col, delete_folder, freeze, local_table, opened_path, scratch_dir
from clickloom.sources.features_io import save_parameters

log = logging.getLogger(__name__)

# Batches of a worker between two averages, if ``rounds`` is not given.
ROUND_BATCHES = 16
# Bytes of embedding gradients of one tensor that a task adds up before it sends them.
HELD_BYTES = 32 << 20
# Rows to a different value from which on sums over them are a product with a 0/1 matrix.
ONE_HOT = 16
# Embedding rows whose changes a worker sends at once.
SENT_ROWS = 4096
# Losses of batches that the driver holds before it writes them.
LOSS_ROWS = 1 << 16
# Parts that are no tensors: the summed loss with the row count, the steps taken, and the same
# loss of each batch, by worker.
TOTAL, STEPS, LOSS = "total", "steps", "loss:"
# The name of a worker's files, with its rows and steps.
FILES = "files:"
LOSS_SCHEMA = "epoch int, round int, worker int, batch int, rows bigint, loss double"


@dataclass
class Gradient:
    """Sums over the rows of a batch: dense gradients, embedding gradients by row, loss."""

    dense: Params
    sparse: dict[str, tuple[np.ndarray, np.ndarray]]
    loss: float
    rows: int


class _Met:
    """The different values of an index column, and sums over the rows that have each of them."""

    def __init__(self, column: np.ndarray):
        self.order = np.argsort(column, kind="stable")
        ordered = column[self.order]
        self.starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        self.index, self.number = ordered[self.starts], np.diff(self.starts, append=len(column))
        # many rows to a value: worth working with the values
        self.few = 2 * len(self.index) <= len(column)

    def place(self) -> np.ndarray:
        """The place in ``index`` of each row's value."""
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.repeat(np.arange(len(self.index)), self.number)
        return place

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(self.index) * ONE_HOT <= len(self.order):
            chosen = np.zeros((len(self.index), len(self.order)), values.dtype)
            chosen[self.place(), np.arange(len(self.order))] = 1
            return chosen @ values
        if self.number.max() > ONE_HOT:
            return np.add.reduceat(values[self.order], self.starts, axis=0)
        total = values[self.order[self.starts]]
        for k in range(1, self.number.max()):
            at = np.flatnonzero(self.number > k)
            total[at] += values[self.order[self.starts[at] + k]]
        return total


def _add_at(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values summed by equal index."""
    met = _Met(index)
    return met.index, met.sums(values)


def backward(
    params: Params, embedded: np.ndarray, rows: np.ndarray, slots: np.ndarray, scale: float,
    label: np.ndarray,
) -> tuple[Params, np.ndarray, float]:
    """Dense gradients, the gradient of the embedded input, and the loss, summed over rows."""
    return _backward(params, tower(params, embedded), 0, rows, slots, scale, label)


def _backward(
    params: Params, outs: Sequence[np.ndarray], below: int, rows: np.ndarray, slots: np.ndarray,
    scale: float, label: np.ndarray,
) -> tuple[Params, np.ndarray, float]:
    """The same down to the activations of layer ``below``, ``outs`` being those from there on."""
    weight = params["out.weight"][0]
    width = len(weight) - outs[-1].shape[1]
    wide = np.bincount(rows, weights=weight[slots] * scale, minlength=len(label))
    x = wide + outs[-1] @ weight[width:] + params["out.bias"][0, 0]
    loss = float(np.sum(np.maximum(x, 0) - x * label + np.log1p(np.exp(-np.abs(x)))))
    # d loss / d logit is the probability minus the label.
    delta = np.exp(-np.logaddexp(0, -x)) - label
    grad_out = np.empty_like(params["out.weight"])
    grad_out[0, :width] = np.bincount(slots, weights=delta[rows] * scale, minlength=width)
    grad_out[0, width:] = delta @ outs[-1]
    grads: Params = {
        "out.weight": grad_out,
        "out.bias": np.array([[delta.sum()]], dtype=params["out.bias"].dtype),
    }
    back = np.outer(delta, weight[width:]).astype(outs[0].dtype)
    dense = layers(params)
    for k in range(len(dense), below, -1):
        back = back * (outs[k - below] > 0)
        grads[f"dense_{k}.weight"] = back.T @ outs[k - 1 - below]
        grads[f"dense_{k}.bias"] = back.sum(axis=0, keepdims=True)
        back = back @ dense[k - 1][0]
    return grads, back, loss


def gradient(
    params: Params, names: Sequence[str], deep: np.ndarray, rows: np.ndarray, slots: np.ndarray,
    scale: float, label: np.ndarray,
) -> Gradient:
    """Gradient sums of one batch over all parameters; embeddings by touched row.

    The first layer is taken column by column, each with the rows of its embedding that the batch
    meets: what they make of the layer's weights is worked out once for each of them, however many
    rows of the batch hold them, if these are at least twice as many.
    """
    dense = layers(params)
    if not dense:
        columns = [params[embedding(n)][deep[:, i]] for i, n in enumerate(names)]
        grads, back, loss = backward(params, np.concatenate(columns, axis=1), rows, slots, scale, label)
        ends = np.cumsum([c.shape[1] for c in columns])[:-1]
        sums = [_add_at(deep[:, i], b) for i, b in enumerate(np.split(back, ends, axis=1))]
        return Gradient(grads, dict(zip(map(embedding, names), sums)), loss, len(label))
    weight, bias = dense[0]
    met, start, first = [], 0, None
    for i, name in enumerate(names):
        table, of = params[embedding(name)], _Met(deep[:, i])
        inputs = table[of.index if of.few else deep[:, i]]
        at = slice(start, start := start + table.shape[1])
        share = inputs @ weight[:, at].T
        share = share[of.place()] if of.few else share
        first = share if first is None else np.add(first, share, out=first)
        met.append((embedding(name), at, of, inputs))
    first += bias
    outs = [np.maximum(first, 0, out=first)]
    for above, shift in dense[1:]:
        outs.append(np.maximum(outs[-1] @ above.T + shift, 0))
    grads, back, loss = _backward(params, outs, 1, rows, slots, scale, label)
    back = back * (outs[0] > 0)
    grads["dense_1.weight"] = np.empty_like(weight)
    grads["dense_1.bias"] = back.sum(axis=0, keepdims=True)
    sparse = {}
    for t, at, of, inputs in met:
        sums = of.sums(back) if of.few else back
        grads["dense_1.weight"][:, at] = sums.T @ inputs
        below = sums @ weight[:, at]
        sparse[t] = of.index, below if of.few else of.sums(below)
    return Gradient(grads, sparse, loss, len(label))


def _inputs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, slots = slot_lists(batch.column("slots"))
    label = batch.column("label").to_numpy().astype(np.float32)
    return matrix(batch.column("deep")), rows, slots, label


class _RowSums:
    """Sums by row of a tensor, held for at most HELD_BYTES of rows at a time."""

    def __init__(self, vocab: int, dim: int):
        self.place, self.used = np.full(vocab, -1, np.int32), np.zeros(0, np.int64)
        self.sums = np.zeros((min(vocab, max(CHUNK_ROWS, HELD_BYTES // (8 * dim))), dim))

    def add(self, index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Add to rows that are all different; what was held before, if there is no room."""
        full, new = None, index[self.place[index] < 0]
        if len(self.used) + len(new) > len(self.sums):
            full, new = self.taken(), index
        self.place[new] = len(self.used) + np.arange(len(new))
        self.used = np.r_[self.used, new]
        self.sums[self.place[index]] += values
        return full

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows, sums) held; nothing is held after."""
        out = self.used, self.sums[: len(self.used)].copy()
        self.place[self.used], self.sums[: len(self.used)], self.used = -1, 0, np.zeros(0, np.int64)
        return out


def batch_gradient(
    df: DataFrame, params: DataFrame, spec: Sequence[Deep], max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(tensor, row, values): gradient of the loss, summed over all rows.

    The row ``total`` holds the summed loss and the number of rows.
    Each task adds up its own rows and returns only the embedding rows it touched; where these are
    many, it sends them more than once and holds a bounded number of them.
    """
    if embedding_bytes(spec) > max_bytes:
        dense = collect_parameters(params.where(~F.col("tensor").startswith("emb:")))
        return distributed_gradient(df, dense, params, spec, max_bytes=max_bytes)
    names = [d.name for d in spec]
    shared = df.sparkSession.sparkContext.broadcast(
        collect_parameters(params, max_bytes + BROADCAST_BYTES)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        dense: Params = {}
        sparse = {embedding(n): _RowSums(*p[embedding(n)].shape) for n in names}
        n, loss = 0, 0.0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                deep, rows, slots, label = _inputs(batch.slice(start, CHUNK_ROWS))
                g = gradient(p, names, deep, rows, slots, 1.0, label)
                for t, v in g.dense.items():
                    dense[t] = dense.get(t, 0) + v.astype(np.float64)
                for t, (index, v) in g.sparse.items():
                    if (full := sparse[t].add(index, v)) is not None:
                        yield part(t, full[0], 0, full[1])
                n, loss = n + g.rows, loss + g.loss
        if n:
            for t, v in dense.items():
                yield part(t, np.arange(len(v)), n, v)
            for t, held in sparse.items():
                yield part(t, held.used, n, held.taken()[1])
            yield part(TOTAL, np.array([0]), n, np.array([[loss, n]]))

    narrow = df.select("slots", "deep", F.col("label").cast("double").alias("label"))
    parts = narrow.mapInArrow(run, PART_SCHEMA)
    return sum_parts(parts, task_number(narrow)).select("tensor", "row", "values")


class Adam:
    """Dense Adam over tensors; embedding rows that never had a gradient are passed over.

    Such a row has zero moments, so leaving it out changes nothing. A row that a batch does not meet
    moves by its moments alone; these steps are taken at once when it is met again (``ready``), or
    at the end (``finish``).
    """

    def __init__(self, params: Params, moments: Params, steps: int, lr: float):
        self.p, self.steps, self.lr = params, steps, lr
        self.m = {t: moments[f"m:{t}"] for t in params}
        self.v = {t: moments[f"v:{t}"] for t in params}
        self.active = {t: self.v[t].any(axis=1) for t in params if t.startswith("emb:")}
        # the step that a row was last taken to
        self.at = {t: np.full(len(active), steps) for t, active in self.active.items()}
        self.plans: dict[tuple[int, int], Coasting] = {}

    def step(self, g: Gradient) -> None:
        """One step; the rows that the gradient meets are ``ready``."""
        self.steps += 1
        rate, root = rate_and_root(self.lr, self.steps)
        for t, grad in g.dense.items():
            self._move(t, None, grad / g.rows, rate, root)
        for t, (index, grad) in g.sparse.items():
            self._move(t, index, grad / g.rows, rate, root)
            self.active[t][index], self.at[t][index] = True, self.steps

    def ready(self, t: str, index: np.ndarray) -> None:
        """Take the rows ``index``, all different, to the present step."""
        late = index[self.active[t][index] & (self.at[t][index] < self.steps)]
        since, p, m, v = self.at[t][late], self.p[t], self.m[t], self.v[t]
        for step in np.unique(since).tolist():
            rows = late[since == step]
            if (step, self.steps) not in self.plans:
                self.plans[step, self.steps] = Coasting(step, self.lr, self.steps - step)
            plan = self.plans[step, self.steps]
            for block in row_blocks(len(rows), p.shape[1]):
                at = rows[block]
                moved = p[at], m[at], v[at]
                plan.move(*moved)
                p[at], m[at], v[at] = moved
        self.at[t][late] = self.steps

    def finish(self) -> None:
        for t, active in self.active.items():
            self.ready(t, np.flatnonzero(active))

    def _move(self, t: str, at: np.ndarray | None, grad: np.ndarray, rate: float, root: float) -> None:
        """Move the rows ``at``, or all, in blocks that stay in a processor's cache."""
        p, m, v = self.p[t], self.m[t], self.v[t]
        for block in row_blocks(*grad.shape):
            rows = block if at is None or len(at) == len(p) else at[block]
            change, m[rows], v[rows] = adam_move(p[rows], m[rows], v[rows], grad[block], rate, root)
            p[rows] -= change


def _rebatch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``size``, the last one short."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        while rows >= size:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from table.slice(0, size).to_batches(max_chunksize=size)
            held, rows = table.slice(size).to_batches(), rows - size
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=size)


def _moments(params: Params) -> Params:
    return {f"{k}:{t}": np.zeros_like(v) for k in "mv" for t, v in params.items()}


def _local_steps(
    adam: Adam, names: Sequence[str], batches: Iterator[pa.RecordBatch], batch_size: int,
    dropout: float, seed: Sequence[int], worker: int, at_row=None,
) -> np.ndarray:
    """Steps of one worker over its rows in their order; (summed loss, rows) of each batch.

    ``at_row(i, rows)`` turns the rows of deep column ``i`` into places of the tensor held."""
    rng, told = np.random.default_rng([*seed, worker]), []
    for batch in _rebatch(batches, batch_size):
        deep, rows, slots, label = _inputs(batch)
        if at_row is not None:
            deep = np.stack([at_row(i, deep[:, i]) for i in range(deep.shape[1])], axis=1)
        if dropout:
            kept = rng.random(len(slots)) >= dropout
            rows, slots = rows[kept], slots[kept]
        for i, name in enumerate(names):
            adam.ready(embedding(name), np.unique(deep[:, i]))
        g = gradient(adam.p, names, deep, rows, slots, 1 / (1 - dropout), label)
        adam.step(g)
        told.append((g.loss, g.rows))
    adam.finish()
    return np.array(told).reshape(-1, 2)


def _told(told: np.ndarray, worker: int, part=part) -> Iterator[pa.RecordBatch]:
    """Parts of the losses and the steps of a worker."""
    n = told[:, 1].sum()
    yield part(TOTAL, np.array([0]), n, np.array([[told[:, 0].sum()]]))
    yield part(STEPS, np.array([0]), n, np.array([[len(told) * n]]))
    yield part(f"{LOSS}{worker}", np.arange(len(told)), 0, told)


def _changes(
    adam: Adam, old: Params, old_moments: Params, tensors, n: int, part=part
) -> Iterator[pa.RecordBatch]:
    """Changes times rows, of embeddings only for rows that ever moved."""
    for t in tensors:
        at = np.flatnonzero(adam.active[t]) if t in adam.active else np.arange(len(adam.p[t]))
        for name, new, before in (
            (t, adam.p[t], old[t]),
            (f"m:{t}", adam.m[t], old_moments[f"m:{t}"]),
            (f"v:{t}", adam.v[t], old_moments[f"v:{t}"]),
        ):
            yield part(name, at, n, (new[at] - before[at]) * np.float32(n))


def round_sums(
    df: DataFrame, params: Params, moments: Params, steps: int, spec: Sequence[Deep], lr: float,
    batch_size: int, dropout: float, seed: Sequence[int], workers: int,
) -> DataFrame:
    """Summed parts of a round in which every partition of ``df`` is a worker that takes Adam
    steps on its own rows in their order."""
    names = [d.name for d in spec]
    shared = df.sparkSession.sparkContext.broadcast((params, moments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, old_moments = shared.value
        copied = {t: v.copy() for t, v in old_moments.items()}
        adam = Adam({t: v.copy() for t, v in old.items()}, copied, steps, lr)
        worker = TaskContext.get().partitionId()
        told = _local_steps(adam, names, batches, batch_size, dropout, seed, worker)
        if len(told):
            yield from _changes(adam, old, old_moments, old, int(told[:, 1].sum()))
            yield from _told(told, worker)

    return sum_parts(df.mapInArrow(run, PART_SCHEMA), workers)


def table_round_parts(
    rows: DataFrame, table: EmbeddingTable, dense: Params, moments: Params, steps: int,
    spec: Sequence[Deep], lr: float, batch_size: int, dropout: float, seed: Sequence[int],
    workers: int, counts: Sequence[int],
) -> DataFrame:
    """The same round with embeddings that stay a table; its parts, which ``EmbeddingTable.moved``
    adds up.

    ``rows`` are staged rows of the round. Each worker gets the embedding rows that its own rows
    touch, with their moments, and takes the same steps as ``round_sums``. The parts of embedding
    rows are as ``EmbeddingTable.moved`` takes them; ``counts`` are the numbers of steps met.
    """
    names, columns = [d.name for d in spec], ["slots", "deep", "label", "turn", "order"]
    tensors, dims = [embedding(n) for n in names], [d.dim for d in spec]
    tensor = F.array(*map(F.lit, tensors))[F.col("pos")]
    keys = rows.select("worker", F.posexplode("deep").alias("pos", "row")).distinct()
    # Empty lists: Arrow's writer goes through a run of NULL ones again for each of them.
    none = [F.array().cast("array<int>").alias(c) for c in ("slots", "deep")]
    fetched = table.touched(keys.withColumn("tensor", tensor)).select("worker", "pos", "row", "state", *none)
    order = F.xxhash64("turn", *map(F.lit, seed))
    mine = rows.withColumn("order", order).select("worker", *columns)
    both = mine.unionByName(fetched, allowMissingColumns=True).repartitionById(workers, F.col("worker"))
    shared = rows.sparkSession.sparkContext.broadcast((dense, moments))
    packed = lambda *of: part(*of, array=packed_array)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, ours, index, states = None, [], [[] for _ in tensors], [[] for _ in tensors]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            worker = batch.column("worker")[0].as_py()
            pos = batch.column("pos").fill_null(-1).to_numpy(zero_copy_only=False)
            for i in np.unique(pos).tolist():
                some = batch.take(pa.array(np.flatnonzero(pos == i)))
                if i < 0:
                    ours.append(some.select(columns))
                else:
                    index[i].append(some.column("row").to_numpy())
                    states[i].append(matrix(some.column("state")))
        if worker is None or not ours:
            return
        adam_params, adam_moments = ({t: v.copy() for t, v in some.items()} for some in shared.value)
        held, order = [], []
        for i, t in enumerate(tensors):
            index[i] = np.concatenate([np.zeros(0, np.int32), *index[i]])
            state = np.concatenate([np.zeros((0, 3 * dims[i]), np.float32), *states[i]])
            states[i] = None
            held.append(state)
            order.append(np.argsort(index[i], kind="stable"))
            adam_params[t], adam_moments[f"m:{t}"], adam_moments[f"v:{t}"] = np.split(state, 3, axis=1)
        old = [state.copy() for state in held]
        adam = Adam(adam_params, adam_moments, steps, lr)
        ordered = pa.Table.from_batches(ours).sort_by([("order", "ascending"), ("turn", "ascending")])
        ranked = [at[o] for at, o in zip(index, order)]
        at_row = lambda i, at: order[i][np.searchsorted(ranked[i], at)]
        told = _local_steps(
            adam, names, iter(ordered.select(columns[:3]).to_batches()), batch_size, dropout, seed, worker,
            at_row,
        )
        n = int(told[:, 1].sum())
        yield from _changes(adam, *shared.value, list(shared.value[0]), n, packed)
        yield from _told(told, worker, packed)
        k = np.zeros((1, len(counts)), np.float32)
        k[0, list(counts).index(len(told))] = n
        for i, t in enumerate(tensors):
            for start in range(0, len(index[i]), SENT_ROWS):
                at = slice(start, start + SENT_ROWS)
                change = (held[i][at] - old[i][at]) * np.float32(n)
                yield packed(t, index[i][at], n, np.concatenate([change, np.repeat(k, len(change), 0)], axis=1))

    return lane_sums(both.mapInArrow(run, PACKED_SCHEMA), workers)


def file_round_sums(
    df: DataFrame, files: EmbeddingFiles, dense: Params, moments: Params, steps: int,
    spec: Sequence[Deep], lr: float, batch_size: int, dropout: float, seed: Sequence[int],
    workers: int, folder: str,
) -> DataFrame:
    """The same round with embeddings in files: every partition of ``df`` is a worker, as for
    ``round_sums``. It reads the rows that its own rows touch and writes their changes to
    ``folder``; its sums tell where."""
    names, tensors = [d.name for d in spec], [embedding(d.name) for d in spec]
    shared = df.sparkSession.sparkContext.broadcast((dense, moments))
    packed = lambda *of: part(*of, array=packed_array)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = [batch for batch in batches if batch.num_rows]
        if not mine:
            return
        params, held_moments = ({t: v.copy() for t, v in some.items()} for some in shared.value)
        index, old = [], []
        deep = np.concatenate([matrix(batch.column("deep")) for batch in mine])
        for i, t in enumerate(tensors):
            index.append(np.unique(deep[:, i]))
            old.append(files.states(t, index[i]))
            state = old[i].copy()
            params[t], held_moments[f"m:{t}"], held_moments[f"v:{t}"] = np.split(state, 3, axis=1)
        adam = Adam(params, held_moments, steps, lr)
        worker = TaskContext.get().partitionId()
        at_row = lambda i, at: np.searchsorted(index[i], at)
        told = _local_steps(adam, names, iter(mine), batch_size, dropout, seed, worker, at_row)
        n = int(told[:, 1].sum())
        changes = Changes(new_file(folder), n, len(told))
        for i, t in enumerate(tensors):
            change = adam.p[t].base
            change -= old[i]
            change *= np.float32(n)
            changes.write(i, index[i], change)
        yield packed(f"{FILES}{changes.files}", np.array([0]), n, np.array([[len(told)]]))
        yield from _changes(adam, *shared.value, list(shared.value[0]), n, packed)
        yield from _told(told, worker, packed)

    return sum_parts(df.mapInArrow(run, PACKED_SCHEMA), workers)


def train_round(
    df: DataFrame, params: Params, moments: Params, steps: int, spec: Sequence[Deep], lr: float,
    batch_size: int, dropout: float, seed: Sequence[int],
) -> tuple[Params, Params, int, float, int]:
    """One round over the partitions of ``df``, averaged by rows.

    Returns parameters, moments, steps taken so far, summed loss and row count. With
    one worker this is plain sequential Adam. Parameters and moments are averaged as changes,
    so a worker sends only embedding rows that moved.
    """
    sums = round_sums(df, params, moments, steps, spec, lr, batch_size, dropout, seed, 1)
    return _averaged(_collected(sums)[0], params, moments, steps)


def _collected(sums: DataFrame) -> tuple[pa.Table, list[tuple[int, int, int, float]]]:
    """The sums of a round on the driver; apart from them the losses: (worker, batch, rows, mean
    loss) of each batch."""
    table = sums.select("tensor", "row", "n", "values").toArrow()
    is_loss = pc.starts_with(table.column("tensor"), LOSS)
    told = table.filter(is_loss).combine_chunks()
    losses = []
    if told.num_rows:
        workers = [int(t[len(LOSS) :]) for t in told.column("tensor").to_pylist()]
        loss, n = matrix(told.column("values").combine_chunks()).astype(np.float64).T
        losses = list(zip(workers, told.column("row").to_pylist(), n.astype(int).tolist(), (loss / n).tolist()))
    return table.filter(pc.invert(is_loss)), losses


def _averaged(
    summed: pa.Table, params: Params, moments: Params, steps: int
) -> tuple[Params, Params, int, float, int]:
    """Old values plus summed changes over the row count."""
    parts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    names = summed.column("tensor").to_numpy()
    index = summed.column("row").to_numpy()
    new = {t: v.copy() for t, v in (params | moments).items()}
    for name in np.unique(names):
        at = np.flatnonzero(names == name)
        parts[name] = (at, matrix(summed.column("values").take(at).combine_chunks()))
    if TOTAL not in parts:
        return params, moments, steps, 0.0, 0
    at, value = parts.pop(TOTAL)
    total, loss = float(summed.column("n")[int(at[0])].as_py()), float(value[0, 0])
    _, value = parts.pop(STEPS)
    taken = float(value[0, 0]) / total
    for name, (at, change) in parts.items():
        new[name][index[at]] += (change / total).astype(new[name].dtype)
    return (
        {t: new[t] for t in params}, {t: new[t] for t in moments},
        steps + max(1, round(taken)), loss, int(total),
    )


def learning_rate(lr: float, epoch, step: int = 5, gamma: float = 0.1):
    """lr * gamma ** floor(epoch / step), ``epoch`` from 0; a number or a column."""
    if isinstance(epoch, int):
        return lr * gamma ** (epoch // step)
    return F.lit(lr) * F.pow(F.lit(gamma), F.floor(epoch / step))


def lr_schedule(
    df: DataFrame, lr: float = 1e-3, step: int = 5, gamma: float = 0.1, epoch: str = "epoch"
) -> DataFrame:
    """Add ``lr`` to a table with epochs from 0."""
    return df.withColumn("lr", learning_rate(lr, F.col(epoch), step, gamma))


def mark_best(history: DataFrame) -> DataFrame:
    """Add ``is_best``: validation loss strictly below that of every epoch before. A loss that is
    not a number is never best."""
    # One row per epoch.
    before = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    lowest = F.coalesce(F.min(F.nanvl("val_loss", F.lit(float("inf")))).over(before), F.lit(float("inf")))
    return history.withColumn("is_best", F.coalesce(F.col("val_loss") < lowest, F.lit(False)))


def best_epoch(history: DataFrame) -> DataFrame:
    """(epoch, val_loss) of the first epoch with the lowest validation loss."""
    return history.agg(
        F.min_by("epoch", F.struct("val_loss", "epoch")).alias("epoch"),
        F.min("val_loss").alias("val_loss"),
    )


@dataclass(frozen=True)
class Fitted:
    """Best parameters, one history row per epoch, one row per batch (its mean loss)."""

    params: DataFrame
    history: DataFrame
    losses: DataFrame


def stage(df: DataFrame, workers: int, rounds: int, key: str | None = None) -> DataFrame:
    """Write the training columns with the round and the worker of each row and a hash ``turn``,
    from which every epoch derives its order; a table partitioned by round.

    With ``key``, a column that tells rows apart, the rows of a worker do not depend on the
    layout of ``df``. Without it the values and the partition a row comes from are hashed.
    """
    values = ["slots", "deep", "label"]
    if key is None:
        turn = F.xxhash64(*values, F.spark_partition_id(), F.monotonically_increasing_id())
    else:
        turn = F.xxhash64(col(key))
    at = F.pmod(F.xxhash64("turn", F.lit(1)), F.lit(rounds * workers))
    placed = df.withColumn("turn", turn).select(
        "slots", "deep", F.col("label").cast("float").alias("label"), "turn",
        (at % rounds).cast("int").alias("round"), F.floor(at / rounds).cast("int").alias("worker"),
    )
    path = scratch_dir(df.sparkSession)
    placed.write.partitionBy("round").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def lay_out(rows: DataFrame, workers: int, seed: Sequence[int]) -> DataFrame:
    """Staged rows with one partition for each worker, in an order that ``seed`` decides."""
    order = F.xxhash64("turn", *map(F.lit, seed))
    laid = rows.repartitionById(workers, F.col("worker")).sortWithinPartitions(order, "turn")
    return laid.select("slots", "deep", "label")


def validate(
    df: DataFrame, params: DataFrame | Params, spec: Sequence[Deep]
) -> DataFrame:
    """(log_loss) of held-out rows; no dropout, no update."""
    return log_loss(score_table(df, params, spec, keep=["label"]))


def fit(
    df: DataFrame, spec: Sequence[Deep], wide_dim: int, validation: DataFrame | None = None,
    hidden: Sequence[int] = HIDDEN, epochs: int = 5, batch_size: int = 2048, lr: float = 1e-3,
    dropout: float = 0.7, workers: int | None = None, rounds: int | None = None, seed: int = 42,
    path: str | None = None, max_bytes: int = BROADCAST_BYTES, key: str | None = None,
) -> Fitted:
    """Train on rows (slots, deep, label); keep the parameters of the best validation loss.

    Each epoch is ``rounds`` rounds; in each, ``workers`` tasks step through their rows in
    batches, in a new order each epoch, and their parameters are averaged. Without ``workers``
    there is one for every four batches of a round, up to the cores of the cluster; without
    ``rounds`` a worker takes about ROUND_BATCHES batches in one. ``key`` names a column that
    tells rows apart. Without ``validation`` the training loss decides. With ``path`` the best
    parameters are saved there whenever they improve. A loss that is not a number improves
    nothing.

    Embeddings that with their moments exceed ``max_bytes`` are not sent to the workers: they
    stay files of the shared folder, or a table where tasks cannot open these, and a worker gets the
    rows that it touches in the round. The steps are the same.
    """
    spark = df.sparkSession
    if workers is None or rounds is None:
        n = df.count()
        if workers is None:
            full = n // (4 * batch_size * (rounds or 1))
            workers = max(1, min(full, spark.sparkContext.defaultParallelism))
        if rounds is None:
            rounds = max(1, -(-n // (workers * batch_size * ROUND_BATCHES)))
    rows = stage(df, workers, rounds, key)
    if validation is not None:
        validation = freeze(validation.select("slots", "deep", "label"))
        if validation.isEmpty():
            raise ValueError("no validation rows")
    if 3 * embedding_bytes(spec) > max_bytes:
        log.info("embeddings exceed %d bytes: workers get the rows that they touch", max_bytes)
        folder = opened_path(spark, scratch_dir(spark))
        if folder is None:
            model = _TableModel(spark, spec, wide_dim, hidden, seed, workers, batch_size, rows)
        else:
            model = _FileModel(spark, spec, wide_dim, hidden, seed, workers, batch_size, folder)
    else:
        model = _BroadcastModel(spec, wide_dim, hidden, seed, workers, batch_size)
    table = lambda p: parameter_table(spark, p) if isinstance(p, dict) else p
    best, lowest, history, losses, told = None, float("inf"), [], scratch_dir(spark), []
    for epoch in range(epochs):
        rate = learning_rate(lr, epoch)
        order = sorted(range(rounds), key=lambda r: permuted_number(r, rounds, seed, epoch))
        total_loss, total = 0.0, 0
        for r in order:
            met, loss, n = model.round(rows.where(F.col("round") == r), rate, dropout, [seed, epoch, r])
            told += [(epoch + 1, r, *batch) for batch in met]
            if len(told) >= LOSS_ROWS:
                told = _write_losses(spark, told, losses)
            total_loss, total = total_loss + loss, total + n
        if not total:
            raise ValueError("no training rows")
        told = _write_losses(spark, told, losses)
        train_loss = total_loss / total
        val_loss = train_loss
        if validation is not None:
            scored = score_table(validation, model.params(), spec, ["label"], max_bytes)
            val_loss = log_loss(scored).first()[0]
        history.append((epoch + 1, rate, train_loss, float(val_loss)))
        log.info("epoch %d: train %.5f validation %.5f", epoch + 1, train_loss, val_loss)
        if val_loss < lowest:
            best, lowest = model.keep(), val_loss
            if path is not None:
                save_parameters(table(best), path)
    best = table(model.params() if best is None else best)
    told = local_table(spark, history, "epoch int, lr double, train_loss double, val_loss double")
    return Fitted(best, mark_best(told), spark.read.schema(LOSS_SCHEMA).parquet(losses))


def _write_losses(spark, told: list[tuple], path: str) -> list[tuple]:
    """Append the losses of batches to the table at ``path``; none are left."""
    if told:
        local_table(spark, told, LOSS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return []


class _BroadcastModel:
    """All parameters and moments on the driver, sent to the workers each round."""

    def __init__(self, spec, wide_dim, hidden, seed, workers, batch_size):
        self.spec, self.workers, self.batch_size = spec, workers, batch_size
        dense = init_parameters(spec, wide_dim, hidden, seed, embeddings=False)
        self.values = drawn_embeddings(spec, seed) | dense
        self.moments, self.steps = _moments(self.values), 0

    def round(self, rows: DataFrame, lr: float, dropout: float, seed: list[int]):
        sums, told = _collected(round_sums(
            lay_out(rows, self.workers, seed), self.values, self.moments, self.steps, self.spec, lr,
            self.batch_size, dropout, seed, self.workers,
        ))
        self.values, self.moments, self.steps, loss, n = _averaged(
            sums, self.values, self.moments, self.steps
        )
        return told, loss, n

    def keep(self) -> Params:
        return self.values

    def params(self) -> Params:
        return self.values


class _FileModel:
    """Dense tensors on the driver; embeddings with moments as files of ranges below ``folder``."""

    def __init__(self, spark, spec, wide_dim, hidden, seed, workers, batch_size, folder):
        self.spark, self.spec, self.workers, self.batch_size = spark, spec, workers, batch_size
        self.folder, self.rounds, self.kept = folder, 0, None
        self.dense = init_parameters(spec, wide_dim, hidden, seed, embeddings=False)
        self.moments, self.steps = _moments(self.dense), 0
        self.files = EmbeddingFiles.drawn(spark, f"{folder}/0", spec, seed)

    def round(self, rows: DataFrame, lr: float, dropout: float, seed: list[int]):
        self.rounds += 1
        before, changed = self.files, f"{self.folder}/{self.rounds}-changes"
        os.makedirs(changed)
        sums, told = _collected(file_round_sums(
            lay_out(rows, self.workers, seed), before, self.dense, self.moments, self.steps, self.spec,
            lr, self.batch_size, dropout, seed, self.workers, changed,
        ))
        is_file = pc.starts_with(sums.column("tensor"), FILES)
        found, sums = sums.filter(is_file).combine_chunks(), sums.filter(pc.invert(is_file))
        if not found.num_rows:
            delete_folder(self.spark, changed)
            return [], 0.0, 0
        names = [t[len(FILES) :] for t in found.column("tensor").to_pylist()]
        taken = matrix(found.column("values").combine_chunks())[:, 0]
        changes = [Changes(f, int(n), int(k)) for f, n, k in sorted(zip(names, found.column("n").to_pylist(), taken))]
        self.files = before.moved(f"{self.folder}/{self.rounds}", changes, self.steps, lr)
        self.dense, self.moments, self.steps, loss, n = _averaged(
            sums, self.dense, self.moments, self.steps
        )
        delete_folder(self.spark, changed)
        if before is not self.kept:
            before.drop()
        return told, loss, n

    def keep(self) -> DataFrame:
        """The parameters, which stay readable until the next call."""
        if self.kept is not None and self.kept is not self.files:
            self.kept.drop()
        self.kept = self.files
        return self.params()

    def params(self) -> DataFrame:
        return self.files.values().unionByName(parameter_table(self.spark, self.dense))


class _TableModel:
    """Dense tensors on the driver; embeddings with moments as a table in buckets."""

    def __init__(self, spark, spec, wide_dim, hidden, seed, workers, batch_size, rows):
        self.spark, self.spec, self.workers, self.batch_size = spark, spec, workers, batch_size
        self.dense = init_parameters(spec, wide_dim, hidden, seed, embeddings=False)
        self.moments, self.steps = _moments(self.dense), 0
        self.table, self.kept = EmbeddingTable.drawn(spark, spec, seed), None
        # as many rows as there are workers and rounds
        sizes = rows.groupBy("round", "worker").count().collect()
        self.sizes = {}
        for r in sizes:
            self.sizes.setdefault(r["round"], []).append(r["count"])

    def round(self, rows: DataFrame, lr: float, dropout: float, seed: list[int]):
        weights: dict[int, float] = {}
        for n in self.sizes.get(seed[-1], []):
            k = -(-n // self.batch_size)
            weights[k] = weights.get(k, 0.0) + n
        if not weights:
            return [], 0.0, 0
        before = self.table
        parts = table_round_parts(
            rows, before, self.dense, self.moments, self.steps, self.spec, lr, self.batch_size,
            dropout, seed, self.workers, sorted(weights),
        )
        self.table = before.moved(parts, self.steps, lr, weights)
        sums, told = _collected(self.table.sums())
        self.dense, self.moments, self.steps, loss, n = _averaged(
            sums, self.dense, self.moments, self.steps
        )
        if before is not self.kept:
            before.drop()
        return told, loss, n

    def keep(self) -> DataFrame:
        """The parameters, which stay readable until the next call."""
        if self.kept is not None and self.kept is not self.table:
            self.kept.drop()
        self.kept = self.table
        return self.params()

    def params(self) -> DataFrame:
        dense = parameter_table(self.spark, self.dense)
        return self.table.values().unionByName(dense)


def distributed_gradient(
    df: DataFrame, dense: Params, table: DataFrame, spec: Sequence[Deep], dropout: float = 0.0,
    seed: Sequence[int] = (0,), max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``batch_gradient`` with joined embeddings.

    A task adds up the gradients of the most frequent rows of each embedding and sends them
    once; the others go out added up by batch of rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(dense)
    rows_in = df.select("slots", "deep", F.col("label").cast("double").alias("label"))
    embedded = embedding_lookup(rows_in, table, spec, max_bytes)
    tensors = [(embedding(d.name), min(d.vocab, HOT_ROWS), d.dim) for d in spec]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        rng = np.random.default_rng([*seed, TaskContext.get().partitionId()])
        hot = {t: np.zeros((size, dim)) for t, size, dim in tensors}
        touched = {t: np.zeros(size, dtype=bool) for t, size, _ in tensors}
        sums: Params = {}
        n, loss = 0, 0.0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            deep, rows, slots, label = _inputs(batch)
            if dropout:
                kept = rng.random(len(slots)) >= dropout
                rows, slots = rows[kept], slots[kept]
            grads, back, batch_loss = backward(
                p, matrix(batch.column("embedded")), rows, slots, 1 / (1 - dropout), label
            )
            for t, v in grads.items():
                sums[t] = sums.get(t, 0) + v.astype(np.float64)
            start = 0
            for i, (t, size, dim) in enumerate(tensors):
                index, values = _add_at(deep[:, i], back[:, start : start + dim])
                start += dim
                frequent = index < size
                hot[t][index[frequent]] += values[frequent]
                touched[t][index[frequent]] = True
                if not frequent.all():
                    yield part(t, index[~frequent], 0, values[~frequent])
            n, loss = n + len(label), loss + batch_loss
        if n:
            for t, v in sums.items():
                yield part(t, np.arange(len(v)), 0, v)
            for t, v in hot.items():
                index = np.flatnonzero(touched[t])
                yield part(t, index, 0, v[index])
            yield part(TOTAL, np.array([0]), 0, np.array([[loss, n]]))

    parts = embedded.mapInArrow(run, PART_SCHEMA)
    # the lookup shuffles rows, so its tasks are not those of the scan
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sum_parts(parts, tasks).select("tensor", "row", "values")


def gbt_baseline(
    df: DataFrame, features: str = "features", label: str = "label", max_bins: int = 128,
    **settings,
):
    """Gradient-boosted trees on the same task; ``max_bins`` at least the largest vocabulary."""
    return GBTClassifier(
        featuresCol=features, labelCol=label, maxBins=max_bins, **settings
    ).fit(df)
