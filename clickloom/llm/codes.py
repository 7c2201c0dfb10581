"""Product codes of vectors: a codebook for each part of a vector, found by ball k-means.

An entry and the parts that it stands for are a ball; its radius is the distance of the farthest
one. By the triangle inequality a part can only leave for an entry within twice the radius: the
ball's neighbours, nearest first. A part at distance a from its entry can only leave for those of
them within 2 a; so parts within half the distance of the nearest neighbour, the stable core, are
compared with nothing, and the others lie in rings, of which ring k is compared with the first k
neighbours. A ball that did not move and whose neighbours did not move keeps its parts without
any distance being taken. All distances are squared and of integers, so the result is that of
comparing every part with every entry.

Rows stay where they are. In each round a task assigns its rows, writes them with their new
codes, and writes one row of sums; what meets on the driver are sums and radii of the entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickloom.operators.lookup import HOT_ROWS, rank_lookup
from clickloom.session import col, discard, freeze, local_table, ship_package

#: Parts of a vector, entries of a codebook, rounds, steps of a component from 0 to 1.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components are below this in absolute value, so that squared distances fit 64 bits.
LARGEST = 1 << 14
#: Labels that are broadcast with their sums.
BROADCAST_LABELS = 100_000
#: Squared distances below this are exact in 64-bit floats.
EXACT = 1 << 53

STATE = "vec_id bigint, label string, parts array<int>, codes array<tinyint>, sums array<bigint>"


@dataclass(frozen=True)
class Balls:
    """What a round needs: entries, the neighbours of each, and which balls are at rest.

    ``entries[p]`` are the entries of part p, ``neighbours[p][i]`` the other entries that the
    ball i can reach, nearest first, -1 beyond; ``apart[p][i]`` their squared distances.
    """

    entries: np.ndarray
    neighbours: np.ndarray
    apart: np.ndarray
    rest: np.ndarray


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact: Python integers where floats would not be."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


def balls(entries: np.ndarray, radii: np.ndarray, moved: np.ndarray) -> Balls:
    """Neighbours by radius. ``radii[p][i]`` bounds the distance of the members of a ball from its
    present entry, infinity if nothing is known."""
    parts, n = radii.shape
    neighbours = np.full((parts, n, n - 1), -1)
    apart = np.full((parts, n, n - 1), np.inf, object)
    rest = np.zeros((parts, n), bool)
    for p in range(parts):
        for i in range(n):
            other = np.array([j for j in range(n) if j != i], int)
            far = squares(entries[p][other], entries[p][i])
            order = sorted(range(len(other)), key=lambda k: (far[k], other[k]))
            order = [k for k in order if float(far[k]) <= (2 * radii[p][i]) ** 2 * (1 + 1e-9)]
            neighbours[p][i][: len(order)] = other[order]
            apart[p][i][: len(order)] = far[order]
            rest[p][i] = not moved[p][i] and not moved[p][other[order]].any()
    return Balls(entries, neighbours, apart, rest)


def assign(
    x: np.ndarray, code: np.ndarray, entries: np.ndarray, neighbours: np.ndarray, apart: np.ndarray,
    rest: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry of each row of ``x``, squared distance to it, distances taken), ties to the
    lower entry, from the present entries ``code``. Rows of balls at rest stay, at distance -1."""
    new, distance = code.copy(), np.full(len(x), -1, x.dtype)
    at = np.flatnonzero(~rest[code])
    own = squares(x[at], entries[code[at]])
    distance[at] = own
    taken = len(at)
    for k in range(neighbours.shape[1]):
        inside = apart[code[at], k] <= 4 * own
        at, own = at[inside], own[inside]
        if not len(at):
            break
        other = neighbours[code[at], k]
        far = squares(x[at], entries[other])
        taken += len(at)
        nearer = (far < distance[at]) | ((far == distance[at]) & (other < new[at]))
        new[at[nearer]], distance[at[nearer]] = other[nearer], far[nearer]
    return new, distance, taken


def _exact(x: np.ndarray, b: Balls, p: int) -> tuple[np.ndarray, ...]:
    """Rows, entries, neighbours and their distances of part p, as floats if squared distances are
    exact in them, else as Python integers."""
    largest = max((int(np.abs(v).max()) for v in (x, b.entries[p]) if v.size), default=0)
    kind = np.float64 if x.shape[-1] * (2 * largest) ** 2 < EXACT else object
    return x.astype(kind), b.entries[p].astype(kind), b.neighbours[p], b.apart[p].astype(kind)


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.num_rows
    parts = batch.column("parts").flatten().to_numpy(zero_copy_only=False)
    codes = batch.column("codes").flatten().to_numpy(zero_copy_only=False)
    return parts.astype(np.int64).reshape(n, PARTS, width), codes.astype(np.int64).reshape(n, PARTS)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1), kind))


def _assigned(rows: DataFrame, round_: Balls, width: int) -> DataFrame:
    """The rows with new codes; each task ends with a row of its sums, counts and squared radii."""
    shared = rows.sparkSession.sparkContext.broadcast(round_)
    fields = T.StructType.fromDDL(STATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, arrow = shared.value, to_arrow_schema(fields)
        n = b.entries.shape[1]
        # sums are of whole numbers, added up as such
        sums, counts = np.zeros((PARTS, n, width), np.int64), np.zeros((PARTS, n), np.int64)
        radii = np.zeros((PARTS, n), np.int64)
        for batch in batches:
            parts, codes = _columns(batch, width)
            for p in range(PARTS):
                x, *ball = _exact(parts[:, p], b, p)
                codes[:, p], far, _ = assign(x, codes[:, p], *ball, b.rest[p])
                np.add.at(sums[p], codes[:, p], parts[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=n)
                np.maximum.at(radii[p], codes[:, p], far.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("parts"),
                 _lists(codes, pa.int8()), pa.nulls(batch.num_rows, arrow.field("sums").type)], schema=arrow,
            )
        if counts.any():
            all_sums = np.concatenate([sums.ravel(), counts.ravel(), radii.ravel()])
            nulls = [pa.nulls(1, f.type) for f in list(arrow)[:4]]
            yield pa.RecordBatch.from_arrays([*nulls, _lists(all_sums[None], pa.int64())], schema=arrow)

    return rows.mapInArrow(run, fields)


def _measured(rows: DataFrame, round_: Balls, width: int) -> DataFrame:
    """(vec_id, label, code, error): assigned for the last time, with the distances."""
    shared = rows.sparkSession.sparkContext.broadcast(round_)
    fields = T.StructType.fromDDL("vec_id bigint, label string, code string, error bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, arrow = shared.value, to_arrow_schema(fields)
        for batch in batches:
            parts, codes = _columns(batch, width)
            error = np.zeros(batch.num_rows, object)
            for p in range(PARTS):
                x, *ball = _exact(parts[:, p], b, p)
                codes[:, p], far, _ = assign(x, codes[:, p], *ball, np.zeros_like(b.rest[p]))
                error += far.astype(np.int64) if far.dtype != object else far
            raw = codes.astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([r.tobytes().hex() for r in raw], pa.string()),
                 pa.array([int(e) for e in error], pa.int64())], schema=arrow,
            )

    return rows.mapInArrow(run, fields)


def whole_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, parts): the rows without missing or non-finite components, as integers."""
    x = col(vector).cast("array<double>")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    large = F.raise_error(F.lit(f"a component is not below {LARGEST}"))
    steps = lambda v: F.when(F.abs(v) < LARGEST, F.floor(v * SCALE)).otherwise(large).cast("int")
    kept = vectors.where(col(vector).isNotNull() & F.forall(x, finite))
    return kept.select("vec_id", F.col("label").cast("string").alias("label"), F.transform(x, steps).alias("parts"))


@dataclass(frozen=True)
class Codes:
    """Codebooks (part, entry, position) and the coded rows (vec_id, label, code, error)."""

    entries: np.ndarray
    rows: DataFrame

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def fit_codes(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> Codes | None:
    """Codebooks after ``rounds`` rounds and the codes by them; None without whole vectors.

    Codebooks start as the parts of the ENTRIES least vec_ids (NULL last; of equal ones the least
    vector). Fewer rows give fewer entries. An entry without parts stays. Vectors of different
    lengths, or of a length that PARTS does not divide, are an error, as are components beyond
    LARGEST.
    """
    ship_package(vectors.sparkSession)
    rows = whole_vectors(vectors, vector)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(ENTRIES).collect()
    if not first:
        return None
    length = len(first[0].parts)
    if length % PARTS or any(len(r.parts) != length for r in first):
        raise ValueError(f"vectors of {length} components cannot be cut into {PARTS} equal parts")
    width, n = length // PARTS, len(first)
    other = F.raise_error(F.lit(f"a vector has not {length} components"))
    rows = rows.withColumns({
        "parts": F.when(F.size("parts") == length, F.col("parts")).otherwise(other),
        "codes": F.array_repeat(F.lit(0).cast("tinyint"), PARTS),
    })
    entries = np.array([r.parts for r in first], object).reshape(n, PARTS, width).transpose(1, 0, 2)
    radii, moved = np.full((PARTS, n), np.inf), np.ones((PARTS, n), bool)
    state = None
    for _ in range(rounds):
        round_ = balls(entries, radii, moved)
        before, state = state, freeze(_assigned(rows, round_, width))
        if before is not None:
            discard(before)
        rows = state.where("sums is null")
        sums = state.where("sums is not null").select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(
            F.sum(F.col("v").cast("decimal(38,0)")).alias("total"), F.max("v").alias("most")
        ).collect()
        total, most = np.zeros((2, PARTS * n * (width + 2)), object)
        for r in sums:
            total[r.i], most[r.i] = int(r.total), r.most
        cut = PARTS * n * width
        counts = total[cut : cut + PARTS * n].reshape(PARTS, n, 1)
        found = total[:cut].reshape(PARTS, n, width)
        new = np.where(counts > 0, found // np.maximum(counts, 1), entries)
        far = np.sqrt(most[cut + PARTS * n :].astype(float)).reshape(PARTS, n)
        # balls at rest measured their new members only
        far = np.where(round_.rest, np.maximum(far, radii), far)
        shift = np.sqrt(squares(new, entries).astype(float))
        moved = (new != entries).any(axis=2)
        entries, radii = new, (far + shift) * (1 + 1e-9)
    coded = freeze(_measured(rows, balls(entries, radii, moved), width))
    if state is not None:
        discard(state)
    return Codes(entries, coded)


def product_codes(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the rows without missing or
    non-finite components.

    ``code`` has two hex digits for each part, ``error`` is the squared distance to the coded
    vector, ``label_error`` its sum over the rows of equal label, NULL being one label. Repeated
    rows are coded each, ties go to the lower entry, an empty table gives no rows. Other columns
    are not read.
    """
    made = fit_codes(vectors, vector)
    names = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if made is None:
        return local_table(vectors.sparkSession, [], names)
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    sums = freeze(
        made.rows.groupBy(key.alias("key"))
        .agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("total"), F.count("*").alias("n"))
    )
    labels, n = sums.agg(F.count("*"), F.sum("n")).first()
    # of labels with a thousandth of the rows there are at most a thousand
    ranked = sums.withColumn("rank", F.when(F.col("n") * HOT_ROWS > n, 0).otherwise(HOT_ROWS))
    summed = rank_lookup(made.rows, key, ranked, "key", "total", "rank", labels, BROADCAST_LABELS, "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(made.digest).alias("codebooks_sha256"))
