"""Packing of tokenised documents into few sequences by best-two-fit.

A sequence is filled greedily, the longest piece that fits first. Then its smallest piece gives
way to two unpacked pieces if they fill the gap that it leaves more tightly; the pair that fills
it best is taken.

Which pieces share a sequence depends on their lengths only, and there are at most ``length``
different ones. So the whole corpus is packed at once: pieces are counted by length, the plan is
made from these counts, equal sequences in one step, and a piece finds its place from its
number among the pieces of its length.
"""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import numpy as np

from clickloom.llm.text import by_slice
from clickloom.llm.tokens import packed
from clickloom.llm.words import word_ids
from clickloom.session import freeze, local_table

VOCABULARY = "word_bpe_49k.json"
#: Tokens of a sequence, id that ends a document.
LENGTH, END = 2048, 0


def best_pair(left: list[int], mask: int, gap: int, above: int) -> tuple[int, int] | None:
    """Lengths a >= b of two pieces left with the greatest sum within ``gap``, more than
    ``above``; of equal sums the one with the longest piece. Bits of ``mask`` are lengths left."""
    best, found = above, None
    a = (mask & ((1 << gap) - 1)).bit_length() - 1
    while a > 0 and 2 * a > best:
        fits = mask & ((2 << min(a, gap - a)) - 1)
        if left[a] == 1 and fits >> a & 1:
            fits ^= 1 << a
        b = fits.bit_length() - 1
        if b > 0 and a + b > best:
            best, found = a + b, (a, b)
            if best == gap:
                break
        a = (mask & ((1 << a) - 1)).bit_length() - 1
    return found


def plan_sequences(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, dict[int, int]]]:
    """(how many, pieces of each length in one, longest first) of the kinds of sequences.

    As long as the pieces of a sequence suffice for another one, the next one is equal. Each kind
    leaves fewer pieces of some length than it takes, so there are at most the sum of
    1 + length / n over the lengths n, whatever the counts.
    """
    left = [0] * (length + 1)
    mask, kinds = 0, []
    for n, k in counts.items():
        if not 0 < n <= length:
            raise ValueError(f"a piece of {n} does not fit into {length}")
        if k > 0:
            left[n] = k
            mask |= 1 << n

    def take(n: int, k: int) -> None:
        nonlocal mask
        left[n] -= k
        mask = mask | 1 << n if left[n] else mask & ~(1 << n)

    while mask:
        room, taken = length, {}
        while fits := mask & ((2 << room) - 1):
            n = fits.bit_length() - 1
            k = min(left[n], room // n)
            taken[n] = k
            take(n, k)
            room -= n * k
        if room and sum(taken.values()) > 1:
            least = min(taken)
            pair = best_pair(left, mask, room + least, least)
            if pair:
                taken[least] -= 1
                take(least, -1)
                for n in pair:
                    taken[n] = taken.get(n, 0) + 1
                    take(n, 1)
                taken = {n: k for n, k in sorted(taken.items(), reverse=True) if k}
        more = min(left[n] // k for n, k in taken.items())
        for n, k in taken.items():
            take(n, k * more)
        kinds.append((1 + more, taken))
    return kinds


def places(kinds: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, after, per, sequence, at): pieces of ``length`` numbered from ``first`` to
    before ``after`` lie ``per`` a sequence, from ``sequence`` on, side by side from ``at``."""
    rows, given, sequence = [], {}, 0
    for many, taken in kinds:
        at = 0
        for n, k in taken.items():
            first = given.get(n, 0)
            given[n] = first + many * k
            rows.append((n, first, given[n], k, sequence, at))
            at += n * k
        sequence += many
    return rows


def document_pieces(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, turn[, ids]) of every row: the ids of its
    whole text and the end id, cut into pieces of ``length`` only where there are more. ``turn``
    numbers the pieces of one length within a task."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        ids_of, end, turns = word_ids(path), packed([END]), [0] * (length + 1)

        def run(doc_ids, texts):
            rows = []
            for doc, raw in zip(doc_ids, ids_of([t or "" for t in texts])):
                raw += end
                for piece, start in enumerate(range(0, len(raw) // 4, length)):
                    part = raw[4 * start : 4 * (start + length)]
                    n = len(part) // 4
                    ids = [np.frombuffer(part, "<u4").astype(np.int32)] if keep_ids else []
                    rows.append((doc, piece, start, n, zlib.crc32(part), turns[n], *ids))
                    turns[n] += 1
            return list(zip(*rows)) if rows else [[]] * (6 + keep_ids)

        return run

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, turn bigint"
    made = by_slice(docs, ["doc_id", "text"], make, schema + ", ids array<int>" * keep_ids)
    return made.withColumn("task", F.spark_partition_id())


def pack_two_fit(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of all pieces.

    NULL and empty texts are the end id alone. Repeated rows and rows without doc_id are packed
    like any other; other columns are not read; an empty table gives no rows. Sequences are
    numbered from 0, offsets are gapless. Pieces are written before they are numbered, so that a
    repeated task cannot number them otherwise. What goes through the driver are the counts of at
    most ``length`` lengths; what is broadcast is the plan, bounded by ``length`` alone.
    """
    pieces = freeze(document_pieces(docs, path, length, keep_ids))
    by_task = freeze(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    # at most one row for each task and length
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = local_table(
        docs.sparkSession, places(plan_sequences(counts, length)),
        "len bigint, first bigint, after bigint, per bigint, sequence bigint, at bigint",
    )
    numbered = pieces.join(starts, ["task", "length"]).withColumn("number", F.col("before") + F.col("turn"))
    placed = numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("len")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("after")),
    )
    inside = F.col("number") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(inside / F.col("per"))).alias("sequence_id"),
        (F.col("at") + inside % F.col("per") * F.col("length")).alias("offset"),
        *["ids"] * keep_ids,
    )
