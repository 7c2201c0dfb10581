"""Packing of tokenised documents into sequences by best-fit decreasing.

Documents longer than a sequence are first cut into full windows. What is left is packed group
by group: longest first, each piece into the open sequence with the least room that still takes
it. A segment tree over the room left finds that sequence in log(length) steps.

Groups are dealt by hash, or, to keep a mix of sources, taken from the mixing schedule stretch by
stretch.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm import mixing
from clickloom.llm.text import by_slice
from clickloom.llm.tokens import VOCABULARY, packed
from clickloom.llm.words import byte_ids
from clickloom.operators.ordering import with_running_totals
from clickloom.session import discard, freeze

#: Tokens of a sequence, id that ends a document, pieces that are packed together.
LENGTH, END, GROUP = 2048, 1, 4096


class Rooms:
    """Open sequences by the room they have left, in a segment tree of counts."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, sequence: int, room: int) -> None:
        if room:
            self.open[room].append(sequence)
            self.change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """An open sequence with the least room of at least ``need``, and its room."""
        node, count = need + self.size, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self.change(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: list[int], length: int = LENGTH) -> tuple[list[int], list[int]]:
    """(sequence, offset) of pieces that come longest first, none longer than ``length``."""
    rooms, sequences, offsets, opened = Rooms(length), [], [], 0
    for n in lengths:
        found = rooms.take(n)
        if found is None:
            found, opened = (opened, length), opened + 1
        sequence, room = found
        sequences.append(sequence)
        offsets.append(length - room)
        rooms.put(sequence, room - n)
    return sequences, offsets


def document_pieces(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): the ids of every row's whole text
    and the end id, cut into windows of ``length``. NULL counts as the empty text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        encode, end = byte_ids(path), packed([END])

        def run(doc_ids, texts):
            rows = []
            for doc, raw in zip(doc_ids, encode([t or "" for t in texts])):
                raw += end
                total = len(raw) // 4
                for start in range(0, total, length):
                    part = raw[4 * start : 4 * (start + length)]
                    ids = [np.frombuffer(part, "<u4").astype(np.int32)] if keep_ids else []
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total, *ids))
            return list(zip(*rows)) if rows else [[]] * (5 + keep_ids)

        return run

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return by_slice(docs, ["doc_id", "text"], make, schema + ", ids array<int>" * keep_ids)


def pack(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, group: int = GROUP,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all rows with (sequence_id, offset): offsets are gapless from 0.

    Full windows are sequences of their own. The other pieces are written, counted and dealt by a
    hash of their place into groups of about ``group`` pieces, whatever the size of the input,
    how long its texts are or how often a row is repeated; so one task holds a bounded number of
    rows, and each group leaves about one sequence partly filled. ``keep_ids`` adds the token ids
    of each piece, from which a sequence is written by ordering its pieces by offset. A row with
    NULL doc_id or repeated rows are packed like any other; other columns are not read.
    """
    pieces = freeze(document_pieces(docs, path, length, keep_ids))
    place = F.monotonically_increasing_id()
    full = pieces.where(F.col("length") == length).select(
        "*", (-1 - place).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    dealt = grouped(pieces.where(F.col("length") < length), group)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * keep_ids]
    made = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    made += "sequence_id bigint, offset bigint" + ", ids array<int>" * keep_ids

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]
        )
        sequences, offsets = best_fit(rows["length"].tolist(), length)
        number = (int(rows["bin"].iloc[0]) << 32) + np.array(sequences, np.int64)
        return rows.assign(sequence_id=number, offset=offsets)[columns]

    return dealt.groupBy("bin").applyInPandas(run, made).unionByName(full.select(columns))


def grouped(written: DataFrame, group: int) -> DataFrame:
    """Rows of a written table with ``bin``, about ``group`` rows each."""
    groups = max(1, -(-written.count() // group))
    place = F.monotonically_increasing_id()
    return written.withColumn("bin", F.pmod(F.xxhash64(place), F.lit(groups)))


def cut_documents(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, source, doc_tokens, pieces) of every row: the pieces of ``document_pieces`` as one
    array of (start, length, ids_crc32[, ids])."""
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        encode, end = byte_ids(path), packed([END])

        def run(doc_ids, sources, texts):
            totals, cut = [], []
            for raw in encode([t or "" for t in texts]):
                raw += end
                totals.append(len(raw) // 4)
                rows = []
                for start in range(0, totals[-1], length):
                    part = raw[4 * start : 4 * (start + length)]
                    row = {"start": start, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                    if keep_ids:
                        row["ids"] = np.frombuffer(part, "<u4").astype(np.int32)
                    rows.append(row)
                cut.append(rows)
            return doc_ids, sources, totals, cut

        return run

    piece = "start: bigint, length: bigint, ids_crc32: bigint" + ", ids: array<int>" * keep_ids
    schema = f"doc_id bigint, source string, doc_tokens bigint, pieces array<struct<{piece}>>"
    return by_slice(docs, ["doc_id", "source", "text"], make, schema)


def pack_mixed(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, group: int = GROUP,
    keep_ids: bool = False, **parameters,
) -> DataFrame:
    """The columns of ``pack``, packed along ``mixing.schedule(docs, **parameters)``.

    A group is a stretch of the schedule: whole slots, in order, until they hold ``group`` pieces
    (one slot more at most). sequence_id rises with the stretches and, inside one, with the place
    in the schedule of the piece that opened the sequence, so ranges of sequence_id have the mix
    of the ranges of slots. Rows are cut once, and only their lengths are moved (with
    ``keep_ids`` their ids too).
    """
    cut = freeze(cut_documents(docs, path, length, keep_ids))
    placed = freeze(mixing.schedule(cut, **parameters).select("row.*", "slot", "place"))
    discard(cut)
    slots = placed.groupBy("slot").agg(F.sum(F.size("pieces")).alias("n"))
    stretches = with_running_totals(slots, [], ["slot"], {"upto": F.col("n")}).select(
        "slot", F.expr(f"(upto - n) div {group}").alias("bin")
    )
    dealt = placed.join(stretches, "slot").select(
        "bin", "slot", "place", "doc_id", "doc_tokens", F.inline("pieces")
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    made = ", ".join(f"{c} bigint" for c in columns) + ", ids array<int>" * keep_ids

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "slot", "place", "start"], ascending=[False, True, True, True]
        )
        sequences, offsets = best_fit(rows["length"].tolist(), length)
        opened = rows.iloc[np.unique(sequences, return_index=True)[1]]
        number = np.empty(len(opened), np.int64)
        number[np.lexsort((opened["start"], opened["place"], opened["slot"]))] = range(len(opened))
        number = (int(rows["bin"].iloc[0]) << 32) + number[sequences]
        rows = rows.assign(sequence_id=number, offset=offsets)
        return rows[columns + ["ids"] * keep_ids]

    return dealt.groupBy("bin").applyInPandas(run, made)
