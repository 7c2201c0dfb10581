import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from pyspark.sql import functions as F

from clickloom.llm import packing, tokens
from clickloom.llm.packing import document_pieces, grouped, pack
from clickloom.session import freeze

PATH = public_tokenizers.path(tokens.VOCABULARY)


def plain_best_fit(lengths, length):
    rooms, out = [], []
    for n in lengths:
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fitting:
            i = min(fitting)[1]
        else:
            i = len(rooms)
            rooms.append(length)
        out.append(length - rooms[i])
        rooms[i] -= n
    return sorted(rooms), out


@pytest.mark.parametrize("length", [1, 7, 64, 100])
def test_best_fit_leaves_the_rooms_of_plain_best_fit(length):
    rng = random.Random(length)
    lengths = sorted((rng.randint(1, length) for _ in range(400)), reverse=True)
    sequences, offsets = packing.best_fit(lengths, length)
    used = {}
    for n, s, o in zip(lengths, sequences, offsets):
        assert used.get(s, 0) == o
        used[s] = o + n
    rooms, want = plain_best_fit(lengths, length)
    assert sorted(length - u for u in used.values()) == rooms and offsets == want


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_pieces_hold_every_id_once_and_fill_sequences(request, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs, group=64, keep_ids=True).toPandas()
    found = docs.collect()
    encoded = tokens.encode(PATH, [r.text or "" for r in found])
    want = sorted((-1 if r.doc_id is None else r.doc_id, [*ids, 1]) for r, ids in zip(found, encoded))
    assert (rows.length <= 2048).all() and (rows.length == rows.ids.map(len)).all()
    crc = rows.ids.map(lambda i: zlib.crc32(np.array(i, "<u4").tobytes()))
    assert (crc == rows.ids_crc32).all()
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.append(0, s.length.cumsum()[:-1])).all()
        assert s.length.sum() <= 2048
    if table == "documents":
        got = sorted(
            (int(d), [i for ids in g.sort_values("start").ids for i in ids]) for d, g in rows.groupby("doc_id")
        )
        assert got == want
        assert rows.length.sum() / (2048 * rows.sequence_id.nunique()) > 0.9
    else:
        assert rows.length.sum() == sum(len(ids) for _, ids in want)
        assert (rows[rows.start == 0].doc_tokens.sum()) == sum(len(ids) for _, ids in want)


def test_no_rows(none):
    assert packing.pack(none).count() == 0


@pytest.fixture(scope="module")
def mixture(spark):
    sizes = {"a": 1600, "b": 400, "c": 100}
    rows = [(i, s, f"{s} {i} " * (5 + i * 7919 % 300)) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(7)


def test_sequences_follow_the_mix(spark, mixture):
    weights = {"a": 0.5, "b": 0.25, "c": 0.25}
    rows = packing.pack_mixed(mixture, group=60, weights=weights, block=4, cycle=8).toPandas()
    assert sorted(rows.doc_id[rows.start == 0]) == list(range(2100))
    source = {r.doc_id: r.source for r in mixture.select("doc_id", "source").collect()}
    first = rows[rows.start == 0].assign(source=lambda r: r.doc_id.map(source)).sort_values("sequence_id")
    # c lasts for 400 rows and b for 800 more; until then every stretch has the target weights
    for rows_at in (slice(0, 100), slice(100, 200), slice(200, 300)):
        part = first.source.iloc[rows_at].value_counts(normalize=True)
        assert all(abs(part[s] - w) < 0.1 for s, w in weights.items())
    assert set(first.source.iloc[1000:1400]) <= {"a", "b"} and set(first.source.iloc[-300:]) == {"a"}
    for _, s in rows.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset.to_numpy() == np.append(0, s.length.cumsum()[:-1])).all() and s.length.sum() <= 2048
    assert rows.length.sum() / (2048 * rows.sequence_id.nunique()) > 0.8


def test_mixed_pieces_are_those_of_pack(odd, none):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    key = lambda df: sorted(map(repr, df.select(*names).collect()))
    assert key(packing.pack_mixed(odd, keep_ids=True)) == key(packing.pack(odd, keep_ids=True))
    assert packing.pack_mixed(odd).columns == packing.pack(odd).columns
    assert packing.pack_mixed(none).count() == 0


@pytest.mark.parametrize("rows", ["equal", "long"])
def test_groups_are_bounded_by_pieces(spark, rows):
    """20,000 equal rows, and 400 texts of 40 windows each that are not full."""
    if rows == "equal":
        df = spark.range(20_000).selectExpr("cast(null as bigint) as doc_id", "'three word text' as text")
        length = 2048
    else:
        df = spark.range(400).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 2600) as text")
        length = 128
    pieces = freeze(document_pieces(df, length=length))
    held = grouped(pieces.where(F.col("length") < length), 500).groupBy("bin").count()
    assert held.agg(F.max("count")).first()[0] < 700
    made = pack(df, length=length, group=500).toPandas()
    assert len(made) == pieces.count()
    ends = made.assign(end=made.offset + made.length).groupby("sequence_id").agg(
        used=("length", "sum"), end=("end", "max")
    )
    assert (ends.used == ends.end).all() and ends.end.max() <= length
