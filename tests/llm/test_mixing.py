import math

import pytest

from clickloom.llm import mixing


def plain_order(sources, block, cycle, weights=None):
    """Slots by simulation: [(source, block, release, deadline)]."""
    names = sorted(sources)
    blocks = {s: -(-sources[s] // block) for s in names}
    weight = {s: math.sqrt(sources[s]) if weights is None else weights.get(s, 0) for s in names}
    total = sum(weight.values())
    share = {s: max(1, math.floor(cycle * weight[s] / total + 0.5)) for s in names}
    out, done = [], dict.fromkeys(names, 0)
    while len(out) < sum(blocks.values()):
        start, base = len(out), dict(done)
        b = {s: min(share[s], blocks[s] - done[s]) for s in names}
        size = sum(b.values())
        for t in range(size):
            ready = []
            for s in names:
                j = done[s] - base[s]
                if j < b[s] and j * size // b[s] <= t:
                    ready.append((-(-(j + 1) * size // b[s]), s))
            deadline, s = min(ready)
            j = done[s] - base[s]
            out.append((s, done[s], start + j * size // b[s], start + deadline))
            done[s] += 1
    return out, share


@pytest.mark.parametrize("weights", [None, {"a": 5.0, "b": 1.0, "c": 2.5}])
def test_schedule(spark, weights):
    sizes = {"a": 700, "b": 90, "c": 31, "": 200}
    rows = [(i, s or None) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    got = mixing.schedule(docs, weights, block=8, cycle=20).select("row.doc_id", "source", "block", "release", "deadline", "slot", "place").toPandas()
    assert sorted(got.doc_id) == list(range(len(rows)))
    assert (got.sort_values("doc_id").source.fillna("").tolist()) == [s or "" for _, s in rows]
    want, share = plain_order(sizes, 8, 20, weights)
    blocks = got.drop_duplicates("slot").sort_values("slot")
    assert [(s or "", b, r, d) for s, b, r, d in zip(
        blocks.source.where(blocks.source.notna(), ""), blocks.block, blocks.release, blocks.deadline)] == want
    assert (got.release <= got.slot).all() and (got.slot < got.deadline).all()
    assert (got.groupby("slot").place.agg(lambda p: sorted(p) == list(range(len(p))))).all()
    # less than one block of deviation at every slot while all sources last
    full = min(-(-sizes[s] // 8) // share[s] for s in sizes) * sum(share.values())
    had = dict.fromkeys(sizes, 0)
    for t, (s, *_) in enumerate(want[:full], 1):
        had[s] += 1
        assert all(abs(had[x] - t * share[x] / sum(share.values())) < 1 for x in sizes)


def test_buckets_number_every_row_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 16)
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    got = mixing.schedule(docs, block=10).select("source", "block", "place", "slot").toPandas()
    assert not got.duplicated(["slot", "place"]).any()
    assert got.groupby("slot").source.nunique().max() == 1
    for _, g in got.groupby("source"):
        assert sorted(g.block * 10 + g.place) == list(range(len(g)))


def test_rows_stay_as_they_are(odd, none):
    laid = mixing.mixed_rows(odd)
    assert laid.columns == odd.columns
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, laid.collect())) == sorted(map(key, odd.collect()))
    assert mixing.mixed_rows(none).count() == 0 and mixing.schedule(none).count() == 0
