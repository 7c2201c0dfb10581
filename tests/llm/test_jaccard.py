import re
from collections import defaultdict
from random import Random

import pytest

from clickloom.llm import jaccard
from clickloom.llm.components import components
from clickloom.session import freeze

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows):
    """Component (by place in ``rows``) of every (doc_id, text)."""
    sets, places, parent = [shingles(t) for _, t in rows], defaultdict(list), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in places[g]:
                common[j] += 1
            places[g].append(i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    out = []
    for i, s in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((rows[i][0], len(s), min(ids, default=None)))
    return sorted(out, key=repr)


def found(docs):
    return sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=repr)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_components(request, table):
    docs = request.getfixturevalue(table)
    assert found(docs) == plain_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def chain_rows():
    """Texts that drift away from each other, close ones linked; a passage common to all of two
    unlike families; and copies."""
    rows = []
    for family, step in ((0, 3), (1, 12)):
        words = [f"f{family}w{i}" for i in range(200)]
        for k in range(40):
            words = [f"f{family}k{k}w{i}" if k * step <= i < (k + 1) * step else w for i, w in enumerate(words)]
            rows.append((100 * family + k, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(50))
    rows += [(300 + k, " ".join(f"u{k}_{i}" for i in range(30)) + " " + passage) for k in range(30)]
    rows += [(400 + k, rows[5][1]) for k in range(10)]
    return rows


def test_large_regions_are_joined_by_pivots(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    rows = chain_rows()
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain_components(rows)


def edited_rows(n):
    """A text, copies of it with one to six words changed, and some cut short."""
    random, rows = Random(7), []
    words = [f"w{i}" for i in range(120)]
    for k in range(n):
        copy = list(words)
        for at in random.sample(range(len(copy)), k and 1 + k % 6):
            copy[at] = random.choice(["the", "and", "of", "in", f"own{k}"])
        rows.append((k, " ".join(copy[: -random.randrange(1, 25)] if k % 10 == 9 else copy)))
    return rows


def test_near_copies_measure_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 16)
    monkeypatch.setattr(jaccard, "PIVOTS", 4)
    measured, measure = [], jaccard._Links.measure

    def counted(links, pairs):
        pairs = freeze(pairs)
        measured.append(pairs.count())
        return measure(links, pairs)

    monkeypatch.setattr(jaccard._Links, "measure", counted)
    rows = edited_rows(240)
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain_components(rows)
    assert sum(measured) < 12 * len(rows)


def test_one_of_each_component_stays(odd, none, documents):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    blank = [i for i, t in rows if not shingles(t)]
    firsts = {c for i, n, c in plain_components(rows) if n}
    assert ids == sorted([*blank, *firsts, 7], key=repr)  # id 7 has two unlike texts
    assert jaccard.keep_one(none).count() == 0 and jaccard.jaccard_components(none).count() == 0
    want = {c for _, _, c in plain_components([(r.doc_id, r.text) for r in documents.collect()])}
    assert {r.doc_id for r in jaccard.keep_one(documents).collect()} == want


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    rows = spark.createDataFrame(path + star + [(5000, 5000), (7000, 6999)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(rows).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {7000: 6999, 6999: 6999}
