import hashlib
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import merkle
from clickloom.llm.merkle import Block, address, counts_of, folded, manifest, merkle_proofs, nodes_in, steps_within

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """(root, siblings of each node level by level as (left, right)) of a list of digests."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, k in enumerate(at):
            first = k // 8 * 8
            paths[i].append((level[first:k], level[k + 1 : first + 8]))
            at[i] = k // 8
        level = [sha("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0], paths


def plain_proofs(rows):
    """Counter of result rows for rows (doc_id, text, lang, source, n_chars)."""
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    hashed = lambda d, t, l, s, n: sha("".join(map(show, (d, s, l, n, t))))
    groups = {}
    for d, t, l, s, n in rows:
        tampered = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        lowered = t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        forged = hashed(d, lowered if t is not None else None, l, s, n) if tampered else hashed(d, t, l, s, n)
        groups.setdefault((l is not None, (l or "").encode()), []).append((d is not None, d or 0, hashed(d, t, l, s, n), forged))
    trees = [(k, sorted(v), *plain_tree([r[2] for r in sorted(v)])) for k, v in sorted(groups.items())]
    if not trees:
        return Counter()
    root, above = plain_tree([t[2] for t in trees])
    out = Counter()
    for (_, leaves, subroot, paths), up in zip(trees, above):
        for (known, d, leaf, forged), path in zip(leaves, paths):
            value, beside = forged, ""
            for left, right in [*path, *up]:
                beside += "".join(left + right)
                value = sha("".join([*left, value, *right]))
            out[d if known else None, leaf, subroot, root, sha(beside), value, value == root] += 1
    return out


def made(df):
    assert df.columns == NAMES
    return Counter(tuple(r) for r in df.collect())


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("levels", range(1, 6))
def test_layout_is_van_emde_boas(levels):
    places = [address(levels, d, i) for d in range(levels) for i in range(8**d)]
    assert sorted(places) == list(range(nodes_in(levels)))
    assert address(levels, 0, 0) == 0
    if levels > 1:
        upper = levels // 2
        # the upper half stands first, each subtree below it in one stretch laid out the same way
        assert {address(levels, d, i) for d in range(upper) for i in range(8**d)} == set(range(nodes_in(upper)))
        low = levels - upper
        for k in (0, 8**upper - 1):
            base = nodes_in(upper) + k * nodes_in(low)
            for d in range(low):
                for i in {0, 8**d // 2, 8**d - 1}:
                    assert address(levels, upper + d, k * 8**d + i) == base + address(low, d, i)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_a_block_is_the_plain_tree(n):
    nodes = [sha(str(i)) for i in range(n)]
    block = Block.of(merkle.height_of(0, n), nodes)
    root, paths = plain_tree(nodes)
    assert block.get(0, 0) == root and block.counts == counts_of(n, block.height)
    found = steps_within(Block(block.height, n, bytes(block.nodes)))
    assert found == [[("".join(a), "".join(b)) for a, b in p] for p in paths]
    assert all(folded(v, s) == root for v, s in zip(nodes, found))


def test_odd_rows(spark, odd):
    assert made(merkle_proofs(odd)) == plain_proofs(rows_of(odd))


def test_blocks_over_blocks(spark, monkeypatch):
    """Blocks of 8 leaves make several levels; langs make a tree of several levels of their own."""
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "LOWEST", 8)
    monkeypatch.setattr(merkle, "BROADCAST_GROUPS", 5)
    rows = [(i * 7 % 401, f"Text {i} A", f"l{i % 90}" if i % 3 else ("hot" if i % 2 else None), "s", i) for i in range(900)]
    rows += [(5, "Same", "hot", "s", 1)] * 70 + [(None, None, "hot", None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # workers import the module anew, so blocks are made here
    blocks = manifest_here(rows)
    assert blocks == plain_proofs(rows)
    assert df.count() == len(rows)


def manifest_here(rows):
    """The block method without Spark, with the module's present sizes."""
    height, lowest = merkle.HEIGHT, merkle.LOWEST

    def grow(nodes):
        levels = []
        while True:
            cut = [nodes[i : i + lowest] for i in range(0, len(nodes), lowest)]
            levels.append([Block.of(height if b else merkle.height_of(0, len(c)), c) for b, c in enumerate(cut)])
            nodes = [b.get(0, 0) for b in levels[-1]]
            if len(nodes) == 1:
                return levels, nodes[0]

    def down(levels, steps):
        at = [steps]
        for blocks in reversed(levels):
            at = [[*s, *up] for b, up in zip(blocks, at) for s in steps_within(b)]
        return at

    groups = {}
    show = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    hashed = lambda d, t, l, s, n: sha("".join(map(show, (d, s, l, n, t))))
    for d, t, l, s, n in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if t else t
        tampered = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        groups.setdefault("" if l is None else "+" + l, []).append(
            (d is not None, d or 0, hashed(d, t, l, s, n), hashed(d, low if tampered else t, l, s, n))
        )
    grown = [(k, sorted(v), *grow([r[2] for r in sorted(v)])) for k, v in sorted(groups.items())]
    top, root = grow([g[3] for g in grown])
    out = Counter()
    for (_, leaves, levels, subroot), up in zip(grown, down(top, [])):
        for (known, d, leaf, forged), steps in zip(leaves, down(levels, up)):
            found = folded(forged, steps)
            proof = sha("".join(a + b for a, b in steps))
            out[d if known else None, leaf, subroot, root, proof, found, found == root] += 1
    return out


def test_more_leaves_than_a_block_and_equal_rows(spark):
    """Three levels of blocks would need 16 million leaves; two are met here, one lang being hot."""
    df = spark.range(14_000).selectExpr(
        "if(id < 3000, 7, id) as doc_id", "if(id < 3000, 'Same', concat('T', id)) as text",
        "if(id % 20 = 0, if(id % 40 = 0, null, concat('l', id % 300)), 'hot') as lang", "'s' as source", "id % 5 as n_chars",
    )
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = made(merkle_proofs(df.repartition(6)))
    assert got == plain_proofs(rows)
    held = manifest(df).table().collect()
    assert {(r.tree, r.level) for r in held} == {("groups", 0), ("groups", 1), ("top", 0)}
    assert max(r.n for r in held) == 4096


def test_no_rows(none):
    assert made(merkle_proofs(none)) == Counter() and manifest(none).root is None
