"""Jaccard join of word shingles in metric space, with the components of its links.

Jaccard distance is a metric, and two texts link within distance 0.2. Between unrelated texts it
is 1, so distances to pivots drawn from the whole corpus tell nothing. Regions are therefore
first opened by shingles: a text stands in the region of each shingle of its prefix, so that two
texts that link share a region (a set of n shingles cannot reach 80 % with another one unless one
of its first n - ceil(0.8 n) + 1 in a common order is common to both). The order is arbitrary for
the result; shingles frequent in a sample of documents come last, which keeps regions small.
They are held as a table of bits of bounded size, in which others may count as frequent too.

Regions of few texts are compared pair by pair. In larger ones pivots are drawn, all members are
measured against them, and a member belongs to the nearest pivots. Those within 0.2 of a pivot
are one component with it. By the triangle inequality such a member can only link to a text that
lies within 0.2 of the member's own distance from the pivot, so it leaves the region unless a
text of another component stands in that window; members near the boundary and far members stay,
and the region is joined again with new pivots, four times as many, until one component or
few texts are left. Equal sets are one text throughout.

The place of a region's shingle in a text's prefix bounds what the text can share in it: with the
first common shingle at place i of n, counted from 0, at most n - i are common. That gives the
size of the largest partner, and a text leaves a large region when no text of another component
there is small enough for it and reaches it in turn. Texts with many shingles of their own thus
leave groups of near copies before anything is measured.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.text import by_slice, mixed
from clickloom.session import discard, freeze, local_table

WORDS = 5
#: Regions of up to so many texts are compared pair by pair; pivots of the first round.
SMALL, PIVOTS = 128, 16
#: One document in so many is counted to order shingles.
SAMPLE = 16
#: Logarithms of the least and most bits of a table of bits, and its bits for each entry.
LEAST_BITS, MOST_BITS, SPARSE = 16, 27, 16
#: Words remembered by a task.
CACHE = 1 << 20
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                    0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)
        return h


def shingle_set(text: str | None, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, empty without words."""
    found = list(map(words.__getitem__, (text or "").encode("utf-8", "replace").lower().split()))
    if not found:
        return np.zeros(0, np.uint64)
    h = np.array(found, np.int64).view(np.uint64)
    size = max(1, len(h) - WORDS + 1)
    sums = np.full(size, len(h) if len(h) < WORDS else WORDS, np.uint64)
    for i in range(min(WORDS, len(h))):
        sums = mixed(sums + h[i : i + size] * FACTORS[i])
    return np.unique(sums)


def prefix_length(n):
    return n - (4 * n + 4) // 5 + 1


def reach(n: str, i: str):
    """The most shingles of a text that can link to one of ``n`` whose first common one is at ``i``."""
    return F.expr(f"(5 * {n} - 9 * {i}) div 4")


def digest(hashes: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(raw, np.int64).tolist())


def _bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """Table of ``bits`` bits with those at the values of column ``p`` set; at most 16 MB."""
    words = (
        places.groupBy(F.expr("p div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("w")).toArrow()
    )
    table = np.zeros(bits // 64, np.int64)
    table[words["word"].to_numpy()] = words["w"].to_numpy()
    return table.view(np.uint64)


def _table_bits(entries: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, (entries * SPARSE).bit_length()))


def _hit(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def _frequent(docs: DataFrame) -> np.ndarray:
    """Bits of the shingles that stand in two or more sampled documents, by their low bits."""
    def make():
        words = WordHashes()

        def run(texts):
            sets = [shingle_set(t, words) for t in texts]
            return [np.concatenate(sets).view(np.int64)] if sets else [[]]

        return run

    sampled = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counts = freeze(
        by_slice(sampled, ["text"], make, "s bigint").groupBy("s").agg(F.count("*").alias("n"))
        .where("n > 1").select("s")
    )
    bits = 1 << _table_bits(counts.count())
    return _bit_table(counts.select(F.expr(f"s & {bits - 1}").alias("p")), bits)


def _texts(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, th, n, d1, d2, cut, prefix) of every row. ``cut`` are the high bits of the
    last shingle of the prefix in the common order."""
    last = docs.sparkSession.sparkContext.broadcast(_frequent(docs))

    def make():
        words, frequent = WordHashes(), last.value
        low = np.uint64(64 * len(frequent) - 1)

        def run(ids, ths, texts):
            rows = []
            for text in texts:
                s = shingle_set(text, words)
                late = _hit(frequent, (s & low).astype(np.int64))
                prefix = np.concatenate([s[~late], s[late]])[: prefix_length(len(s)) if len(s) else 0]
                cut = 0
                if len(prefix):
                    cut = int(prefix[-1] >> np.uint64(50)) + (len(prefix) > (~late).sum()) * (1 << 14)
                rows.append((len(s), *digest(s), cut, prefix.view(np.int64)))
            return [ids, ths, *zip(*rows)]

        return run

    keyed = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull()).alias("th"), "text"
    )
    schema = "doc_id bigint, th bigint, n bigint, d1 bigint, d2 bigint, cut int, prefix array<bigint>"
    made = by_slice(keyed, ["doc_id", "th", "text"], make, schema)
    return freeze(made.withColumn("rid", F.monotonically_increasing_id()))


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(rep, n, hashes) of the needed texts (rep, doc_id, d1, d2).

    A filter of bits of bounded size says which documents to shingle again; too many pass it
    when the bound is reached, and the join leaves them out.
    """
    bits = 1 << _table_bits(needed.count())
    places = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(bits)).alias(f"p{k}") for k in range(3)]
    table = _bit_table(needed.select(F.explode(F.array(*places)).alias("p")), bits)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def make():
        known, table = WordHashes(), sent.value

        def run(texts, *places):
            hit = np.ones(len(texts), bool)
            for p in places:
                hit &= _hit(table, np.array(p, np.int64))
            sets = [shingle_set(texts[i], known) for i in np.flatnonzero(hit)]
            if not sets:
                return [[]] * 4
            return [*zip(*[digest(s) for s in sets]), [len(s) for s in sets], [s.view(np.int64) for s in sets]]

        return run

    found = by_slice(
        docs.select("text", *places), ["text", "p0", "p1", "p2"], make,
        "d1 bigint, d2 bigint, n bigint, hashes array<bigint>",
    )
    return freeze(
        found.join(needed.select("d1", "d2", "rep"), ["d1", "d2"])
        .groupBy("rep").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"))
    )


class _Links:
    """Measured pairs and the components they make so far."""

    def __init__(self, spark: SparkSession, sets: DataFrame):
        self.spark, self.sets, self.tables = spark, sets, []
        self.labels = local_table(spark, [], "node bigint, label bigint")

    def measure(self, pairs: DataFrame) -> DataFrame:
        """(a, b, distance, link) of the pairs within 0.4; those within 0.2 become links.

        Only the sets of these pairs move: that of b once, that of a is broadcast where the written
        sets of all a are small enough for that, else the two meet at a.
        """
        pairs = freeze(pairs.select("a", "b"))
        wanted = lambda k: self.sets.join(pairs.select(F.col(k).alias("rep")).distinct(), "rep", "left_semi")
        sides = {"a": freeze(wanted("a")), "b": wanted("b")}
        side = lambda k: sides[k].select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("hashes").alias(f"h{k}"))
        near = (
            pairs.join(side("b"), "b").join(side("a"), "a")
            .select("a", "b", (F.col("na") + F.col("nb")).alias("n"), F.size(F.array_intersect("ha", "hb")).cast("bigint").alias("i"))
            .where("8 * i >= 3 * n")
        )
        near = freeze(near.select("a", "b", F.expr("1 - i / (n - i)").alias("distance"), F.expr("9 * i >= 4 * n").alias("link")))
        for table in (pairs, sides["a"]):
            discard(table)
        self.tables.append(near)
        self.contract(near.where("link"))
        return near

    def contract(self, links: DataFrame) -> None:
        """Put the links into the labels, known components counting as one node. A node with many
        partners leaves one link to the least of them, and the pairs of partners that it connects:
        no more links than nodes, and pairs of pivots."""
        ends = self.labelled(self.labelled(links, "a", "la"), "b", "lb").where("la <> lb")
        stars = freeze(ends.groupBy("lb").agg(F.array_sort(F.collect_set("la")).alias("partners")))
        pairs = stars.select(F.explode(F.expr(
            "transform(slice(partners, 2, size(partners)), p -> struct(partners[0] as a, p as b))"
        )).alias("p")).select("p.*")
        if not stars.isEmpty():
            made = components(stars.select(F.col("partners")[0].alias("a"), F.col("lb").alias("b")).union(pairs))
            moved = self.labels.join(
                made.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left"
            ).select("node", F.coalesce("to", "label").alias("label"))
            new = made.join(self.labels, "node", "left_anti").select("node", "label")
            self.labels = freeze(moved.union(new))
            self.tables.append(self.labels)
        discard(stars)

    def labelled(self, df: DataFrame, node: str, name: str) -> DataFrame:
        mine = self.labels.select(F.col("node").alias(node), F.col("label").alias(name))
        return df.join(mine, node, "left").withColumn(name, F.coalesce(name, node))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are not yet known to be connected."""
        both = self.labelled(self.labelled(pairs, "a", "la"), "b", "lb")
        return both.where("la <> lb").select("a", "b")


def _pairs(members: DataFrame, fields: list[str], condition: str) -> DataFrame:
    """Pairs (a, b, x, y) within regions of at most SMALL members (s, rep, fields) for which the
    condition on x and y holds."""
    return (
        members.groupBy("s").agg(F.collect_list(F.struct("rep", *fields)).alias("m"))
        .select(F.explode("m").alias("x"), "m")
        .select("x", F.explode(F.expr(f"filter(m, y -> y.rep > x.rep and {condition})")).alias("y"))
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), "x", "y")
    )


def _small_pairs(regions: DataFrame) -> DataFrame:
    """Pairs of the small regions that may still reach 80 %: the shingles common to both
    prefixes are known, and beyond the prefix that ends first only its text's rest is left.
    Pairs of which one stands in too few small regions for that are left out before counting."""
    rest = lambda k: f"((4 * {k}.n + 4) div 5 - 1)"
    lacks = f"""(4 * (x.n + y.n) - 9 * (least(x.big, y.big) + case when x.cut < y.cut then {rest('x')}
        when y.cut < x.cut then {rest('y')} else greatest({rest('x')}, {rest('y')}) end))"""
    alike = "5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)"
    return (
        _pairs(regions, ["n", "cut", "big", "few"], f"{alike} and 9 * least(x.few, y.few) >= {lacks}")
        .groupBy("a", "b").agg(F.count("*").alias("common"), F.max(F.expr(lacks)).alias("lacks"))
        .where("9 * common >= lacks").select("a", "b")
    )


def _with_partners(members: DataFrame) -> DataFrame:
    """The members (s, rep, n, reach, c) that a text of another component may link to in their
    region. Of the components other than the largest a text also counts for itself."""
    mine = Window.partitionBy("s")
    marked = (
        members.withColumn("same", F.struct(F.count("*").over(Window.partitionBy("s", "c")).alias("n"), "c"))
        .withColumn("largest", F.max("same").over(mine)["c"])
    )
    # each text stands at its size, and asks at its reach for the farthest reach up to there
    up_to = mine.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    farthest = lambda which: F.max(F.expr(f"if(asks or not ({which}), null, reach)")).over(up_to)
    both = F.array(
        F.struct(F.col("n").alias("at"), F.lit(False).alias("asks")),
        F.struct(F.col("reach").alias("at"), F.lit(True).alias("asks")),
    )
    return (
        marked.withColumn("p", F.explode(both)).select("s", "rep", "n", "reach", "c", "largest", "p.*")
        .withColumn("inside", farthest("c = largest")).withColumn("outside", farthest("c <> largest"))
        .where("asks and (outside >= n or c <> largest and inside >= n)")
        .select("s", "rep", "n", "reach", "c")
    )


def _join_large(regions: DataFrame, links: _Links) -> list[DataFrame]:
    """Joins regions (s, rep, n, i) of more than SMALL members, round by round. Returns the pairs
    that regions shrunk to few members leave to be measured."""
    left = []
    # regions of the same members are one
    mark = [F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"mark{k}") for k in (1, 2)]
    marks = regions.groupBy("s").agg(F.count("*").alias("size"), *mark)
    one = marks.select("s", F.min("s").over(Window.partitionBy("size", "mark1", "mark2")).alias("one"))
    regions, round_ = freeze(
        regions.join(one, "s").groupBy(F.col("one").alias("s"), "rep")
        .agg(F.max("n").alias("n"), F.min("i").alias("i"))
        .select("s", "rep", "n", "i", reach("n", "i").alias("reach"))
    ), 0
    while True:
        # members outside the region's largest component are its pivots if they are few, for then
        # nothing is left to measure; else some have the region's shingle first, which the least
        # changed of near copies do, and some are drawn at random, the same ones in all regions
        mine, turn = Window.partitionBy("s"), F.xxhash64("rep", F.lit(round_))
        pivots = PIVOTS << 2 * round_
        first = max(1, pivots // 4)
        members = freeze(
            _with_partners(links.labelled(regions, "rep", "c"))
            .withColumn("members", F.count("*").over(mine))
            .withColumn("same", F.struct(F.count("*").over(Window.partitionBy("s", "c")).alias("n"), "c"))
            .withColumn("largest", F.max("same").over(mine))
            .withColumn("others", F.col("members") - F.col("largest.n")).where("others > 0")
            .withColumn("all", F.col("others") <= pivots)
            .withColumn("pivot", F.when(F.col("all"), F.col("c") != F.col("largest.c")).otherwise(
                (F.row_number().over(mine.orderBy(F.expr("4 * reach - 5 * n").desc(), turn)) <= first)
                | (F.row_number().over(mine.orderBy(turn)) <= pivots - first)))
            .select("s", "rep", "n", "reach", "c", "members", "all", "pivot")
        )
        if members.isEmpty():
            return left
        few = members.where(F.col("members") <= SMALL)
        pairs = _pairs(few, ["n", "reach", "c"], "x.c <> y.c and x.n <= y.reach and y.n <= x.reach")
        left.append(freeze(pairs.select("a", "b").distinct()))
        all_members, members = members, members.where(F.col("members") > SMALL)
        if members.isEmpty():
            return left
        chosen = members.where("pivot").select(
            "s", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("reach").alias("ra"), F.col("c").alias("ca")
        )
        # pairs known to be connected need no measure; nor, where no windows follow, those out of reach
        near = links.measure(
            members.join(chosen, "s")
            .where("c <> ca and if(all, n <= ra and na <= reach, 5 * least(n, na) >= 3 * greatest(n, na))")
            .select("a", F.col("rep").alias("b")).distinct()
        )
        # the nearest pivot of a member whose window holds no text of another component
        named = links.labelled(links.labelled(near, "a", "ca"), "b", "cb")
        window = named.where("ca <> cb").groupBy("a").agg(F.min("distance").alias("nearest"))
        home = (
            named.where("link").join(window, "a", "left")
            .where("nearest is null or distance < nearest - 0.2 - 1e-9")
            .groupBy(F.col("b").alias("rep")).agg(F.min_by("a", F.struct("distance", "a")).alias("a"))
        )
        done = members.where("not pivot").join(home, "rep").join(chosen, ["s", "a"], "left_semi").select("s", "rep")
        before = regions
        regions = freeze(
            members.where("not pivot").select("s", "rep", "n", "reach").join(done, ["s", "rep"], "left_anti")
        )
        for table in (before, all_members):
            discard(table)
        round_ += 1


def join_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, d1, d2) and their classes of equal sets (d1, d2, component,
    first), ``first`` being the least (no doc_id, doc_id, th) of the component."""
    rows = _texts(docs)
    with_words = rows.where("n > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first")
    classes = freeze(with_words.groupBy("d1", "d2").agg(F.min("rid").alias("rep"), F.max("n").alias("n"), least))
    prefixes = with_words.groupBy("d1", "d2").agg(
        F.min("rid").alias("rep"), F.max("n").alias("n"), F.max("cut").alias("cut"), F.first("prefix").alias("prefix")
    )
    regions = (
        prefixes.select("rep", "n", "cut", F.posexplode("prefix").alias("i", "s"))
        .withColumn("members", F.count("*").over(Window.partitionBy("s"))).where("members > 1")
    )
    large, mine = F.col("members") > SMALL, Window.partitionBy("rep")
    regions = freeze(
        regions.withColumn("big", F.sum(large.cast("int")).over(mine))
        .withColumn("few", F.count("*").over(mine) - F.col("big"))
    )
    narrow = freeze(rows.select("doc_id", "n", "d1", "d2"))
    discard(rows)
    small = freeze(_small_pairs(regions.where(~large)))
    done = [regions, small]
    wanted = small.select(F.col("a").alias("rep")).union(small.select("b")).union(regions.where(large).select("rep"))
    # any document of the class will do to shingle it again
    needed = freeze(wanted.distinct().join(classes.select("rep", "first.doc_id", "d1", "d2"), "rep"))
    sets = _sets(docs, needed)
    links = _Links(docs.sparkSession, sets)
    for pairs in _join_large(regions.where(large).select("s", "rep", "n", "i"), links):
        small = small.union(pairs)
    # one partner each first: most other pairs are then connected already
    first = links.apart(small.groupBy("b").agg(F.min("a").alias("a")))
    links.measure(first)
    links.measure(links.apart(small))
    named = freeze(links.labelled(classes, "rep", "component"))
    for table in (*done, needed, sets, classes, *links.tables):
        discard(table)
    firsts = named.groupBy("component").agg(F.min("first").alias("first"))
    return narrow, named.select("d1", "d2", "component").join(firsts, "component")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are lower-cased (A to Z) and the whole text is read. Rows without words (NULL, empty,
    blank) have 0 shingles, link with nothing and are their own component. Repeated rows and
    equal texts are one component; ``component_id`` is the least doc_id in it, NULL only if all
    are NULL. Shingles are compared as 64-bit hashes. Other columns are not read; an empty table
    gives no rows.
    """
    rows, classes = join_classes(docs)
    return rows.join(classes, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that are the first of their component (least doc_id,
    then a hash of the text; one of equal rows), and all rows without words."""
    _, classes = join_classes(docs)
    first = classes.select(
        F.coalesce("first.doc_id", F.lit(0)).alias("k"), F.col("first.th").alias("th")
    ).distinct().withColumn("first", F.lit(True))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"),
        F.coalesce("doc_id", F.lit(0)).alias("k"),
        F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull()).alias("th"),
        F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("words"),
    )
    turn = F.row_number().over(Window.partitionBy("k", "th").orderBy("th"))
    return (
        keyed.join(first, ["k", "th"], "left").withColumn("turn", turn)
        .where("not words or (first and turn = 1)").select("row.*")
    )
