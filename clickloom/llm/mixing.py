"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are dealt into blocks. In each cycle of slots a source has as many blocks as
its whole-numbered share; its j-th of b blocks in a cycle of L slots may not start before slot
floor(j L / b) and must be placed before slot ceil((j + 1) L / b). Earliest deadline first among
the released blocks fills every slot and meets all deadlines, so at every slot a source has had
within less than one block of its share. When a source runs out, its last cycle counts what it
still has, and afterwards the others share the slots; every row is placed exactly once.

A cycle looks like the one before it unless a source has just run out, so the schedule is worked
out once for each such stretch (at most two for each source) and every row looks its slot up.
DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import col

#: Rows of a block, slots of a cycle (about), exponent of a source's rows if no weights are given.
BLOCK, CYCLE, TEMPER = 64, 256, 0.5
#: Rows that are numbered together.
BUCKET = 4096


def _stretches(sources: DataFrame, cycle: int, weight: Column) -> DataFrame:
    """One row for each source: shares and, for each stretch of equal cycles, the slots."""
    all_sources = (
        sources.withColumn("weight", weight)
        .groupBy().agg(F.sort_array(F.collect_list(F.struct("s", "blocks", "weight"))).alias("m"))
        .where(F.size("m") > 0)
        .select(F.expr(f"""transform(m, x -> named_struct('s', x.s, 'blocks', x.blocks, 'share',
            greatest(1L, cast(round({cycle} * x.weight / aggregate(m, 0D, (a, y) -> a + y.weight)) as bigint))))
            as m"""))
    )
    stretches = (
        all_sources.select("m", F.expr("""posexplode(filter(array_sort(array_distinct(concat(array(0L),
            transform(m, x -> x.blocks div x.share), transform(m, x -> x.blocks div x.share + 1)))),
            c -> exists(m, x -> x.blocks > c * x.share))) as (stretch, first)"""))
        .select(
            "m", "stretch", "first",
            F.expr("transform(m, x -> greatest(0L, least(x.share, x.blocks - first * x.share))) as b"),
            F.expr("aggregate(m, 0L, (a, x) -> a + least(x.blocks, first * x.share)) as base"),
        )
        .withColumn("length", F.expr("aggregate(b, 0L, (a, x) -> a + x)"))
    )
    # state: blocks placed of each source, and the sources in slot order
    filled = stretches.withColumn("placed", F.expr("""
        aggregate(sequence(0L, length - 1),
            named_struct('done', transform(b, x -> 0L), 'out', cast(array() as array<bigint>), 'pick', -1L),
            (state, t) -> transform(array(
                array_min(transform(
                    filter(sequence(0, size(b) - 1), i -> state.done[i] < b[i] and state.done[i] * length div b[i] <= t),
                    i -> named_struct('deadline', ((state.done[i] + 1) * length + b[i] - 1) div b[i], 'i', cast(i as bigint))
                )).i),
                pick -> named_struct(
                    'done', transform(state.done, (d, i) -> if(i = pick, d + 1, d)),
                    'out', concat(state.out, array(pick)), 'pick', pick))[0],
            state -> state.out)"""))
    slots = (
        filled.select(
            "stretch", "first", "base", "length", "b",
            F.posexplode("placed").alias("t", "i"),
        )
        .groupBy("i", "stretch", "first", "base", "length", F.expr("b[i]").alias("n"))
        .agg(F.array_sort(F.collect_list("t")).alias("slots"))
        .groupBy("i")
        .agg(F.array_sort(F.collect_list(F.struct("first", "base", "length", "n", "slots"))).alias("stretches"))
    )
    shares = all_sources.select(F.posexplode("m").alias("i", "x")).select(
        F.col("i").cast("bigint").alias("i"), "x.s", "x.share"
    )
    return shares.join(slots, "i").drop("i")


def schedule(
    docs: DataFrame, weights: Mapping[str, float] | None = None, source: str = "source",
    key: str = "doc_id", block: int = BLOCK, cycle: int = CYCLE,
) -> DataFrame:
    """(row, source, block, release, deadline, slot, place) of every row of ``docs``.

    ``row`` is the whole row as a struct, so no column can clash. The mixed order is (slot,
    place). Rows of a source come in the order of the hash of ``key``. ``weights`` names the
    target weight of each source; they are rounded to whole shares of a cycle, at least one, and
    the guarantee holds for these shares. A source not named takes one share. Without
    ``weights`` a source weighs the square root of its rows. NULL is a source of its own (not
    named by any weight), NULL and repeated keys are rows like any other, their order among
    equals is arbitrary, texts are not looked at, and an empty table gives an empty result. The
    number of sources is that of the weights of a mixture: one row holds them all.
    """
    rows = docs.count()
    digits = max(0, math.ceil(math.log(max(rows / BUCKET, 1), 16)))
    order = F.md5(F.coalesce(col(key).cast("string"), F.lit("")))
    keyed = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("")).alias("s"),
        order.alias("h"),
    ).withColumn("bucket", F.substring("h", 1, digits))
    counts = keyed.groupBy("s", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "s", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    sources = counts.groupBy("s").agg(F.sum("n").alias("n")).withColumn(
        "blocks", F.expr(f"(n + {block - 1}) div {block}")
    )
    weight = F.sqrt("n") if weights is None else F.lit(0.0)
    for name, value in (weights or {}).items():
        weight = F.when(F.col("s") == "=" + name, F.lit(float(value))).otherwise(weight)
    plan = offsets.join(_stretches(sources, cycle, weight), "s")
    at = Window.partitionBy("s", "bucket").orderBy("h")
    placed = (
        keyed.withColumn("n", F.row_number().over(at) - 1)
        .join(plan, ["s", "bucket"])
        .withColumn("rank", F.col("offset") + F.col("n"))
        .withColumn("block", F.expr(f"rank div {block}"))
        .withColumn("x", F.expr("element_at(filter(stretches, x -> x.first <= block div share), -1)"))
        .withColumn("j", F.expr("block % share"))
        .withColumn("start", F.expr("x.base + (block div share - x.first) * x.length"))
    )
    return placed.select(
        "row", F.when(F.col("s") != "", F.expr("substring(s, 2)")).alias("source"), "block",
        F.expr("start + j * x.length div x.n").alias("release"),
        F.expr("start + ((j + 1) * x.length + x.n - 1) div x.n").alias("deadline"),
        F.expr("start + x.slots[cast(j as int)]").alias("slot"),
        F.expr(f"rank % {block}").alias("place"),
    )


def mixed_rows(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, unchanged, in the order of the schedule: ranges of slots over the
    partitions, sorted inside them. A slot holds one block, so a range cannot run hot."""
    placed = schedule(docs, **parameters).select("row", "slot", "place")
    laid = placed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return laid.select("row.*")
