"""Left join to a keyed table that may be large, on a key that may be skewed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import col, freeze

# Rows of the keyed table that are broadcast as the frequent part when the whole is too large.
HOT_ROWS = 1000
SPREAD = 1 << 16
# Bytes of the answers to frequent keys that are broadcast.
HEAVY_BYTES = 128 << 20
# Bytes of rows or answers that one task joins.
TASK_BYTES = 64 << 20


def rank_lookup(
    df: DataFrame, key: Column, table: DataFrame, table_key: str, value: str, rank: str,
    rows: int, broadcast_rows: int, name: str,
) -> DataFrame:
    """Add ``name``: the ``value`` of the ``table`` row whose ``table_key`` equals ``key``.

    ``table`` holds each key once; ``rank`` orders its rows from the most frequent key, and
    ``rows`` is their number. Up to ``broadcast_rows`` the table is broadcast. Beyond, only
    its HOT_ROWS most frequent rows are, and the rest is joined by shuffle. Rows already
    answered are kept in place of a hot key by a spread one, so a key that holds a third of
    the rows reaches no single task. The spread depends on the key and the partition only,
    so that a repeated task sends each row to the same place again. A frequent key that the
    table does not hold is left to the adaptive split of skewed joins.
    """
    kept = [col(c) for c in df.columns]
    entry = table.select(
        col(table_key).alias("__k"), col(value).alias("__v"), col(rank).alias("__rank")
    )
    if rows <= broadcast_rows:
        small = F.broadcast(entry.drop("__rank"))
        return df.withColumn("__key", key).join(small, F.col("__key") == F.col("__k"), "left").select(
            *kept, F.col("__v").alias(name)
        )
    hot = F.broadcast(
        entry.where(F.col("__rank") < HOT_ROWS).select("__k", F.col("__v").alias("__hot"))
    )
    # The table's salt is always 0, but computed: a literal would be folded into the condition
    # and rows be shuffled by the key alone.
    zero = F.pmod(F.xxhash64("__k"), F.lit(1)).cast("int")
    cold = entry.where(F.col("__rank") >= HOT_ROWS).select("__k", "__v", zero.alias("__s"))
    # A NULL key matches nothing either, and spreads likewise.
    settled = F.col("__hot").isNotNull() | F.col("__key").isNull()
    # The key and the partition, not the whole row: no column is read for it.
    spread = F.pmod(F.xxhash64("__key", F.spark_partition_id()), F.lit(SPREAD)).cast("int") + 1
    marked = (
        df.withColumn("__key", key)
        .join(hot, F.col("__key") == F.col("__k"), "left")
        .drop("__k")
        .withColumn("__salt", F.when(settled, spread).otherwise(F.lit(0)))
    )
    # Settled rows have a salt of at least 1 and the table a salt of 0: they meet nothing.
    joined = marked.join(
        cold, (F.col("__key") == F.col("__k")) & (F.col("__salt") == F.col("__s")), "left"
    )
    return joined.select(*kept, F.coalesce("__hot", "__v").alias(name))


def long_lookup(
    df: DataFrame, keys: Mapping[str, Column], table: DataFrame, value_bytes: int,
    max_bytes: int = HEAVY_BYTES,
) -> DataFrame:
    """Add a column for each name of ``keys``: the ``value`` of the row of ``table`` (name, key,
    value) with that name and key, NULL where there is none or the key is NULL.

    All columns are looked up at once, in long form: (row, column, key). Keys that very many rows
    hold are found by counting, whether the table holds them or not; their answers are broadcast,
    at most ``max_bytes`` of them at ``value_bytes`` each, and the number of rows of any other key
    is bounded. The number of partitions follows the answers' bytes, so that a task holds about
    TASK_BYTES of them, however many rows there are. Only the rows' numbers and other keys meet the
    table; the rows themselves move once, to their answers. They are written first, so that their
    numbers stay.
    """
    names = list(keys)
    numbered = df.select(
        "*", *[k.alias(f"__k{i}") for i, k in enumerate(keys.values())],
        F.monotonically_increasing_id().alias("__row"),
    )
    rows = freeze(numbered)
    key_columns = F.array(*[col(f"__k{i}") for i in range(len(names))])
    long = rows.select("__row", F.posexplode(key_columns).alias("__i", "__key")).where("__key is not null")
    counts = freeze(long.groupBy("__i", "__key").agg(F.count("*").alias("n")))
    heavy = freeze(counts.where(F.col("n") > _most_rows(counts, value_bytes, max_bytes)).drop("n"))
    place = F.array_position(F.array(*map(F.lit, names)), F.col("name")) - 1
    entry = table.select(
        place.cast("int").alias("__i"), F.col("key").alias("__key"), F.col("value").alias("__v")
    ).where("__i >= 0")
    met = freeze(entry.join(F.broadcast(heavy), ["__i", "__key"]))
    other = long.join(F.broadcast(heavy), ["__i", "__key"], "left_anti")
    parts = _partitions(rows, len(names) * value_bytes)
    found = other.repartition(parts, "__i", "__key").join(entry.repartition(parts, "__i", "__key"), ["__i", "__key"])
    answers = found.repartition(parts, "__row").groupBy("__row").agg(
        F.map_from_entries(F.collect_list(F.struct("__i", "__v"))).alias("__answers")
    )
    out, values = rows.repartition(parts, "__row").join(answers, "__row", "left"), []
    for i, name in enumerate(names):
        mine = met.where(F.col("__i") == i).select(F.col("__key").alias(f"__h{i}"), F.col("__v").alias(f"__v{i}"))
        out = out.join(F.broadcast(mine), col(f"__k{i}") == col(f"__h{i}"), "left")
        values.append(F.coalesce(col(f"__v{i}"), F.col("__answers")[i]).alias(name))
    return out.select(*[col(c) for c in df.columns], *values)


def _partitions(rows: DataFrame, answer_bytes: int) -> int:
    """Partitions in which the answers of a row take ``answer_bytes``."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() * answer_bytes // TASK_BYTES))


def _most_rows(counts: DataFrame, value_bytes: int, max_bytes: int) -> int:
    """Rows that a key may have without being answered by broadcast: about a quarter of a
    partition's, or more where that many answers would exceed ``max_bytes``."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, total // (4 * parts), -(-total * value_bytes // max_bytes))
