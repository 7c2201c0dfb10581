"""Column profiles: exact distinct counts of many columns in one pass, and what follows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import col, freeze, local_table

PROFILE_SCHEMA = "pos int, name string, type string, ndv bigint, has_null boolean"
# Only these two types are candidates; wider numbers (ids) are not.
CANDIDATE_TYPES = ("string", "int")
# Rows in which a column of too many values is looked for first.
SCREEN_ROWS = 10_000
# Logarithm of a sketch's registers, and its relative error.
SKETCH_BITS, SKETCH_ERROR = 12, 1.04 / 2**6


def candidates(df: DataFrame) -> list[str]:
    """Names of all string and all int columns in schema order."""
    return [n for n, t in df.dtypes if t in CANDIDATE_TYPES]


def columns_by_type(df: DataFrame) -> DataFrame:
    """(pos, name, type) of every string and int column."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes) if t in CANDIDATE_TYPES]
    return local_table(df.sparkSession, rows, "pos int, name string, type string")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, value, n) of several columns in one scan; NULL is a value of its own.

    Values are compared as text. Frequent values are added up before the shuffle, so a value
    that holds a third of the rows costs one row per task.
    """
    if not cols:
        return local_table(df.sparkSession, [], "name string, value string, n bigint")
    # Columns go by their number until they are counted: shorter keys to hash and compare.
    texts = df.select(*[col(c).cast("string").alias(str(i)) for i, c in enumerate(cols)])
    long = texts.unpivot([], [str(i) for i in range(len(cols))], "number", "value")
    names = F.array(*[F.lit(c) for c in cols])
    return (
        long.groupBy("number", "value")
        .agg(F.count("*").alias("n"))
        .select(names[F.col("number").cast("int")].alias("name"), "value", "n")
    )


def summarize(counts: DataFrame, columns: DataFrame) -> DataFrame:
    """Profile rows from value counts; a column without rows counts 0."""
    seen = counts.groupBy("name").agg(
        F.count("value").alias("ndv"), F.max(F.col("value").isNull()).alias("has_null")
    )
    return columns.join(seen, "name", "left").select(
        "pos",
        "name",
        "type",
        F.coalesce("ndv", F.lit(0).cast("bigint")).alias("ndv"),
        F.coalesce("has_null", F.lit(False)).alias("has_null"),
    )


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(pos, name, type, ndv, has_null): exact distinct counts, NULL not counted."""
    cols = list(cols) if cols is not None else candidates(df)
    columns = local_table(
        df.sparkSession,
        [(i, n, t) for i, (n, t) in enumerate(df.dtypes) if n in cols],
        "pos int, name string, type string",
    )
    return summarize(value_counts(df, cols), columns)


def vocab_sizes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(pos, name, vocab) with NULL counted as a value; ``pos`` follows ``cols``."""
    order = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("name")) - 1
    return profile(df, cols).select(
        order.cast("int").alias("pos"),
        "name",
        (F.col("ndv") + F.col("has_null").cast("int")).alias("vocab"),
    )


def sketch_files(df: DataFrame, cols: Sequence[str], file: Column | None = None) -> DataFrame:
    """(file, name, sketch): a mergeable sketch of the distinct values of each column in each file.

    One scan; what is shuffled is a few kilobytes for each file and column and task. Kept as a
    table, it lets a profile of a grown table read the new files alone (``add_files``). ``file``
    tells the file of a row, by default as Spark reads it.
    """
    at = F.input_file_name() if file is None else file
    numbers = {c: str(i) for i, c in enumerate(cols)}
    sketches = [F.hll_sketch_agg(col(c).cast("string"), F.lit(SKETCH_BITS)).alias(i) for c, i in numbers.items()]
    if not sketches:
        return local_table(df.sparkSession, [], "file string, name string, sketch binary")
    # the file is a column before it is a group, for it must be taken where rows are read
    wide = df.withColumn("__file", at).groupBy("__file").agg(*sketches)
    names = F.array(*[F.lit(c) for c in cols])
    return wide.unpivot("__file", [col(i) for i in numbers.values()], "number", "sketch").select(
        F.col("__file").alias("file"), names[F.col("number").cast("int")].alias("name"), "sketch"
    )


def freeze_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches as a written table, to be kept beside the data."""
    return freeze(sketches)


def add_files(kept: DataFrame, more: DataFrame) -> DataFrame:
    """Sketches of ``kept`` and those of ``more`` whose files are new."""
    return kept.unionByName(more.join(kept.select("file").distinct(), "file", "left_anti"))


def estimated_sizes(sketches: DataFrame) -> DataFrame:
    """(name, ndv): about how many distinct values the columns have in all files together."""
    return sketches.groupBy("name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("ndv")
    )


def screen(
    df: DataFrame, cols: Sequence[str], max_bins: int, sketches: DataFrame | None = None
) -> list[str]:
    """Columns that may have at most ``max_bins`` values; the values of others are never grouped.

    A column with more values than that among SCREEN_ROWS rows is proven to have too many. Of
    the others the sketches of all rows tell it, with a margin of six times their error: those
    given, or made by one scan. What is left is to be counted exactly.
    """
    if not cols:
        return []
    some = value_counts(df.limit(SCREEN_ROWS), cols).groupBy("name").agg(F.count("value").alias("ndv"))
    above = {r["name"] for r in some.where(F.col("ndv") > max_bins).collect()}
    left = [c for c in cols if c not in above]
    if sketches is None:
        sketches = sketch_files(df, left, F.lit(""))
    most = max_bins * (1 + 6 * SKETCH_ERROR) + 1
    over = estimated_sizes(sketches.where(F.col("name").isin(left))).where(F.col("ndv") > most)
    above |= {r["name"] for r in over.collect()}
    return [c for c in cols if c not in above]


def rank_columns(profile: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 within each type: by distinct count descending, ties in schema order."""
    order = Window.partitionBy("type").orderBy(F.desc("ndv"), "pos")
    return profile.select("*", (F.row_number().over(order) - 1).alias("rank"))


def select_wide(profile: DataFrame, max_bins: int = 100, label: str = "click") -> DataFrame:
    """Profile rows of the wide columns with their ``rank``: strings first, then ints.

    ``max_bins`` is inclusive. The label must be among the columns kept by it and is removed.
    Columns with a single value carry no information and cannot be one-hot encoded, so they
    are left out; ``constant_columns`` lists them.
    """
    kept = profile.where(F.col("ndv") <= max_bins)
    # The profile has one row per column of the table, so the whole of it fits one window.
    has_label = F.max(F.col("name") == label).over(Window.partitionBy())
    checked = kept.select(
        "pos",
        F.when(has_label, F.col("name"))
        .otherwise(F.raise_error(F.lit(f"label {label} is not among the columns kept")))
        .alias("name"),
        "type",
        "ndv",
        "has_null",
    ).where((F.col("name") != label) & (F.col("ndv") > 1))
    order = Window.orderBy((F.col("type") == "int").cast("int"), F.desc("ndv"), "pos")
    return checked.select((F.row_number().over(order) - 1).alias("rank"), "*")


def constant_columns(profile: DataFrame) -> DataFrame:
    """Profile rows of columns with fewer than two values."""
    return profile.where(F.col("ndv") < 2)


def wide_dim(selected: DataFrame) -> DataFrame:
    """(wide_dim): slots of the one-hot vector, one value of each column being implied."""
    return selected.agg(F.coalesce(F.sum(F.col("ndv") - 1), F.lit(0)).alias("wide_dim"))
