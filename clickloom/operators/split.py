"""Train and validation splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import col


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Bernoulli split; disjoint and complete, but another partitioning gives another split.

    Every part evaluates ``df`` again, so ``df`` should be read from files: ``freeze`` a table
    that comes out of a shuffle.
    """
    return df.randomSplit(list(weights), seed)


def split_name(key: str, train_pct: int = 70):
    """'train' or 'validation' by the md5 of the key: the same wherever and whenever computed."""
    bucket = F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(bucket < train_pct, "train").otherwise("validation")


def hash_split(df: DataFrame, key: str, train_pct: int = 70) -> DataFrame:
    """Add ``split``. A projection; no shuffle."""
    return df.withColumn("split", split_name(key, train_pct))


def row_counts(df: DataFrame, by: str = "split") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"))
