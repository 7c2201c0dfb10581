"""Raw impressions: CSV reader, hour column, crosses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickloom.functions.scalar import cross_value, hour_text
from clickloom.session import col

# The raw fields and their order.
IMPRESSION_SCHEMA = T.StructType(
    [T.StructField("id", T.DecimalType(20, 0))]
    + [T.StructField(n, T.IntegerType()) for n in ("click", "hour", "C1", "banner_pos")]
    + [
        T.StructField(n, T.StringType())
        for n in (
            "site_id", "site_domain", "site_category", "app_id", "app_domain",
            "app_category", "device_id", "device_ip", "device_model",
        )
    ]
    + [
        T.StructField(n, T.IntegerType())
        for n in ("device_type", "device_conn_type", *(f"C{i}" for i in range(14, 22)))
    ]
)

# The crossed pairs.
CROSSES = [
    ("hr", "app_category"),
    ("hr", "site_category"),
    ("hr", "device_type"),
    ("banner_pos", "device_type"),
    ("device_type", "app_category"),
    ("device_type", "site_category"),
]


def read_impressions(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header row. With ``schema`` the extra pass that infers types is saved.

    The columns of ``schema`` are found by name; others, such as an unnamed index column, are
    left out. A column that is missing from a file's header, a line of another width and, where it
    is read, a value that is not of its type are errors.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    if missing := [n for n in schema.names if n not in header]:
        raise ValueError(f"columns {missing} are not in the header of {path}")
    # a column without a name in the file is called _c and its number on reading
    names = ["" if n == f"_c{i}" and n not in schema.names else n for i, n in enumerate(header)]
    full = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in names])
    strict = reader.schema(full).option("mode", "FAILFAST").option("columnPruning", False)
    # without enforcement every file's header is compared with the names
    return strict.option("enforceSchema", False).csv(path).select(*[col(n) for n in schema.names])


def derive_hour(df: DataFrame, hour: str = "hour") -> DataFrame:
    """All columns plus ``hr``, the two-digit hour."""
    return df.select("*", hour_text(col(hour)).alias("hr"))


def drop_tolerant(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns; absent ones are no error."""
    return df.drop(*names)


def cross(df: DataFrame, pairs: Iterable[tuple[str, str]], sep: str = "") -> DataFrame:
    """All columns plus one column ``a-b`` per pair, in a single projection."""
    return df.select("*", *[cross_value(a, b, sep).alias(f"{a}-{b}") for a, b in pairs])


def enrich(df: DataFrame) -> DataFrame:
    """Raw impressions with hour and crosses, without the unnamed index column."""
    return cross(drop_tolerant(derive_hour(df), "_c0"), CROSSES)
