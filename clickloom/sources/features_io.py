"""Feature files and parameter tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import col

PARAMETER_SCHEMA = "tensor string, row int, values array<float>"


def number_text(name: str) -> Column:
    """A column of doubles as the text that CSV has for it. Zero and one, most of what feature
    rows hold, are literals, for printing a double costs more than all else of writing it."""
    x = col(name)
    zero = (x == 0) & (F.pow(x, F.lit(-1.0)) > 0)  # not -0.0
    return F.when(zero, "0.0").when(x == 1, "1.0").otherwise(x.cast("string")).alias(name)


def write_features(df: DataFrame, path: str, n_files: int | None = None) -> None:
    """Headerless CSV that replaces ``path``.

    Without ``n_files`` every partition writes its own file and nothing is shuffled. With it
    the rows are spread over that many files; one file means one task, as asked for.
    """
    laid = df if n_files is None else df.repartition(n_files)
    if len({n.lower() for n in df.columns}) == len(df.columns):  # else a name does not tell a column
        laid = laid.select(*[number_text(n) if t == "double" else col(n) for n, t in df.dtypes])
    laid.write.mode("overwrite").csv(path)


def feature_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def read_features(
    spark: SparkSession, path: str, schema: T.StructType | Sequence[str]
) -> DataFrame:
    """Headerless CSV of every ``.csv`` file under ``path``; columns are named by position. A
    line of another width or, where it is read, a value that is no number is an error."""
    if not isinstance(schema, T.StructType):
        schema = feature_schema(schema)
    strict = spark.read.schema(schema).option("mode", "FAILFAST").option("columnPruning", False)
    return strict.option("pathGlobFilter", "*.csv").csv(path)


def batch_files(spark: SparkSession, path: str) -> list[str]:
    """The ``.csv`` files of a folder in name order: file k is batch k, as ``file_batches`` counts."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = files.listStatus(at) if files.exists(at) else []
    found = [s.getPath() for s in listed if s.isFile()]
    return sorted(p.toString() for p in found if p.getName().endswith(".csv"))


def read_batch(
    spark: SparkSession, path: str, schema: T.StructType | Sequence[str], batch: int
) -> DataFrame:
    """The rows of one batch; only its file is opened."""
    return read_features(spark, batch_files(spark, path)[batch], schema)


def save_parameters(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_parameters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMETER_SCHEMA).parquet(path)
