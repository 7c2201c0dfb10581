"""Column access and the shared folder in which intermediate tables are written."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def col(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows held by the driver as a DataFrame; no Python worker is needed to read them."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)


def scratch_dir(spark: SparkSession) -> str:
    """Path of a new, not yet existing folder in the cluster's shared folder.

    The shared folder is the one of ``spark.checkpoint.dir``. A machine-local folder is used
    only by a local master that has none configured.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="clickloom-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/clickloom-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return the written table.

    Cuts the lineage: values that depend on the physical layout (partition numbers, row
    positions) stay as written when executors are lost, and later readers still prune columns.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    frozen = spark.read.schema(df.schema).parquet(path)
    frozen.frozen_path = path
    return frozen


def discard(frozen: DataFrame) -> None:
    """Delete the files of a table made by ``freeze`` that nothing will read any more."""
    delete_folder(frozen.sparkSession, frozen.frozen_path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def opened_path(spark: SparkSession, folder: str) -> str | None:
    """The path by which Python opens a folder on a mounted file system; None for any other."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(sc._jsc.hadoopConfiguration())
    return path.toUri().getPath() if system.getUri().getScheme() == "file" else None


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="clickloom-package-")) / here.name
    archive = shutil.make_archive(str(base), "zip", here.parent, here.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
