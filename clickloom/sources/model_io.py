"""Saved models: encoders and parameters in one folder, in numbered versions.

A version is a folder of its own: the vocabularies of large columns and the parameters as
Parquet, and a description that is written last. A version without it does not count, so a save
that broke off leaves the one before in force, and readers of older versions are not disturbed.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.encode import Deep, Encoding
from clickloom.operators.network import score_table
from clickloom.session import local_table
from clickloom.sources.features_io import load_parameters, save_parameters

# Number of the layout of a version's folder.
FORMAT = 1
VOCABULARY_SCHEMA = "name string, value string, n bigint, idx bigint"
VERSION = re.compile(r"v(\d{6})$")


@dataclass(frozen=True)
class Model:
    """Fitted encoders with the parameters of the network on them."""

    encoding: Encoding
    params: DataFrame
    version: int

    def score(self, df: DataFrame, keep=("id", "label")) -> DataFrame:
        """(keep, logit, probability) of raw rows, encoded as at fitting."""
        return score_table(self.encoding.transform(df), self.params, self.encoding.spec, keep)


def _folder(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions in a folder, rising."""
    at, files = _folder(spark, path)
    if not files.exists(at):
        return []
    found = []
    for status in files.listStatus(at):
        named = VERSION.match(status.getPath().getName())
        done = status.getPath().suffix("/description/_SUCCESS")
        if named and files.exists(done):
            found.append(int(named[1]))
    return sorted(found)


def describe(encoding: Encoding) -> str:
    """What is not a table: columns, widths, sizes, short label lists and the policy."""
    return json.dumps({
        "format": FORMAT, "wide": encoding.wide, "widths": encoding.widths,
        "deep": [[d.name, d.vocab, d.dim] for d in encoding.deep], "label": encoding.label,
        "sizes": encoding.sizes, "labels": encoding.labels, "on_invalid": encoding.on_invalid,
        "broadcast_rows": encoding.broadcast_rows, "joined": encoding.joined is not None,
        "sizes_in_bytes": encoding.sizes_in_bytes,
    })


def save_model(encoding: Encoding, params: DataFrame, path: str) -> int:
    """Save as the next version; its number."""
    spark = params.sparkSession
    at, files = _folder(spark, path)
    taken = [int(m[1]) for s in (files.listStatus(at) if files.exists(at) else [])
             if (m := VERSION.match(s.getPath().getName()))]
    version = max(taken, default=0) + 1
    root = f"{path.rstrip('/')}/v{version:06d}"
    if encoding.joined is not None:
        encoding.joined.select("name", "value", "n", "idx").write.partitionBy("name").parquet(f"{root}/vocabulary")
    save_parameters(params, f"{root}/parameters")
    local_table(spark, [[describe(encoding)]], "value string").write.text(f"{root}/description")
    return version


def load_model(spark: SparkSession, path: str, version: int | None = None) -> Model:
    """The given or the last version, usable in any session."""
    whole = versions(spark, path)
    if not whole or version is not None and version not in whole:
        raise ValueError(f"no version {'' if version is None else version} of a model in {path}")
    version = whole[-1] if version is None else version
    root = f"{path.rstrip('/')}/v{version:06d}"
    told = json.loads("\n".join(r.value for r in spark.read.text(f"{root}/description").collect()))
    if told["format"] != FORMAT:
        raise ValueError(f"a model of format {told['format']}, not {FORMAT}")
    joined = None
    if told["joined"]:
        joined = spark.read.schema(VOCABULARY_SCHEMA).parquet(f"{root}/vocabulary")
    encoding = Encoding(
        told["wide"], told["widths"], [Deep(*d) for d in told["deep"]], told["label"], told["sizes"],
        told["labels"], joined, told["on_invalid"], told["broadcast_rows"],
        told["sizes_in_bytes"],
    )
    return Model(encoding, load_parameters(spark, f"{root}/parameters"), version)
