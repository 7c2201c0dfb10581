"""Encoders: frequency index, one-hot slots, feature names, training rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, OneHotEncoder, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.lookup import long_lookup, rank_lookup
from clickloom.operators.ordering import with_rank
from clickloom.operators.profile import value_counts
from clickloom.session import col, freeze

SEP = "SEP"
# Index labels that the driver may hold for all columns of a pipeline together.
MAX_LABELS = 200_000
# Values of one column that an encoding looks up in place, frequent ones first; larger
# vocabularies stay tables and are joined.
MAX_INLINE_LABELS = 128
# Vocabulary rows and bytes that may be broadcast for one column.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
# Bytes of a row of a broadcast table besides its text.
ROW_BYTES = 48
# Values of one column that may be ranked in one task.
MAX_RANKED_IN_TASK = 1_000_000


@dataclass(frozen=True)
class Deep:
    """A deep column: its vocabulary size and embedding width."""

    name: str
    vocab: int
    dim: int

    @property
    def feature(self) -> str:
        return SEP.join([self.name, str(self.vocab), str(self.dim)])


def parse_feature(feature: str) -> Deep:
    name, vocab, dim = feature.rsplit(SEP, 2)
    return Deep(name, int(vocab), int(dim))


def feature_spec(names: DataFrame) -> DataFrame:
    """(pos, name, vocab, dim) from a table (pos, feature) of names ``<name>SEP<vocab>SEP<dim>``."""
    part = F.split("feature", SEP)
    n = F.size(part)
    return names.select(
        "pos",
        F.array_join(F.slice(part, 1, n - 2), SEP).alias("name"),
        F.element_at(part, -2).cast("int").alias("vocab"),
        F.element_at(part, -1).cast("int").alias("dim"),
    )


def index_values(
    counts: DataFrame, order: str = "frequencyDesc", largest: int | None = None
) -> DataFrame:
    """Value counts without NULL plus ``idx`` from 0: frequent first, ties alphabetical.

    ``order`` may also be ``alphabetAsc``. Columns with very many values are ranked over
    ranges instead of one task per column; ``largest`` is the largest vocabulary if known.
    """
    known = counts.where(F.col("value").isNotNull())
    keys = [F.desc("n"), F.col("value")] if order == "frequencyDesc" else [F.col("value")]
    if largest is None:
        largest = known.groupBy("name").count().agg(F.max("count")).first()[0] or 0
    if largest > MAX_RANKED_IN_TASK:
        return with_rank(known, ["name"], keys, "idx")
    window = Window.partitionBy("name").orderBy(*keys)
    return known.select("*", (F.row_number().over(window) - 1).cast("bigint").alias("idx"))


def string_index(df: DataFrame, cols: Sequence[str], order: str = "frequencyDesc") -> DataFrame:
    """The vocabulary (name, value, n, idx) of several columns, counted in one scan."""
    return index_values(freeze(value_counts(df, cols)), order)


class FrequencyIndexer(Estimator):
    """Fits the ``StringIndexerModel``s of many columns from grouped value counts.

    The counts are grouped on the executors and only the distinct values reach the driver,
    behind a check of their number.
    """

    @keyword_only
    def __init__(
        self, *, inputCols, outputCols, handleInvalid="error", labelCol=None,
        labelOrder="frequencyDesc", maxLabels=MAX_LABELS,
    ):
        super().__init__()
        self.settings = dict(self._input_kwargs)

    def copy(self, extra=None):
        return self

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        s = self.settings
        counts = freeze(value_counts(dataset, list(dict.fromkeys(s["inputCols"]))))
        return indexer_from_counts(
            counts, s["inputCols"], s["outputCols"], s.get("handleInvalid", "error"),
            s.get("labelCol"), s.get("labelOrder", "frequencyDesc"),
            s.get("maxLabels", MAX_LABELS),
        )


def indexer_from_counts(
    counts: DataFrame, cols: Sequence[str], outputs: Sequence[str], on_invalid: str = "error",
    label: str | None = None, label_order: str = "frequencyDesc", max_labels: int = MAX_LABELS,
    total: int | None = None,
) -> PipelineModel:
    """An index model per column from written value counts.

    Refuses vocabularies the driver should not hold; ``total`` is their size if known.
    """
    known = counts.where(F.col("name").isin(list(cols)) & F.col("value").isNotNull())
    if total is None:
        total = known.count()
    if total > max_labels:
        raise ValueError(f"{total} index labels exceed {max_labels}; index these columns by join")
    found = ordered_labels(known, cols, label, label_order)
    return PipelineModel(
        [
            StringIndexerModel.from_labels(
                found[c], c, out, "error" if c == label and on_invalid == "keep" else on_invalid
            )
            for c, out in zip(cols, outputs)
        ]
    )


def ordered_labels(
    counts: DataFrame, cols: Sequence[str], label: str | None = None,
    label_order: str = "frequencyDesc",
) -> dict[str, list[str]]:
    """Labels of each column in index order, brought to the driver; their number is checked before."""
    known = counts.where(F.col("name").isin(list(cols)) & F.col("value").isNotNull())
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in cols}
    for name, value, n in known.select("name", "value", "n").collect():
        frequency = 0 if name == label and label_order == "alphabetAsc" else -n
        found[name].append((frequency, value))
    return {c: [v for _, v in sorted(pairs)] for c, pairs in found.items()}


def _encoder_stages(wide: Sequence[str]) -> list:
    return [
        OneHotEncoder(
            inputCols=[f"{c}_idx" for c in wide], outputCols=[f"{c}_onehot" for c in wide]
        ),
        VectorAssembler(inputCols=[f"{c}_onehot" for c in wide], outputCol="wide_features_v"),
    ]


def build_pipeline(
    wide: Sequence[str], deep: Sequence[Deep], label: str = "click", on_invalid: str = "error",
    label_order: str = "frequencyDesc",
) -> Pipeline:
    """Index every column, one-hot the wide ones and assemble them.

    Appends ``<c>_idx`` and ``<c>_onehot`` for wide columns, ``<name>SEP<vocab>SEP<dim>`` for
    deep ones, ``wide_features_v`` and ``label``. ``on_invalid`` is what happens to NULL and
    unseen values: ``error``, ``skip`` the row, or ``keep`` them as one more value.
    """
    indexer = FrequencyIndexer(
        inputCols=[*wide, *[d.name for d in deep], label],
        outputCols=[*[f"{c}_idx" for c in wide], *[d.feature for d in deep], "label"],
        handleInvalid=on_invalid,
        labelCol=label,
        labelOrder=label_order,
    )
    return Pipeline(stages=[indexer, *_encoder_stages(wide)])


def fit_transform(
    df: DataFrame, pipeline: Pipeline, fit_on: str | DataFrame = "all", train: DataFrame | None = None
) -> DataFrame:
    """Fit the encoders and append all feature columns.

    ``fit_on='all'`` fits on the full table, ``'train'`` on ``train`` only.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on is 'all' or 'train', not {fit_on!r}")
    if fit_on == "train" and train is None:
        raise ValueError("fit_on='train' needs the training rows")
    return pipeline.fit(df if fit_on == "all" else train).transform(df)


@dataclass(frozen=True)
class Encoding:
    """Fitted encoders: short label lists looked up in place, vocabulary tables for the rest."""

    wide: list[str]
    widths: list[int]
    deep: list[Deep]
    label: str
    sizes: dict[str, int]
    labels: dict[str, list[str]]
    joined: DataFrame | None
    on_invalid: str
    broadcast_rows: int = BROADCAST_ROWS
    sizes_in_bytes: dict[str, int] = field(default_factory=dict)

    @property
    def wide_dim(self) -> int:
        """Width of the assembled vector, read from the fitted vocabularies."""
        return sum(self.widths)

    @property
    def spec(self) -> list[Deep]:
        """Deep columns with the rows their embedding tables need."""
        extra = 1 if self.on_invalid == "keep" else 0
        return [replace(d, vocab=max(self.sizes[d.name] + extra, d.vocab)) for d in self.deep]

    @property
    def joined_sizes(self) -> dict[str, int]:
        return {n: size for n, size in self.sizes.items() if n not in self.labels}

    def is_broadcast(self, name: str) -> bool:
        """Whether the vocabulary of a joined column is within the bounds of rows and bytes."""
        bytes_ = self.sizes_in_bytes.get(name, 0)
        return self.sizes[name] <= self.broadcast_rows and bytes_ <= BROADCAST_BYTES

    def index(self, df: DataFrame) -> DataFrame:
        """Append ``<column>__idx`` for every column and the label.

        A projection only, unless vocabularies are too large to be broadcast; those are looked up
        together.
        """
        indexed, found = df, {}
        large = [n for n in self.joined_sizes if not self.is_broadcast(n)]
        if large:
            names = F.array(*map(F.lit, large))
            at = F.array_position(names, F.col("name"))
            table = self.joined.where(F.col("name").isin(large)).select(
                F.array(*[F.lit(f"{n}__found") for n in large])[(at - 1).cast("int")].alias("name"),
                F.col("value").alias("key"), F.col("idx").alias("value"),
            )
            indexed = long_lookup(df, {f"{n}__found": col(n).cast("string") for n in large}, table, ROW_BYTES)
        for name, size in self.sizes.items():
            text = col(name).cast("string")
            if name in self.labels:
                known = F.from_json(F.lit(json.dumps(self.labels[name])), "array<string>")
                found[name] = F.nullif(F.array_position(known, text), F.lit(0)) - 1
            elif name in large:
                found[name] = col(f"{name}__found")
            else:
                table = self.joined.where(F.col("name") == name)
                indexed = rank_lookup(
                    indexed, text, table, "value", "idx", "idx", size, size, f"{name}__found"
                )
                found[name] = col(f"{name}__found")
        if self.on_invalid == "error":
            other = lambda n: F.raise_error(F.lit(f"NULL or unseen value in {n}"))
        else:  # a label has no further class
            missing = F.raise_error(F.lit(f"NULL or unseen value in {self.label}"))
            other = lambda n: missing if n == self.label else F.lit(self.sizes[n])
        if self.on_invalid == "skip":
            indexed = indexed.where(reduce(and_, [i.isNotNull() for i in found.values()]))
        return indexed.select(
            *[col(c) for c in df.columns],
            *[F.coalesce(i, other(n)).cast("int").alias(f"{n}__idx") for n, i in found.items()],
        )

    def transform(self, df: DataFrame) -> DataFrame:
        """Append ``slots`` (numbers of the wide slots that are 1), ``deep`` and ``label``, found
        as by ``index``."""
        indexed, index = self.index(df), {n: f"{n}__idx" for n in self.sizes}
        slots, start = [], 0
        for c, width in zip(self.wide, self.widths):
            slots.append(F.when(col(index[c]) < width, col(index[c]) + start))
            start += width
        return indexed.select(
            *[col(c) for c in df.columns],
            F.array_compact(F.array(*slots)).alias("slots"),
            F.array(*[col(index[d.name]) for d in self.deep]).alias("deep"),
            col(index[self.label]).cast("double").alias("label"),
        )


def count_sizes(counts: DataFrame) -> dict[str, tuple[int, bool]]:
    """(distinct values, has NULL) by column, from value counts."""
    rows = counts.groupBy("name").agg(
        F.count("value").alias("ndv"), F.max(F.col("value").isNull()).alias("has_null")
    )
    return {r["name"]: (r["ndv"], r["has_null"]) for r in rows.collect()}


def fit_encoding(
    counts: DataFrame, wide: Sequence[str], deep: Sequence[tuple[str, int]], label: str = "click",
    on_invalid: str = "error", label_order: str = "frequencyDesc",
    max_labels: int = MAX_INLINE_LABELS, sizes: dict[str, tuple[int, bool]] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> Encoding:
    """Fit from written value counts of all wide and deep columns and the label.

    ``deep`` holds (name, dim). Columns of up to ``max_labels`` values are looked up in place.
    Larger ones are indexed by join to their vocabulary, broadcast up to ``broadcast_rows`` and
    BROADCAST_BYTES.
    ``on_invalid`` is as in ``build_pipeline``.
    """
    if sizes is None:
        sizes = count_sizes(counts)
    used = list(dict.fromkeys([*wide, *[n for n, _ in deep], label]))
    number = {n: sizes.get(n, (0, False))[0] for n in used}
    small = [n for n in used if number[n] <= max_labels or n == label]
    large = [n for n in used if n not in small]
    extra = 1 if on_invalid == "keep" else 0
    widths = [number[c] + extra - 1 for c in wide]
    if min(widths, default=1) < 1:
        one = [c for c, w in zip(wide, widths) if w < 1]
        raise ValueError(f"columns with a single value cannot be one-hot encoded: {one}")
    joined, sizes_in_bytes = None, {}
    if large:
        largest = max(number[n] for n in large)
        joined = freeze(index_values(counts.where(F.col("name").isin(large)), largest=largest))
        taken = F.sum(F.octet_length("value") + ROW_BYTES).alias("bytes")
        sizes_in_bytes = {r["name"]: r["bytes"] for r in joined.groupBy("name").agg(taken).collect()}
    return Encoding(
        list(wide), widths, [Deep(n, sum(sizes.get(n, (0, False))), d) for n, d in deep], label,
        number, ordered_labels(counts, small, label, label_order), joined, on_invalid,
        broadcast_rows, sizes_in_bytes,
    )


def slot_vector(
    df: DataFrame, width: int, slots: str = "slots", name: str = "wide_features_v"
) -> DataFrame:
    """Add the sparse 0/1 vector of ``width`` from the numbers of its ones.

    The numbers are terms of a vocabulary that holds all of them, so the vector is made by the
    JVM and costs its ones, not its width."""
    terms = CountVectorizerModel.from_vocabulary([str(i) for i in range(width)], "__terms", name)
    named = df.withColumn("__terms", col(slots).cast("array<string>"))
    return terms.setBinary(True).transform(named).drop("__terms")


def vector_array(df: DataFrame, vector: str = "wide_features_v", name: str = "wide_features",
                 dtype: str = "float64") -> DataFrame:
    """Add the vector as an array."""
    return df.withColumn(name, vector_to_array(col(vector), dtype))


def wide_columns(df: DataFrame, width: int, array: str = "wide_features") -> DataFrame:
    """One column ``wide_feature_<i>`` per slot; an index past the array's end raises."""
    return df.select("*", *wide_slots(width, array)).drop(array)


def wide_slots(width: int, array: str = "wide_features") -> list:
    return [col(array)[i].alias(f"wide_feature_{i}") for i in range(width)]


def training_row(df: DataFrame, width: int, label: str, deep: Sequence[str]) -> DataFrame:
    """Wide slots, then the label, then the deep indexes: the order of the feature files."""
    return df.select(*wide_slots(width), col(label), *[col(d) for d in deep])


def dense_rows(
    df: DataFrame, width: int, spec: Sequence[Deep], keep: Sequence[str] = ()
) -> DataFrame:
    """The same order from ``slots``, ``deep`` and ``label``, after the columns of ``keep``."""
    table = vector_array(slot_vector(df, width, name="__vector"), "__vector", "__wide")
    return table.select(
        *[col(c) for c in keep], *wide_slots(width, "__wide"), "label",
        *[F.col("deep")[i].cast("double").alias(d.feature) for i, d in enumerate(spec)],
    )


def feature_names(width: int, deep: Sequence[Deep]) -> list[str]:
    return [*[f"wide_feature_{i}" for i in range(width)], "label", *[d.feature for d in deep]]


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace all column names by position."""
    return df.toDF(*names)


def cast_float(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column as 32-bit float except those in ``keep``."""
    return df.select(*[col(c) if c in keep else col(c).cast("float").alias(c) for c in df.columns])


def gathered(cols: Sequence[str], dtype: str) -> Column:
    """Many columns, cast to ``dtype``, as one array.

    The cast is a function over the array: with one cast for each column, hundreds of columns make
    a single method of generated code, too long for the JVM to compile, that is interpreted."""
    return F.transform(F.array(*[col(c) for c in cols]), lambda x: x.cast(dtype))


def group_arrays(df: DataFrame, width: int, deep: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the first ``width`` other columns as ``wide``, the named ones as ``deep``, label."""
    wide = [c for c in df.columns if c not in keep][:width]
    return df.select(
        *[col(c) for c in keep],
        gathered(wide, "float").alias("wide"),
        F.array(*[col(d).cast("int") for d in deep]).alias("deep"),
        "label",
    )


def active_slots(df: DataFrame, wide: str = "wide", name: str = "slots") -> DataFrame:
    """Replace an array of 0/1 by the positions of its ones."""
    ones = F.filter(F.transform(col(wide), lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    return df.withColumn(name, ones).drop(wide)
