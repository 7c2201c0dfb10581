"""The feature job: raw impressions to encoded rows in one counting scan and one projection."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickloom.operators import profile as pf
from clickloom.operators.encode import BROADCAST_ROWS, MAX_INLINE_LABELS, Encoding, count_sizes, fit_encoding
from clickloom.session import freeze, local_table

log = logging.getLogger(__name__)

# Deep columns and their embedding widths.
DEEP_DIMS = (
    ("device_model", 256), ("app_id", 256), ("site_id", 256), ("site_domain", 256),
    ("app_domain", 128),
)


@dataclass(frozen=True)
class Features:
    """Chosen columns, fitted encoders and the encoded rows."""

    selected: DataFrame
    encoding: Encoding
    rows: DataFrame


def count_candidates(
    df: DataFrame, also: Sequence[str], max_bins: int, sketches: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Written value counts of the columns that may become wide and of ``also``; the former.

    Columns that have too many values by a look at some rows or by sketches of all rows
    (``sketches`` if they are kept) are never grouped.
    """
    kept = pf.screen(df, pf.candidates(df), max_bins, sketches)
    cols = [n for n in df.columns if n in kept or n in also]
    return freeze(pf.value_counts(df, cols)), kept


def featurize(
    df: DataFrame, deep: Sequence[tuple[str, int]] = DEEP_DIMS, label: str = "click",
    max_bins: int = 100, on_invalid: str = "error", label_order: str = "frequencyDesc",
    fit_on: DataFrame | None = None, max_labels: int = MAX_INLINE_LABELS,
    broadcast_rows: int = BROADCAST_ROWS, sketches: DataFrame | None = None,
) -> Features:
    """Choose wide columns, fit the encoders on ``fit_on`` (default: all rows), encode ``df``.
    ``sketches`` are those of ``profile.sketch_files`` over the same rows, if they are kept."""
    source = df if fit_on is None else fit_on
    counts, kept = count_candidates(source, [n for n, _ in deep] + [label], max_bins, sketches)
    sizes = count_sizes(counts)
    rows = [
        (i, n, t, *sizes.get(n, (0, False))) for i, (n, t) in enumerate(source.dtypes) if n in kept
    ]
    profile = local_table(df.sparkSession, rows, pf.PROFILE_SCHEMA)
    selected = pf.select_wide(profile, max_bins, label)
    wide = [r["name"] for r in selected.orderBy("rank").collect()]
    dropped = [n for _, n, _, ndv, _ in rows if ndv < 2]
    if dropped:
        log.warning("columns with a single value left out: %s", dropped)
    encoding = fit_encoding(
        counts, wide, deep, label, on_invalid, label_order, max_labels, sizes, broadcast_rows
    )
    return Features(selected, encoding, encoding.transform(df))
