"""Column expressions: hour text, feature crosses, sigmoid, ReLU, logistic loss."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.session import col


def hour_text(hour: Column) -> Column:
    """Two-digit hour of an integer YYMMDDHH; a leading zero is kept."""
    return F.substr(hour.cast("string"), F.lit(7))


def cross_value(left: str, right: str, sep: str = "") -> Column:
    """Both values as one text; NULL if either side is NULL."""
    parts = [col(left).cast("string"), col(right).cast("string")]
    if sep:
        parts.insert(1, F.lit(sep))
    return F.concat(*parts)


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit.cast("double")))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def logistic_loss(logit: Column, label: Column) -> Column:
    """Binary cross-entropy of one row, from the logit, without overflow."""
    x = logit.cast("double")
    return relu(x) - x * label.cast("double") + F.log1p(F.exp(-F.abs(x)))
