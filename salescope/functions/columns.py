"""Scalar column expressions of the feature and diagnostics code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Promotion buckets are right-closed intervals
# (-1, 0], (0, 5], (5, 20], (20, max] with these labels, in this order.
PROMO_LABELS = ("0", "1-5", "6-20", "20+")


def promo_bucket(c: str | Column) -> Column:
    x = _c(c)
    return (F.when(x.isNull(), None)
             .when(x <= 0, PROMO_LABELS[0]).when(x <= 5, PROMO_LABELS[1])
             .when(x <= 20, PROMO_LABELS[2]).otherwise(PROMO_LABELS[3]))


def log1p_target(c: str | Column) -> Column:
    return F.log1p(_c(c))


def expm1_clip(c: str | Column) -> Column:
    """Back-transform of a log1p model output, clipped at 0."""
    return F.greatest(F.expm1(_c(c)), F.lit(0.0))


def clip0(c: str | Column) -> Column:
    return F.greatest(_c(c), F.lit(0.0))


def clip_range(c: str | Column, lo: float, hi: float) -> Column:
    return F.greatest(F.least(_c(c), F.lit(hi)), F.lit(lo))


def residual(actual: str | Column, predicted: str | Column) -> Column:
    return _c(actual) - _c(predicted)


def abs_error(actual: str | Column, predicted: str | Column) -> Column:
    return F.abs(_c(actual) - _c(predicted))


def rounded_quantity(pred: str | Column, lo: str | Column | float, hi: str | Column | float) -> Column:
    """``rint(clip(pred, lo, hi))`` (half to even)."""
    lo_c = lo if isinstance(lo, Column) else (F.col(lo) if isinstance(lo, str) else F.lit(float(lo)))
    hi_c = hi if isinstance(hi, Column) else (F.col(hi) if isinstance(hi, str) else F.lit(float(hi)))
    return F.rint(F.greatest(F.least(_c(pred), hi_c), lo_c))


def interaction(a: str | Column, b: str | Column) -> Column:
    return _c(a) * _c(b)


# Names of the two order-revenue variants and what sets them apart.
VARIANT_WITH_QUANTITY = "Model_A_With_Quantity"
VARIANT_NO_QUANTITY = "Model_B_No_Quantity"
VARIANT_NOTES = {
    VARIANT_WITH_QUANTITY: "Uses Quantity; leaks the target formula, upper bound only",
    VARIANT_NO_QUANTITY: "No Quantity; realistic forecast before the order is known",
}


def variant_note(c: str | Column) -> Column:
    """The note of a variant; an unknown variant is an error, NULL stays NULL."""
    x = _c(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for k, v in VARIANT_NOTES.items():
        expr = expr.when(x == k, v)
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown model variant: "), x)).cast("string"))
