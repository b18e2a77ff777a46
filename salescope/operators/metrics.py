"""Forecast metrics as single aggregates over (actual, prediction) columns.

Each function returns one row per group (or one row) and runs as one pass
with map-side partial aggregation; predictions are never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _r2(y: Column, sse: Column, n: Column) -> Column:
    """1 - SSE / SST with SST = n * var_pop(y); constant target -> 1 when the
    fit is perfect, else 0 (the common library convention)."""
    sst = F.var_pop(y) * n
    return F.when(sst > 0, 1 - sse / sst).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))


def regression_metrics(df: DataFrame, actual: str | Column, pred: str | Column,
                       by: Sequence[str] = (), decimals: int | None = 4) -> DataFrame:
    y, p = _c(actual).cast("double"), _c(pred).cast("double")
    err = y - p
    sse = F.sum(err * err)
    n = F.count(F.lit(1))
    cols = {
        "MAE": F.avg(F.abs(err)), "MSE": F.avg(err * err),
        "RMSE": F.sqrt(F.avg(err * err)), "R2": _r2(y, sse, n),
    }
    out = df.groupBy(*by).agg(*[e.alias(k) for k, e in cols.items()])
    return _round(out, list(cols), decimals)


def sales_metrics(df: DataFrame, actual: str | Column, pred: str | Column,
                  by: Sequence[str] = (), decimals: int | None = 4) -> DataFrame:
    """RMSLE, MAE, RMSE, R2 after clipping the prediction at 0."""
    y = _c(actual).cast("double")
    p = F.greatest(_c(pred).cast("double"), F.lit(0.0))
    err = y - p
    lerr = F.log1p(y) - F.log1p(p)
    n = F.count(F.lit(1))
    cols = {
        "RMSLE": F.sqrt(F.avg(lerr * lerr)), "MAE": F.avg(F.abs(err)),
        "RMSE": F.sqrt(F.avg(err * err)), "R2": _r2(y, F.sum(err * err), n),
    }
    out = df.groupBy(*by).agg(*[e.alias(k) for k, e in cols.items()])
    return _round(out, list(cols), decimals)


def quantity_metrics(df: DataFrame, actual: str | Column, pred: str | Column,
                     lo: float, hi: float, by: Sequence[str] = (),
                     decimals: int | None = 4) -> DataFrame:
    """MAE, RMSE, R2 of the raw prediction plus MAE_rounded, Exact_Accuracy
    and Within_1_Accuracy of ``rint(clip(pred, lo, hi))``."""
    y, p = _c(actual).cast("double"), _c(pred).cast("double")
    r = F.rint(F.greatest(F.least(p, F.lit(float(hi))), F.lit(float(lo))))
    err = y - p
    n = F.count(F.lit(1))
    cols = {
        "MAE": F.avg(F.abs(err)), "RMSE": F.sqrt(F.avg(err * err)),
        "R2": _r2(y, F.sum(err * err), n),
        "MAE_rounded": F.avg(F.abs(y - r)),
        "Exact_Accuracy": F.avg((y == r).cast("double")),
        "Within_1_Accuracy": F.avg((F.abs(y - r) <= 1).cast("double")),
    }
    out = df.groupBy(*by).agg(*[e.alias(k) for k, e in cols.items()])
    return _round(out, list(cols), decimals)


def _round(df: DataFrame, cols: list[str], decimals: int | None) -> DataFrame:
    if decimals is None:
        return df
    return df.withColumns({c: F.round(c, decimals) for c in cols})


def metrics_row(df: DataFrame, actual: str, pred: str, label: dict, kind: str = "regression",
                **kw) -> DataFrame:
    """A metric row labelled with constant columns (variant, model, ...)."""
    fn = {"regression": regression_metrics, "sales": sales_metrics,
          "quantity": quantity_metrics}[kind]
    out = fn(df, actual, pred, **kw)
    return out.select(*[F.lit(v).alias(k) for k, v in label.items()], *out.columns)
