"""Window operators.

Per-series windows (lags, shifted rolling means) partition by the series key
of a complete (date x series) panel, so a partition holds at most one row per
calendar day of that series, whatever the skew of the raw rows.  Windows
without a partition key are only used on tables with one row per calendar
day (daily totals, the oil price table) or on an already limited top-n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Horizon-safe lags and rolling windows of the store model.
LAGS = (16, 28, 364)
ROLLING = (7, 28, 56)
SHIFT = 16


def lag_feature_columns(lags: Sequence[int] = LAGS, rolling: Sequence[int] = ROLLING,
                        shift: int = SHIFT) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"rolling_mean_{n}_shift{shift}" for n in rolling]


def add_lag_features(panel: DataFrame, keys: Sequence[str] = ("store_nbr", "family"),
                     date_col: str = "date", target: str = "sales",
                     lags: Sequence[int] = LAGS, rolling: Sequence[int] = ROLLING,
                     shift: int = SHIFT) -> DataFrame:
    """lag_k = value k rows earlier in the series; rolling_mean_n_shift16 =
    mean of the n rows ending ``shift`` rows earlier (NULLs skipped, at least
    one value).  All columns share one window specification, so the panel is
    shuffled and sorted once."""
    w = Window.partitionBy(*keys).orderBy(date_col)
    cols = {f"lag_{k}": F.lag(target, k).over(w) for k in lags}
    for n in rolling:
        cols[f"rolling_mean_{n}_shift{shift}"] = F.avg(target).over(
            w.rowsBetween(-(shift + n - 1), -shift))
    return panel.withColumns(cols)


def rolling_daily(daily: DataFrame, date_col: str, value: str,
                  windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Trailing means over a one-row-per-day table (min_periods = 1)."""
    w = Window.orderBy(date_col)
    return daily.withColumns({f"rolling_{n}": F.avg(value).over(w.rowsBetween(-(n - 1), 0))
                              for n in windows})


def ffill_bfill(df: DataFrame, date_col: str, value: str, out: str | None = None) -> DataFrame:
    """Forward fill then backward fill over a one-row-per-date table."""
    w = Window.orderBy(date_col)
    fwd = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    bwd = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(out or value, F.coalesce(fwd, bwd))


def best_by(df: DataFrame, partition: str | Sequence[str], metric: str,
            tie: str | None = None) -> DataFrame:
    """Row with the smallest metric per partition; ``tie`` (e.g. the listing
    order) breaks ties so the first listed wins."""
    parts = [partition] if isinstance(partition, str) else list(partition)
    order = [F.col(metric).asc()] + ([F.col(tie).asc()] if tie else [])
    w = Window.partitionBy(*parts).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def head_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows in a total order (distributed top-n, no full sort)."""
    return df.orderBy(*order).limit(n)


def ordered_head(df: DataFrame, order: Sequence[str], n: int, rank_col: str = "n") -> DataFrame:
    """First n rows with their position; the rank window runs on n rows."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


#: Hex digits of the hash by which rows are counted in each round.
HASH_DIGITS = (4, 8, 12)


def hash_sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows chosen by a seeded hash (MD5 of the key's text) of a unique key:
    reproducible across runs and engines.

    The n-th smallest hash is found by counting: rows by the leading digits of
    their hash (at most 65,536 counts a round), then inside the digits in which
    the n-th lies.  The sample is then a filter on the hash, which no task has
    to gather; only rows that agree in all counted digits are put in order.
    A table of at most n rows is returned whole."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    rows = df.withColumn("__h", h)
    prefix, left = "", n
    for digits in HASH_DIGITS:
        head = F.substring("__h", 1, digits)
        inside = rows.where(F.substring("__h", 1, len(prefix)) == prefix) if prefix else rows
        counts = inside.groupBy(head.alias("p")).agg(F.count(F.lit(1)).alias("c")).toArrow().sort_by("p").to_pylist()
        for r in counts:
            if r["c"] >= left:
                prefix, count = r["p"], r["c"]
                break
            left -= r["c"]
        else:
            return rows.drop("__h")  # no more than n rows in all
        if count == left:
            return rows.where(F.substring("__h", 1, digits) <= prefix).drop("__h")
    ties = rows.where(head == prefix).orderBy("__h", *key).limit(left)
    return rows.where(head < prefix).unionByName(ties).drop("__h")
