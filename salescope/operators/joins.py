"""Equi joins of the analytics plans.

All joins in this domain pair a large fact side with a small keyed side
(store attributes, a daily oil/holiday table, per-category lookups).  The
small side is broadcast only after its row count is checked against a bound;
above the bound the join is left to the planner (sort-merge or AQE's runtime
broadcast), so a lookup that unexpectedly grows never lands whole in every
executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side that is broadcast on our decision: rows, and bytes of its rows.
# Lookup tables keyed by category-like columns or by calendar day stay far
# below both.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if ``df`` is within both bounds, else ``df``.

    The planner's estimate of the bytes proves it without a job where it knows
    them (a kept table); otherwise the rows and the bytes of their values are
    counted, up to the bound on rows.
    """
    known = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if known <= max_bytes // 8:
        return F.broadcast(df)
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t == "string"]
    width = sum(texts, F.lit(16 * (len(df.columns) + 1)))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return F.broadcast(df) if row["n"] <= max_rows and (row["b"] or 0) <= max_bytes else df


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join a fact table with a small keyed table (size-checked broadcast)."""
    return big.join(sized_broadcast(small, max_rows), on=on, how=how)


def apply_lookup(df: DataFrame, lookup: DataFrame, key: str, features: dict[str, float],
                 source_col: str | None = None) -> DataFrame:
    """``source.map(mapping).fillna(default)`` for several features of one key.

    ``lookup`` has the key column plus one column per feature; ``features``
    maps feature name -> default for keys absent from the lookup (or NULL).
    """
    src = source_col or key
    lk = lookup.select(F.col(key).alias("__lk_key"), *features.keys())
    out = df.join(sized_broadcast(lk), F.col(src) == F.col("__lk_key"), "left").drop("__lk_key")
    return out.withColumns({name: F.coalesce(F.col(name), F.lit(float(default)))
                            for name, default in features.items()})


def split_by_id(df: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows of ``df`` whose id occurs in ``ids`` (left semi join)."""
    return df.join(ids.select(id_col), on=id_col, how="left_semi")


def holiday_flag(df: DataFrame, date_col: str, holiday_dates: DataFrame,
                 flag: str = "is_holiday_date") -> DataFrame:
    """Mark rows whose date is in a set of dates (distinct dates, left join)."""
    dates = holiday_dates.select(F.col(holiday_dates.columns[0]).alias("__hd")).distinct() \
        .withColumn("__hit", F.lit(True))
    return (df.join(sized_broadcast(dates), F.col(date_col) == F.col("__hd"), "left")
              .withColumn(flag, F.col("__hit").isNotNull())
              .drop("__hd", "__hit"))


def restrict_to_top(df: DataFrame, top: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Keep rows whose key is in a top-k table (left semi join)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(sized_broadcast(top.select(*keys)), on=keys, how="left_semi")
