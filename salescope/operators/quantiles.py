"""Exact, linearly interpolated quantiles by radix selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a hot group (a third of the table) would land in one
task.  Here a double is turned into the 64-bit whole number with the same
order (its bit pattern, negative numbers turned round), and the wanted ranks
are found digit by digit, ``DIGITS`` bits at a time from the top:

1. rows are counted by (group, leading bits), combined map-side.  In the first
   round these are all rows, later only those whose leading bits hold a wanted
   rank; a hot group is one partial count a task for each of its digits;
2. over that small table the bucket of each rank is the first whose running
   sum passes it; the rank goes on inside the bucket.

After the last round a bucket is one value.  If there are about
``VALUES_AT_ONCE`` different values or fewer, one round counts them as they are:
more rounds would only be more jobs.  That estimate chooses the rounds; nothing
in the result is estimated, so a stage that is computed again after a lost
executor gives the same table.

Interpolation is the pandas / DuckDB ``quantile_cont`` rule between the
order statistics at ``floor(p (n-1))`` and the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bits of each round: sign, exponent and 8 bits of the fraction first.
DIGITS = (20, 22, 22)
#: Different values (of all groups) that one round counts, and that one task
#: can put in order if they are of one group.
VALUES_AT_ONCE = 1_000_000


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def ordered_bits(value: Column) -> Column:
    """A long in the order of the doubles (NaN last, as Spark sorts)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"),
                         F.when(value == 0, 0.0).otherwise(value)).cast("long")  # -0.0 is 0.0
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def exact_percentiles(df: DataFrame, value: str | Column, probs: Sequence[float],
                      by: str | Sequence[str] | None = None,
                      names: Sequence[str] | None = None,
                      digits: Sequence[int] | None = None, weight: str | None = None) -> DataFrame:
    """One row per group: ``by`` columns + one double column per probability.

    NULL values are ignored; a group with no non-NULL value is absent, and
    rows with a NULL group key drop out (pandas groupby semantics).  Up to three
    passes, so eager (like ``approxQuantile``): keys, one double and its bits
    are persisted meanwhile; the returned table has one row per group.
    ``digits``: the bits of each round, which add up to 64.  ``weight``: a
    whole-number column, the rows that a row stands for.
    """
    by = _keys(by)
    out_names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    v = F.col(value) if isinstance(value, str) else value
    keys = by or ["__g"]
    w = F.lit(1) if weight is None else F.col(weight)
    x = df.select(*by, v.cast("double").alias("__v"), w.cast("long").alias("__w")).where(F.col("__v").isNotNull())
    x = (x if by else x.withColumn("__g", F.lit(0))).dropna(subset=keys)
    x = x.select(*keys, "__v", ordered_bits(F.col("__v")).alias("__bits"), *["__w"][:weight is not None]).persist()
    digits = digits or ((64,) if _values(x, keys) <= VALUES_AT_ONCE else DIGITS)
    res = _selected(x, keys, [float(p) for p in probs], digits)
    res = res.select(*by, *[F.col("__q")[i].alias(n) for i, n in enumerate(out_names)]).persist()
    try:
        res.count()
    finally:
        x.unpersist()
    return res


def _values(x: DataFrame, keys: list[str]) -> int:
    """About how many different values the groups have together."""
    return x.agg(F.approx_count_distinct(F.xxhash64(*keys, "__bits")).alias("n")).first()["n"]


def _selected(x: DataFrame, keys: list[str], probs: list[float], digits: Sequence[int]) -> DataFrame:
    """keys + __q, the interpolated quantiles in the order of ``probs``."""
    rows_of = F.sum("__w") if "__w" in x.columns else F.count(F.lit(1))
    sizes = x.groupBy(*keys).agg(rows_of.alias("__n"))
    at = F.posexplode(F.lit(probs)).alias("__i", "__p")
    wanted = sizes.select(*keys, "__n", at)
    pos = F.col("__p") * (F.col("__n") - 1)
    both = F.explode(F.array(F.floor(pos), F.least(F.floor(pos) + 1, F.col("__n") - 1)))
    ranks = wanted.select(*keys, both.alias("__rank")).distinct().select(
        *keys, F.lit(0).cast("long").alias("__bucket"), "__rank", F.col("__rank").alias("__left"))
    rows, shift = x.withColumn("__bucket", F.lit(0).cast("long")), 64
    for digit in digits:
        shift -= digit
        nxt = rows.withColumn("__next", F.shiftright("__bits", shift))
        counts = nxt.groupBy(*keys, "__bucket", "__next").agg(rows_of.alias("__k"), F.max("__v").alias("__v"))
        ranks = _next_bucket(counts, ranks, keys)
        if shift:
            live = ranks.select(*keys, F.col("__next").alias("__bucket")).distinct()
            rows = x.withColumn("__bucket", F.shiftright("__bits", shift)).join(live, [*keys, "__bucket"], "left_semi")
            ranks = ranks.select(*keys, F.col("__next").alias("__bucket"), "__rank", "__left")
    low, high = [ranks.select(*[F.col(k).alias(f"{k}__{s}") for k in keys], F.col("__rank").alias(f"__r{s}"),
                              F.col("__v").alias(f"__v{s}")) for s in "01"]
    same = lambda s: [F.col(k) == F.col(f"{k}__{s}") for k in keys]
    first, last = F.floor(pos), F.least(F.floor(pos) + 1, F.col("__n") - 1)
    got = wanted.join(low, [*same("0"), first == F.col("__r0")]).join(high, [*same("1"), last == F.col("__r1")])
    part = pos - first
    value = F.when(part == 0, F.col("__v0")).otherwise(F.col("__v0") + (F.col("__v1") - F.col("__v0")) * part)
    listed = F.array_sort(F.collect_list(F.struct("__i", value.alias("q"))))  # one a probability
    return got.groupBy(*keys).agg(listed["q"].alias("__q"))


def _next_bucket(counts: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Each rank (``__left`` counted from its bucket's first row) with the
    ``__next`` bucket that holds it and the place ``__left`` in that."""
    order = Window.partitionBy(*keys, "__bucket").orderBy("__next")
    ends = counts.withColumn("__end", F.sum("__k").over(order))
    # buckets and ranks on one line, from the top: the last bucket seen that
    # ends above a rank is the one that holds it (at equal places it is not)
    line = ends.select(*keys, "__bucket", F.col("__end").alias("__at"), F.lit(1).alias("__kind"),
                       F.lit(None).cast("long").alias("__rank"),
                       F.struct("__next", (F.col("__end") - F.col("__k")).alias("start"), "__v").alias("__of"))
    line = line.unionByName(ranks.select(*keys, "__bucket", F.col("__left").alias("__at"), F.lit(0).alias("__kind"),
                                         "__rank"), allowMissingColumns=True)
    down = Window.partitionBy(*keys, "__bucket").orderBy(F.desc("__at"), "__kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return line.withColumn("__of", F.last("__of", ignorenulls=True).over(down)).where("__kind = 0").select(
        *keys, "__bucket", "__rank", (F.col("__at") - F.col("__of.start")).alias("__left"), "__of.__next", "__of.__v")


def weighted_percentiles(values: np.ndarray, counts: np.ndarray, probs: Sequence[float]) -> np.ndarray:
    """The same of the different values of one group and how often each is there."""
    order = np.argsort(values)
    values, ends = values[order], np.cumsum(counts[order])
    pos = np.array(probs) * (ends[-1] - 1)
    low = np.floor(pos)
    a, b = [values[np.searchsorted(ends, np.minimum(r, ends[-1] - 1), side="right")] for r in (low, low + 1)]
    part = pos - low
    return np.where(part == 0, a, a + (b - a) * part)


def exact_median(df: DataFrame, value: str | Column, by=None, name: str = "median") -> DataFrame:
    return exact_percentiles(df, value, [0.5], by, [name])
