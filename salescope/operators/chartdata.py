"""Tables behind the charts, computed on the whole table.

Bins, box statistics, regression lines and densities are aggregates, so the
cluster reduces the data and only a chart-sized table leaves it.  Scalars
needed to place bins (min, max, n) are one small aggregate each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.joins import sized_broadcast
from salescope.operators.quantiles import exact_percentiles


def _scalars(df: DataFrame, **aggs: Column):
    return df.agg(*[e.alias(k) for k, e in aggs.items()]).first()


def _finite(df: DataFrame, value: Column) -> DataFrame:
    """The column ``v`` of values that have a place on an axis."""
    v = value.cast("double")
    return df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), every bin
    listed, with counts and density (count / (n * width)).  NULL, NaN and
    infinite values are left out; if all values are equal the bins go from half
    below to half above; no value: an empty table."""
    x = _finite(df, value)
    s = _scalars(x, lo=F.min("v"), hi=F.max("v"), n=F.count(F.lit(1)))
    lo, hi, n = s["lo"], s["hi"], s["n"]
    spark = df.sparkSession
    if n == 0:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long, density double")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = x.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = spine.join(counts, "bin", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select(
        "bin",
        F.round(F.lit(lo) + F.col("bin") * F.lit(hi - lo) / bins, 4).alias("bin_start"),
        F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(hi - lo) / bins, 4).alias("bin_end"),
        F.col("count").cast("long").alias("count"),
        F.round(F.col("count") / F.lit(n * width), 10).alias("density"))


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, 1.5 IQR whisker ends, outlier count per group."""
    keyed = df.select(group, F.col(value).cast("double").alias("v")) \
              .where(F.col(group).isNotNull() & F.col("v").isNotNull())
    q = exact_percentiles(keyed, "v", [0.25, 0.5, 0.75], by=group, names=["q1", "median", "q3"])
    j = keyed.join(sized_broadcast(q), group)
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    out = j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(F.col("v") >= low, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= high, F.col("v"))).alias("whisker_high"),
        F.count_if((F.col("v") < low) | (F.col("v") > high)).alias("outliers"),
        F.count(F.lit(1)).alias("count"))
    return out.select(group, *[F.round(c, 3).alias(c) for c in
                               ("q1", "median", "q3", "whisker_low", "whisker_high")],
                      "outliers", "count")


def reg_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line y = slope * x + intercept over all pairs."""
    return df.agg(F.round(F.regr_slope(F.col(y), F.col(x)), 6).alias("slope"),
                  F.round(F.regr_intercept(F.col(y), F.col(x)), 4).alias("intercept"),
                  F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()).alias("n"))


def scaled_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """z-scores with the population standard deviation; 0 for the values of a
    constant column."""
    aggs = {}
    for c in cols:
        aggs[f"m_{c}"] = F.avg(c)
        aggs[f"s_{c}"] = F.stddev_pop(c)
    s = _scalars(df, **aggs)
    return df.select(*keys, *[F.round((F.col(c) - F.lit(s[f"m_{c}"])) / F.lit(s[f"s_{c}"] or 1.0), 6)
                              .alias(f"{c}_z") for c in cols])


def pred_vs_actual(df: DataFrame, actual: str, pred: str, keys: Sequence[str]) -> DataFrame:
    s = _scalars(df, m=F.max(F.greatest(F.col(actual), F.col(pred))))
    return df.select(*keys, F.round(actual, 4).alias("actual"), F.round(pred, 4).alias("predicted"),
                     F.round(F.col(actual) - F.col(pred), 4).alias("residual"),
                     F.round(F.lit(s["m"]), 4).alias("axis_max"))


def epsilon_tube(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """Share of rows within +/- MAE of the y = x line, and the band ends."""
    err = F.abs(F.col(actual) - F.col(pred))
    mae = _scalars(df, mae=F.avg(err))["mae"]
    return df.agg(F.round(F.lit(mae), 4).alias("epsilon"),
                  F.round(F.avg((err <= F.lit(mae)).cast("double")), 6).alias("inside_share"),
                  F.round(F.min(actual), 4).alias("band_start"),
                  F.round(F.max(actual), 4).alias("band_end"))


def _placed(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pairs ``x, y`` of which both have a place on an axis."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(ok("x") & ok("y"))


def bin2d(df: DataFrame, x: str, y: str, bins: int = 40) -> DataFrame:
    """2-D counts on a shared square grid.  Pairs with a NULL, NaN or infinite
    value are left out; equal values all lie in cell 0; no pair: no row."""
    p = _placed(df, x, y)
    s = _scalars(p, lo=F.least(F.min("x"), F.min("y")), hi=F.greatest(F.max("x"), F.max("y")))
    lo = s["lo"] or 0.0
    width = ((s["hi"] or 0.0) - lo) / bins or 1.0

    def cell(c):
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    return p.groupBy(cell("x").alias("x_bin"), cell("y").alias("y_bin")).agg(F.count(F.lit(1)).alias("count"))


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 40) -> DataFrame:
    """Counts by hexagon, ``gridsize`` of them across: ``x, y`` (a hexagon's
    centre), ``count``, hexagons without a row left out.

    The centres are two rectangular lattices, the second half a step off in
    both directions; a row belongs to the nearer of the two centres around it
    (the second one in ties).  Pairs with a NULL, NaN or infinite value are
    left out; an axis whose values are all equal has one column or row of
    hexagons; no pair: no row."""
    p = _placed(df, x, y)
    s = _scalars(p, x0=F.min("x"), x1=F.max("x"), y0=F.min("y"), y1=F.max("y"))
    across, up = gridsize, int(gridsize / math.sqrt(3))
    x0, y0 = s["x0"] or 0.0, s["y0"] or 0.0
    sx = ((s["x1"] or 0.0) - x0) / across or 1.0
    sy = ((s["y1"] or 0.0) - y0) / up or 1.0
    placed = p.select(((F.col("x") - F.lit(x0)) / F.lit(sx)).alias("ix"), ((F.col("y") - F.lit(y0)) / F.lit(sy)).alias("iy"))
    near = lambda c: F.floor(F.col(c) + 0.5)  # noqa: E731  the lattice's nearest line
    mid = lambda c: F.floor(c) + 0.5  # noqa: E731  the other's
    far = lambda of: F.pow(F.col("ix") - of("ix"), 2) + 3 * F.pow(F.col("iy") - of("iy"), 2)
    first = far(near) < far(mid)
    centre = placed.groupBy(F.when(first, near("ix")).otherwise(mid("ix")).alias("cx"),
                            F.when(first, near("iy")).otherwise(mid("iy")).alias("cy")).agg(
        F.count(F.lit(1)).alias("count"))
    return centre.select((F.lit(x0) + F.col("cx") * F.lit(sx)).alias("x"),
                         (F.lit(y0) + F.col("cy") * F.lit(sy)).alias("y"), "count")


#: Boxes of the density are this many bandwidths wide; with so many Hermite
#: terms a box's error is below 1e-15 of its weight.  Kernels end here.
BOX, TERMS, REACH = 1.0, 20, 10.0


def kde(df: DataFrame, value: Column, points: int = 300, lo_q: float = 0.005, hi_q: float = 0.995) -> DataFrame:
    """Gaussian KDE on ``points`` grid points between two quantiles.

    Bandwidth by Scott's rule (n^-1/5 x sample std).  A fast Gauss transform:
    the axis is cut into boxes of a bandwidth, a box keeps ``TERMS`` moments of
    its values about its middle (sums, combined map-side: what leaves a task is
    a row a box), and its kernels are summed from these at the grid points
    within ``REACH`` bandwidths.  NULL, NaN and infinite values are left out;
    fewer than two different values have no bandwidth: an empty table."""
    x = _finite(df, value)
    s = _scalars(x, n=F.count(F.lit(1)), sd=F.stddev_samp("v"), lo=F.min("v"), hi=F.max("v"))
    if not s["n"] or s["lo"] == s["hi"]:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    q = exact_percentiles(x, "v", [lo_q, hi_q], names=["a", "b"]).first()
    h = s["sd"] * s["n"] ** (-0.2)
    a, step = q["a"], (q["b"] - q["a"]) / (points - 1)
    box = F.floor((F.col("v") - F.lit(a)) / F.lit(h * BOX))
    middle = F.lit(a) + (F.col("box") + 0.5) * F.lit(h * BOX)
    t = (F.col("v") - middle) / F.lit(h * math.sqrt(2))
    terms = x.withColumn("box", box).withColumn("t", t).groupBy("box").agg(*[
        F.sum(F.pow("t", F.lit(k)) / math.factorial(k)).alias(f"m{k}") for k in range(TERMS)])
    # grid points that the box reaches
    first = F.greatest(F.ceil((middle - F.lit(a + REACH * h)) / F.lit(step or 1.0)), F.lit(0))
    last = F.least(F.floor((middle - F.lit(a - REACH * h)) / F.lit(step or 1.0)), F.lit(points - 1))
    near = terms.select(F.array(*[f"m{k}" for k in range(TERMS)]).alias("m"), middle.alias("middle"),
                        first.alias("first"), last.alias("last")).where("first <= last").withColumn(
        "i", F.explode(F.sequence("first", "last")))
    u = (F.lit(a) + F.col("i") * F.lit(step) - F.col("middle")) / F.lit(h * math.sqrt(2))
    # Hermite functions: h_0 = exp(-u^2), h_{k+1} = 2 u h_k - 2 k h_{k-1}
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("before"), F.exp(-F.col("u") * F.col("u")).alias("now"),
                     F.lit(0.0).alias("k"))
    series = F.aggregate("m", start, lambda s, m: F.struct(
        (s["sum"] + m * s["now"]).alias("sum"), s["now"].alias("before"),
        (2.0 * F.col("u") * s["now"] - 2.0 * s["k"] * s["before"]).alias("now"), (s["k"] + 1.0).alias("k")),
        lambda s: s["sum"])
    norm = 1.0 / (s["n"] * h * math.sqrt(2 * math.pi))
    sums = near.withColumn("u", u).groupBy("i").agg(F.sum(series).alias("k"))
    spine = df.sparkSession.range(points).select(F.col("id").cast("int").alias("at"))
    return spine.join(sums, F.col("at") == F.col("i"), "left").select(
        F.col("at").alias("i"), (F.lit(a) + F.col("at") * F.lit(step)).alias("x"),
        (F.coalesce("k", F.lit(0.0)) * F.lit(norm)).alias("density")).orderBy("i")


def plotting_positions(points: int) -> list[float]:
    """Filliben's plotting positions."""
    m = points
    return [1 - 0.5 ** (1 / m)] + [(i - 0.3175) / (m + 0.365) for i in range(2, m)] + [0.5 ** (1 / m)]


def qq_points(df: DataFrame, value: Column, points: int = 500) -> DataFrame:
    """Sample quantiles against standard normal quantiles (probability plot).

    Probabilities follow Filliben's plotting positions on ``points`` levels;
    the normal quantiles for those levels are computed on the driver (they
    depend on ``points`` only)."""
    probs = plotting_positions(points)
    names = [f"q{i}" for i in range(points)]
    x = df.select(value.cast("double").alias("v"))
    row = exact_percentiles(x, "v", probs, names=names)
    nd = NormalDist()
    theo = [nd.inv_cdf(p) for p in probs]
    pairs = F.arrays_zip(F.lit(theo).alias("theoretical"),
                         F.array(*[F.col(n) for n in names]).alias("sample"))
    return row.select(F.posexplode(pairs).alias("i", "p")) \
              .select(F.col("i").cast("int"), F.col("p.theoretical").alias("theoretical"),
                      F.col("p.sample").alias("sample"))
