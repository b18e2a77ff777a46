"""Sparse normal equations from grouped sums, and the solvers on them.

The Gram matrix of [1, numeric columns, one-hot columns, label] is never built
from vectors: numeric by numeric entries are matrix products of batches, numeric by
category entries are sums grouped by the category's value, category by
category entries are counts of pairs of values.  All of it is combined
map-side; an entry that is 0 is no row.  The entries (``a, b,
value`` by name) go to the driver once the width has been checked against
``MAX_WIDTH``, and serve every penalty: least squares, ridge, and the lasso by
coordinate descent with a duality gap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widest system that is put together on the driver (8 bytes a cell).
MAX_WIDTH = 4096
ONE = "1"


def category_name(column: str, value: str) -> str:
    return f"{column}={value}"


def sparse_gram(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str) -> DataFrame:
    """``(a, b, value)``: sums over ``rows`` of the products of every two
    columns of [1, numeric, one-hot, label], each pair once, entries that are 0
    left out.  Numeric columns and the label must not hold NULLs; a NULL
    category is in no one-hot column.  An empty table gives no entry."""
    numbers = [ONE, *numeric, label]
    x = {n: F.lit(1.0) if n == ONE else F.col(f"`{n}`").cast("double") for n in numbers}
    out = _numeric_entries(rows.select(*[F.coalesce(x[n], F.lit(0.0)).alias(f"x{i}") for i, n in enumerate(numbers)]),
                           numbers)
    if categorical:
        name = {c: F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")) for c in categorical}
        each = rows.select(*[x[n].alias(f"x{i}") for i, n in enumerate(numbers)],
                           F.explode(F.array(*name.values())).alias("a")).where("a is not null")
        by_value = each.groupBy("a").agg(*[F.sum(f"x{i}").alias(f"x{i}") for i in range(len(numbers))])
        out = out.union(by_value.select("a", F.inline(F.array(*[
            F.struct(F.lit(n).alias("b"), F.col(f"x{i}").alias("value")) for i, n in enumerate(numbers)]))))
        out = out.union(by_value.select("a", F.col("a").alias("b"), F.col("x0").alias("value")))
        two = [F.struct(name[c].alias("a"), name[d].alias("b")) for i, c in enumerate(categorical)
               for d in categorical[i + 1:]]
        if two:
            met = rows.select(F.inline(F.array(*two))).where("a is not null and b is not null")
            out = out.union(met.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("value")))
    return out.where("value <> 0")


def _numeric_entries(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sums of products of every two columns: a matrix product a batch (as
    one aggregate they are hundreds of sums, too much code to be compiled), a
    row a pair and task, added up."""
    first, second = np.triu_indices(len(names))

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(names), len(names)))
        for batch in batches:
            z = batch.to_numpy(np.float64)
            total += z.T @ z
        yield pd.DataFrame({"i": first, "j": second, "value": total[first, second]})

    summed = values.mapInPandas(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    name = F.lit(list(names))
    return summed.select(F.get(name, "i").alias("a"), F.get(name, "j").alias("b"), "value")


@dataclass
class LinearFit:
    coef: np.ndarray
    intercept: float

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        from salescope.operators.models import dot
        return df.withColumn(out, dot(features, self.coef, self.intercept))


@dataclass
class LassoFit(LinearFit):
    """``gap``: the duality gap at which the descent ended, as a share of the
    label's variance (an upper bound of what the objective is above its least
    value)."""
    gap: float


@dataclass
class GramSystem:
    """Sums over all rows of the products of [1, x, y]."""
    gram: np.ndarray

    def without(self, places: Sequence[int]) -> "GramSystem":
        """The system without the columns at these places of [1, x, y]."""
        return GramSystem(np.delete(np.delete(self.gram, places, 0), places, 1))

    def solve(self, alpha: float = 0.0, fit_intercept: bool = True) -> LinearFit:
        """argmin |y - Xw - b|^2 + alpha |w|^2 (intercept not penalised); of
        several least-squares solutions the one of least length."""
        first = 0 if fit_intercept else 1
        xtx, xty = self.gram[first:-1, first:-1], self.gram[first:-1, -1]
        penalty = alpha * np.eye(len(xtx))
        if fit_intercept:
            penalty[0, 0] = 0.0
        w = np.linalg.pinv(xtx + penalty, rcond=1e-13, hermitian=True) @ xty
        return LinearFit(w[1:], float(w[0])) if fit_intercept else LinearFit(w, 0.0)

    def lasso(self, alpha: float, tol: float = 1e-8, max_steps: int = 20_000) -> LassoFit:
        """argmin 1/(2n) |y - Xw - b|^2 + alpha |w|_1.

        Starts with sweeps of coordinate descent: the gradient X'r is kept up
        to date (covariance updates), so a step costs one row of the Gram
        matrix and never a pass over the data.  Collinear columns, which one-hot
        blocks are full of, would need very many sweeps from there on; an
        active set goes on instead.  The equations of the nonzero coordinates
        with their signs are solved directly, and the solution moves towards
        that until a coordinate comes to 0, which then leaves; once none does,
        the coordinate of the steepest slope beyond the penalty joins.  Ends
        when the duality gap is below ``tol`` times the variance of y; an error
        otherwise.  ``alpha`` 0: least squares."""
        n, mean = self.gram[0, 0], self.gram[0, 1:] / max(self.gram[0, 0], 1.0)
        if not n:
            return LassoFit(np.zeros(len(mean) - 1), 0.0, 0.0)
        if not alpha:
            plain = self.solve()
            return LassoFit(plain.coef, plain.intercept, 0.0)
        centred = self.gram[1:, 1:] - n * np.outer(mean, mean)
        g, xy, yy = centred[:-1, :-1], centred[:-1, -1], centred[-1, -1]
        limit = alpha * n
        usable = np.flatnonzero(np.diag(g) > 1e-12 * np.diag(self.gram)[1:-1])  # not constant
        w = np.zeros(len(xy))
        w[usable] = _active_set(g[np.ix_(usable, usable)], xy[usable], limit, tol, max_steps,
                                lambda v, slope: _gap(v, slope, xy[usable], yy, limit, n))
        slope = xy[usable] - g[np.ix_(usable, usable)] @ w[usable]
        gap = _gap(w[usable], slope, xy[usable], yy, limit, n)
        if not gap <= tol:
            raise RuntimeError(f"lasso did not converge: a gap of {gap:.2g} after {max_steps} steps")
        return LassoFit(w, float(mean[-1] - mean[:-1] @ w), max(gap, 0.0))


def _gap(w: np.ndarray, slope: np.ndarray, xy: np.ndarray, yy: float, limit: float, n: float) -> float:
    """What the objective at ``w`` is above its least value, at most, as a share
    of the variance of y; ``slope`` is X'r."""
    cross = w @ xy
    rest, with_y = yy - 2 * cross + w @ (xy - slope), yy - cross
    worst = np.abs(slope).max(initial=0.0)
    s = 1.0 if worst <= limit else limit / worst
    primal = rest / 2 + limit * np.abs(w).sum()
    return float((primal - s * with_y + s * s * rest / 2) / (yy if yy > 0 else 1.0))


def _sweeps(g: np.ndarray, xy: np.ndarray, limit: float, number: int) -> np.ndarray:
    """Coordinate descent from 0."""
    w, slope, diagonal = np.zeros(len(xy)), xy.copy(), np.diag(g)
    for _ in range(number):
        for j in range(len(w)):
            at = slope[j] + diagonal[j] * w[j]
            now = np.sign(at) * max(abs(at) - limit, 0.0) / diagonal[j]
            if now != w[j]:
                slope -= g[j] * (now - w[j])
                w[j] = now
    return w


def _active_set(g: np.ndarray, xy: np.ndarray, limit: float, tol: float, max_steps: int, gap) -> np.ndarray:
    w = _sweeps(g, xy, limit, 30)
    sign = np.sign(w)
    for step in range(max_steps):
        on = np.flatnonzero(sign)
        settled = True
        if len(on):
            want = xy[on] - limit * sign[on]
            inner = g[np.ix_(on, on)]
            try:
                goal = np.linalg.solve(inner, want)
            except np.linalg.LinAlgError:
                goal = np.full(len(on), np.nan)
            if not np.isfinite(goal).all() or np.abs(inner @ goal - want).max() > 1e-6 * limit:
                goal = np.linalg.lstsq(inner, want, rcond=1e-13)[0]
            rest = want - inner @ goal
            # without a solution the penalty falls along what is left over
            endless = np.abs(rest).max() > 1e-6 * limit
            way = rest if endless else goal - w[on]
            with np.errstate(divide="ignore", invalid="ignore"):
                zero = np.where((w[on] != 0) & (np.sign(way) == -sign[on]), -w[on] / way, np.inf)
                # one that stands at 0 and would leave its sign goes at once
                zero[(w[on] == 0) & (np.sign(way) == -sign[on])] = 0.0
            first = zero.min()
            if first < 1 or endless:
                if not np.isfinite(first):
                    return w
                w[on] += first * way
                gone = on[zero <= first]
                w[gone], sign[gone] = 0.0, 0.0
                settled = False
            else:
                w[on] = goal
        if settled:
            slope = xy - g @ w
            if gap(w, slope) <= tol:
                return w
            off = np.flatnonzero(sign == 0)
            if not len(off):
                return w
            j = off[np.abs(slope[off]).argmax()]
            if abs(slope[j]) <= limit:
                return w
            sign[j] = np.sign(slope[j])
    return w


def assemble(entries: DataFrame, names: Sequence[str]) -> GramSystem:
    """The system of the columns ``names`` ([1, x, label] in this order) from
    ``sparse_gram`` entries; entries of other names are left out."""
    if len(names) > MAX_WIDTH:
        raise ValueError(f"{len(names)} columns: the Gram matrix is only put together up to {MAX_WIDTH}")
    place = {n: i for i, n in enumerate(names)}
    out = np.zeros((len(names), len(names)))
    got = entries.toArrow()
    for a, b, v in zip(got.column("a").to_pylist(), got.column("b").to_pylist(), got.column("value").to_pylist()):
        i, j = place.get(a), place.get(b)
        if i is not None and j is not None:
            out[i, j] = out[j, i] = v
    return GramSystem(out)


def prepared_system(prep, train: DataFrame, label: str) -> GramSystem:
    """The system of a fitted one-hot ``FeaturePrep`` in the order of its
    vector, from the rows' columns."""
    numeric, groups = prep.numeric_columns(), prep.category_labels()
    categories = [category_name(f"{c}__s", v) for c, labels in groups for v in labels]
    names = [ONE, *numeric, *categories, label]
    if len(names) > MAX_WIDTH:  # before any pass
        raise ValueError(f"{len(names)} columns: the Gram matrix is only put together up to {MAX_WIDTH}")
    rows = prep.columns(train).select(*numeric, *[f"{c}__s" for c, _ in groups], label)
    return assemble(sparse_gram(rows, numeric, [f"{c}__s" for c, _ in groups], label), names)


def prepared_prediction(prep, fit: LinearFit) -> Column:
    """The prediction over ``prep.transform`` columns: numeric terms, and one
    look-up in an array literal a categorical column (0 for an unknown value)."""
    out = F.lit(float(fit.intercept))
    numeric = prep.numeric_columns()
    for c, w in zip(numeric, fit.coef):
        out = out + F.col(f"`{c}`") * F.lit(float(w))
    at = len(numeric)
    for c, labels in prep.category_labels():
        weights = F.lit([float(w) for w in fit.coef[at:at + len(labels)]])
        out = out + F.coalesce(F.get(weights, F.col(f"{c}__idx").cast("int")), F.lit(0.0))
        at += len(labels)
    return out
