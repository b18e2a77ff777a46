"""Regression models on assembled feature vectors.

Built-in Spark ML where it exists (linear with L2 / L1, Poisson GLM, tree,
forest, gradient-boosted trees).  Three estimators Spark lacks are written
on Spark primitives, over feature rows kept as numpy blocks (a binary cell of
at most ``BLOCK_ROWS`` rows, so a task holds one block at a time):

* ``gram_system``: normal equations of a vector column whose layout is not
  known (``operators.gram`` builds them from columns, without vectors).  Each
  task reduces its blocks to the Gram matrix of [1, x, y]; matrices are summed
  with a tree reduction, and the small system is solved on the driver for any
  penalty.  The width is checked against ``MAX_GRAM_WIDTH`` first.
* ``linear_svr_fit``: full-batch sub-gradient descent on the
  epsilon-insensitive loss.
* ``mlp_fit``: one ReLU hidden layer; rows are dealt to mini-batches by a hash
  of their content, and a step sums the gradient of one mini-batch over all
  tasks, so the model does not depend on how the rows are partitioned.

Both keep their blocks as numpy arrays in the tasks' cache and sum a few
thousand floats a step; a step of the network runs tasks only on the partitions
that hold its mini-batch.  On request all steps run inside one task if the
table is small (``task_cells``).

Predictions are always a column of the scored DataFrame (no positional zip,
nothing collected).
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators import forest as FO
from salescope.operators.forest import ForestFit
from salescope.operators.gram import GramSystem, LassoFit, LinearFit
from salescope.operators.quantiles import exact_percentiles

# workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
#: Share of a block's rows from which a column is kept as it is, zeros included.
DENSE_SHARE = 0.25
#: Widest Gram matrix that is summed and solved (8 bytes a cell, a copy a task).
MAX_GRAM_WIDTH = 4096
#: Partitions over which mini-batches are dealt, at most.
MAX_PARTITIONS = 4096
#: Numbers of a table (8 bytes each) below which the steps of the network cost
#: more in jobs than in work: they run inside one task.
TASK_CELLS = 8_000_000


# ------------------------------------------------------------------ helpers

def dot(features: str, coef, intercept: float) -> Column:
    """x . coef + intercept as a JVM expression (no Python per row)."""
    arr = vector_to_array(F.col(features))
    w = F.lit([float(c) for c in coef])  # one array literal (small generated code)
    return F.aggregate(F.zip_with(arr, w, lambda a, b: a * b), F.lit(0.0),
                       lambda acc, x: acc + x) + F.lit(float(intercept))


def _tree_sum(df: DataFrame, col: str) -> np.ndarray:
    """Sum of equally shaped float arrays (one per task) by tree reduction."""
    rdd = df.select(col).rdd.map(lambda r: np.asarray(r[0], dtype=np.float64))
    return rdd.treeReduce(lambda a, b: a + b, depth=2)


def vector_width(df: DataFrame, features: str) -> int:
    return int(df.select(F.size(vector_to_array(F.col(features))).alias("p")).first()["p"])


def blocks(df: DataFrame, features: str, label: str, batches: int = 1) -> DataFrame:
    """Rows as numpy blocks: ``batch, x, y`` (float64 bytes).  The batch of a
    row is a hash of its content."""
    data = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    data = data.withColumn("batch", F.pmod(F.xxhash64("x", "y"), F.lit(batches)).cast("int"))

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for batch, part in pdf.groupby("batch"):
                for at in range(0, len(part), BLOCK_ROWS):
                    some = part.iloc[at:at + BLOCK_ROWS]
                    yield pd.DataFrame({"batch": [batch], "x": [np.stack(some["x"]).astype("<f8").tobytes()],
                                        "y": [some["y"].to_numpy("<f8").tobytes()]})

    return data.mapInPandas(pack, "batch int, x binary, y binary")


def _arrays(r) -> tuple[int, np.ndarray, np.ndarray]:
    """A row of ``blocks`` as (batch, x, y)."""
    y = np.frombuffer(r["y"], "<f8")
    return r["batch"], np.frombuffer(r["x"], "<f8").reshape(len(y), -1), y


def _split_block(x: np.ndarray) -> tuple:
    """A block of rows as (columns that are mostly not 0, their values; row,
    column and value of each other cell that is not 0)."""
    filled = np.count_nonzero(x, axis=0) > len(x) * DENSE_SHARE
    some, rest = np.flatnonzero(filled), np.flatnonzero(~filled)
    row, at = np.nonzero(x[:, rest])
    kind = np.min_scalar_type(x.shape[1])
    return some, x[:, some], row.astype(np.min_scalar_type(len(x))), rest[at].astype(kind), x[row, rest[at]]


def split_blocks(df: DataFrame, features: str, label: str):
    """Rows as blocks ``(_split_block, y)`` in the tasks' cache: a one-hot
    column takes room for its ones alone."""
    data = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for at in range(0, len(pdf), BLOCK_ROWS):
                some = pdf.iloc[at:at + BLOCK_ROWS]
                block = _split_block(np.stack(some["x"])), some["y"].to_numpy("<f8")
                yield pd.DataFrame({"block": [pickle.dumps(block, pickle.HIGHEST_PROTOCOL)]})

    return data.mapInPandas(pack, "block binary").rdd.map(lambda r: pickle.loads(r["block"])).persist()


def _summed(rdd, of_block) -> np.ndarray:
    """Sum of ``of_block`` over all blocks: an array a partition; of many
    partitions so that few are left for the driver."""
    parts = rdd.mapPartitions(lambda it: [sum(map(of_block, it))])
    if rdd.getNumPartitions() <= 64:
        return sum(parts.collect())
    return parts.treeReduce(np.add, depth=2)


def _sum_over(data: DataFrame, of_block, size: int) -> np.ndarray:
    """Sum of ``of_block(x, y)`` (a flat array of ``size``) over all blocks."""

    def partial(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in it:
            for xb, yb in zip(pdf["x"], pdf["y"]):
                y = np.frombuffer(yb, "<f8")
                total += of_block(np.frombuffer(xb, "<f8").reshape(len(y), -1), y)
        yield pd.DataFrame({"g": [total]})

    return _tree_sum(data.select("x", "y").mapInPandas(partial, "g array<double>"), "g")


# ------------------------------------------------------------------ Gram solver

def gram_system(df: DataFrame, features: str = "features", label: str = "label") -> GramSystem:
    """One pass; ``solve`` then serves every penalty."""
    k = vector_width(df, features) + 2
    if k > MAX_GRAM_WIDTH:
        raise ValueError(f"{k} columns: the Gram matrix is only built up to {MAX_GRAM_WIDTH}")

    def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(x)), x, y])
        return (z.T @ z).ravel()

    return GramSystem(_sum_over(blocks(df, features, label), products, k * k).reshape(k, k))


def gram_fit(df: DataFrame, features: str = "features", label: str = "label",
             alpha: float = 0.0, fit_intercept: bool = True) -> LinearFit:
    return gram_system(df, features, label).solve(alpha, fit_intercept)


# ------------------------------------------------------------------ linear SVR

@dataclass
class SVRFit(LinearFit):
    loss_history: list


def column_blocks(df: DataFrame, numeric: Sequence[str], coded: Sequence[tuple[str, int]], label: str):
    """Kept blocks ``(numbers, codes, y)`` of rows given by columns: numeric
    columns as their different values in the block and a small number a row,
    and of each one-hot group (code column, size; a code of ``size`` or more: no
    one) the place of its one among all one-hot columns."""
    starts = np.concatenate([[0], np.cumsum([size for _, size in coded])]).astype(int)
    kind = np.min_scalar_type(int(starts[-1]))

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            numbers = []
            for i in range(len(numeric)):
                values, at = np.unique(pdf[f"x{i}"].to_numpy("<f8"), return_inverse=True)
                numbers.append((values, at.astype(np.min_scalar_type(len(values)))))
            codes = np.empty((len(coded), len(pdf)), kind)
            for i, (_, size) in enumerate(coded):
                c = pdf[f"c{i}"].to_numpy("<f8")
                codes[i] = np.where(c < size, starts[i] + c, starts[-1])
            block = numbers, codes, pdf["y"].to_numpy("<f8")
            yield pd.DataFrame({"block": [pickle.dumps(block, pickle.HIGHEST_PROTOCOL)]})

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
                     *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, (c, _) in enumerate(coded)],
                     F.col(label).cast("double").alias("y"))
    return rows.mapInPandas(pack, "block binary").rdd.map(lambda r: bytes(r["block"])).persist(
        StorageLevel.MEMORY_AND_DISK)


def _from_columns(block: bytes) -> tuple:
    """A block of ``column_blocks`` as ``split_blocks`` has them, its one-hot
    columns after the numeric ones."""
    numbers, codes, y = pickle.loads(block)
    x = np.column_stack([v[at] for v, at in numbers]) if numbers else np.zeros((len(y), 0))
    return ("codes", x, codes), y


def _times(cells: tuple, w: np.ndarray, n: int) -> np.ndarray:
    """x . w of each row of a block's cells."""
    if isinstance(cells[0], str):
        _, x, codes = cells
        ones = np.append(w[x.shape[1]:], 0.0)  # the last place: no one
        return sum((ones[c] for c in codes), x @ w[:x.shape[1]])
    some, x, row, at, value = cells
    return x @ w[some] + np.bincount(row, value * w[at], n)


def _column_sums(cells: tuple, sign: np.ndarray, p: int) -> np.ndarray:
    """x' sign."""
    if isinstance(cells[0], str):
        _, x, codes = cells
        k = x.shape[1]
        ones = sum((np.bincount(c, sign, p - k + 1) for c in codes), np.zeros(p - k + 1))
        return np.concatenate([x.T @ sign, ones[:-1]])
    some, x, row, at, value = cells
    slope = np.bincount(at, value * sign[row], p).astype(float)  # of no cells it is whole numbers
    slope[some] += x.T @ sign
    return slope


def _lengths(cells: tuple, n: int) -> np.ndarray:
    """Length of [1, x] of each row."""
    if isinstance(cells[0], str):
        _, x, codes = cells
        return np.sqrt(1.0 + np.einsum("ij,ij->i", x, x) + len(codes))  # at most: some may have no one
    _, x, row, _, value = cells
    return np.sqrt(1.0 + np.einsum("ij,ij->i", x, x) + np.bincount(row, value ** 2, n))


def _some_rows(cells: tuple, keep: np.ndarray) -> tuple:
    """The cells of the rows for which ``keep`` holds."""
    if isinstance(cells[0], str):
        return cells[0], cells[1][keep], cells[2][:, keep]
    some, x, row, at, value = cells
    here, place = keep[row], np.cumsum(keep) - 1
    return some, x[keep], place[row[here]], at[here], value[here]


@dataclass
class SVRFit(LinearFit):
    loss_history: list


#: Rows that a task of an epoch reads, about, where there are more tasks than cores.
ROWS_A_TASK = 4_000_000
#: Steps as long as the last one that the rows set apart allow for.
STEPS_AHEAD = 24


def linear_svr_fit(df: DataFrame, features: str = "features", label: str = "label",
                   epsilon: float = 0.1, learning_rate: float = 0.03, epochs: int = 500,
                   l2: float = 0.001, seed: int = 42, columns: tuple | None = None) -> SVRFit:
    """Full-batch sub-gradient descent: grad_w = l2 w + X_out' sign / n,
    grad_b = mean sign over rows outside the tube.

    A row counts by its side of the tube alone, and an error changes by at most
    |[x, 1]| times the way that [w, b] has gone.  A pass over all rows sets
    apart those that are too far from the tube's edges to change sides within
    ``STEPS_AHEAD`` steps like the last one: their sums stay what they are.  The
    epochs in between read the other rows; once the way is longer, all rows are
    read again.  The result is that of reading all rows in each epoch.

    ``columns``: the rows as (numeric columns, one-hot groups) of
    ``column_blocks`` in place of the vectors."""
    if columns:
        p = len(columns[0]) + sum(size for _, size in columns[1])
        kept = column_blocks(df, *columns, label)
    else:
        p = vector_width(df, features)
        kept = split_blocks(df, features, label)
    n = kept.map(_from_columns if columns else lambda b: b).map(lambda b: len(b[1])).sum()
    # an epoch is short: a task a core, of very many rows more
    few = kept.coalesce(max(kept.context.defaultParallelism, n // ROWS_A_TASK))
    data = few.map(_from_columns) if columns else few
    w, b, history = np.random.default_rng(seed).normal(0, 0.01, size=p), 0.0, []

    def sums(cells, y, err) -> np.ndarray:
        """X' sign, and of signs, rows outside, sign * y their sums."""
        sign = np.sign(err) * (np.abs(err) > epsilon)
        return np.concatenate([_column_sums(cells, sign, p), [sign.sum(), np.count_nonzero(sign), sign @ y]])

    near, far, start, reach = None, np.zeros(p + 3), None, 0.0
    for _ in range(epochs):
        gone = np.inf if start is None else np.sqrt(np.sum((w - start[0]) ** 2) + (b - start[1]) ** 2)
        if not gone < reach:  # a pass over all rows
            if near is not None:
                near.unpersist()
            start = w.copy(), b
            reach = 0.0 if not history else STEPS_AHEAD * step

            def apart(block: tuple, w=w, b=b, reach=reach) -> tuple:
                cells, y = block
                err = _times(cells, w, len(y)) + b - y
                close = ~(np.abs(np.abs(err) - epsilon) > _lengths(cells, len(y)) * reach * 1.0001 + 1e-9)
                if close.all():
                    return np.zeros(p + 3), block
                away = _some_rows(cells, ~close), y[~close]
                return sums(*away, err[~close]), (_some_rows(cells, close), y[close])

            if reach:
                near = data.map(apart).persist(StorageLevel.MEMORY_AND_DISK)
                far = _summed(near, lambda item: item[0])
            else:
                near, far = None, np.zeros(p + 3)

        def outside(block: tuple, w=w, b=b) -> np.ndarray:
            cells, y = block
            return sums(cells, y, _times(cells, w, len(y)) + b - y)

        total = far + (_summed(data, outside) if near is None else _summed(near, lambda item: outside(item[1])))
        signs, rows, with_y = total[p:]
        loss = total[:p] @ w + signs * b - with_y - epsilon * rows
        before = w, b
        w = w - learning_rate * (l2 * w + total[:p] / n)
        b = b - learning_rate * (signs / rows if rows else 0.0)
        step = np.sqrt(np.sum((w - before[0]) ** 2) + (b - before[1]) ** 2)
        history.append(float(loss / n + 0.5 * l2 * float(w @ w)))
    if near is not None:
        near.unpersist()
    kept.unpersist()
    return SVRFit(w, float(b), history)


# ------------------------------------------------------------------ MLP

@dataclass
class MLPFit:
    """One hidden layer: ``theta`` holds the (p + 1) x hidden weights of the
    layer (last row: offsets) and the hidden + 1 weights of the output."""
    theta: np.ndarray
    p: int
    hidden: int
    loss_history: list

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        theta, p, hidden = self.theta, self.p, self.hidden

        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(_network(theta, p, hidden, np.stack(x.to_numpy()))[1])

        score.__annotations__ = {"x": pd.Series, "return": pd.Series}
        return df.withColumn(out, F.pandas_udf(score, "double")(vector_to_array(F.col(features))))


def _network(theta: np.ndarray, p: int, hidden: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden activations and outputs for rows ``x``."""
    layer, top = theta[:(p + 1) * hidden].reshape(p + 1, hidden), theta[(p + 1) * hidden:]
    active = np.clip(x @ layer[:-1] + layer[-1], 0.0, None)
    return active, active @ top[:-1] + top[-1]


def _loss_gradient(theta: np.ndarray, p: int, hidden: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed over rows: the gradient of half the squared error, the squared
    error, the number of rows."""
    active, guess = _network(theta, p, hidden, x)
    miss = guess - y
    top = theta[(p + 1) * hidden:-1]
    back = np.outer(miss, top) * (active > 0)
    return np.concatenate([(x.T @ back).ravel(), back.sum(axis=0), active.T @ miss,
                           [miss.sum(), miss @ miss, len(y)]])


def batch_partitions(batch: int, steps: int, spread: int) -> list[int]:
    """The partitions that hold a mini-batch: ``spread`` each, or of very many
    mini-batches several in one."""
    if steps * spread <= MAX_PARTITIONS:
        return list(range(batch * spread, (batch + 1) * spread))
    return [batch % MAX_PARTITIONS]


def mlp_fit(df: DataFrame, features: str = "features", label: str = "label", hidden: int = 16,
            lr: float = 0.01, epochs: int = 20, batch_size: int = 1024, seed: int = 42,
            task_cells: int = 0) -> MLPFit:
    """Mini-batch gradient descent on the squared error.  Mini-batches hold
    about ``batch_size`` rows and lie in partitions of their own, so that a
    step runs tasks on these alone and an epoch reads every row once; for large
    tables the caller sets a size that keeps the number of steps in hand.  The
    steps of a table of at most ``task_cells`` numbers run inside one task."""
    p = vector_width(df, features)
    n = df.count()
    steps = max(1, -(-n // batch_size))
    if n * (p + 1) <= task_cells:  # no job a step
        numbered = blocks(df, features, label, steps).rdd.map(_arrays).mapPartitionsWithIndex(
            lambda part, it: (((part, i), block) for i, block in enumerate(it)))

        def all_steps(it: Iterator) -> list:
            of: list = [[] for _ in range(steps)]
            for _, (batch, x, y) in sorted(it, key=lambda b: b[0]):
                of[batch].append((x, y))
            return [_descent(lambda theta, batch: _batch_gradient(theta, p, hidden, of[batch]),
                             p, hidden, steps, lr, epochs, seed)]

        theta, history = numbered.repartition(1).mapPartitions(all_steps).first()
        return MLPFit(theta, p, hidden, history)
    spread = max(1, min(64, batch_size // BLOCK_ROWS))

    def place(item: tuple) -> tuple:
        (batch, x, y), i = item
        of = batch_partitions(batch, steps, spread)
        return of[i % len(of)], (batch, x, y)

    dealt = blocks(df, features, label, steps).rdd.map(_arrays).zipWithIndex().map(place)
    data = dealt.partitionBy(min(steps * spread, MAX_PARTITIONS), int).values().persist()

    def ask(theta: np.ndarray, batch: int) -> np.ndarray:
        def gradient(it: Iterator) -> list:
            return [_batch_gradient(theta, p, hidden, [(x, y) for at, x, y in it if at == batch])]

        return sum(df.sparkSession.sparkContext.runJob(data, gradient, batch_partitions(batch, steps, spread)))

    theta, history = _descent(ask, p, hidden, steps, lr, epochs, seed)
    data.unpersist()
    return MLPFit(theta, p, hidden, history)


def _batch_gradient(theta: np.ndarray, p: int, hidden: int, some: list) -> np.ndarray:
    return sum((_loss_gradient(theta, p, hidden, x, y) for x, y in some), np.zeros(len(theta) + 2))


def _descent(ask, p: int, hidden: int, steps: int, lr: float, epochs: int, seed: int) -> tuple[np.ndarray, list]:
    """Weights after all epochs and the loss of each; ``ask(theta, batch)``
    gives the summed gradient, squared error and rows of a mini-batch."""
    rng = np.random.default_rng(seed)
    theta = np.concatenate([
        np.vstack([rng.standard_normal((p, hidden)) * np.sqrt(2.0 / p), np.zeros((1, hidden))]).ravel(),
        rng.standard_normal(hidden) * np.sqrt(2.0 / hidden), [0.0]])
    history = []
    for _ in range(epochs):
        squared = rows = 0.0
        for batch in map(int, rng.permutation(steps)):
            total = ask(theta, batch)
            if total[-1]:
                theta = theta - lr * total[:-2] / total[-1]
            squared, rows = squared + total[-2], rows + total[-1]
        history.append(float(squared / max(rows, 1)))
    return theta, history


# ------------------------------------------------------------------ Spark ML

@dataclass
class ConstantFit:
    """``value``: None (no training value) predicts NULL."""
    value: float | None

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        return df.withColumn(out, F.lit(self.value).cast("double"))


def mean_fit(df: DataFrame, label: str = "label") -> ConstantFit:
    return ConstantFit(df.agg(F.avg(label)).first()[0])


def median_fit(df: DataFrame, label: str = "label") -> ConstantFit:
    row = exact_percentiles(df, label, [0.5], names=["m"]).first()
    return ConstantFit(row["m"] if row else None)


@dataclass
class SparkFit:
    model: object

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        m = self.model.copy()
        m.setFeaturesCol(features).setPredictionCol(out)
        return m.transform(df)


def ridge_fit(df: DataFrame, alpha: float, features: str = "features", label: str = "label") -> SparkFit:
    """|y - Xw - b|^2 + alpha |w|^2 in Spark's scaling (standardization off):
    regParam = alpha / n * stddev_samp(y)."""
    s = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(label).alias("sd")).first()
    reg = alpha / s["n"] * (s["sd"] or 1.0)
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                          standardization=False, solver="normal")
    return SparkFit(lr.fit(df))


def _converged(iterations: int, max_iter: int, what: str) -> None:
    if iterations >= max_iter:
        raise RuntimeError(f"{what} did not converge in {max_iter} iterations")


def lasso_fit(df: DataFrame, alpha: float, features: str = "features", label: str = "label",
              tol: float = 1e-8, system: GramSystem | None = None) -> LassoFit:
    """1/(2n) |y - Xw - b|^2 + alpha |w|_1 from one pass over the data, until
    the duality gap is below ``tol`` (see ``GramSystem.lasso``).  ``system``:
    the normal equations, if they are there already."""
    return (system or gram_system(df, features, label)).lasso(alpha, tol)


def poisson_fit(df: DataFrame, alpha: float, features: str = "features", label: str = "label",
                max_iter: int = 1000, tol: float = 1e-6) -> SparkFit:
    """mean half Poisson deviance + alpha/2 |w|^2, log link, run until it converges."""
    mean_y = df.agg(F.avg(label)).first()[0]
    glm = GeneralizedLinearRegression(featuresCol=features, labelCol=label, family="poisson",
                                      link="log", regParam=alpha / mean_y, maxIter=max_iter, tol=tol)
    model = glm.fit(df)
    _converged(model.summary.numIterations, max_iter, "Poisson regression")
    return SparkFit(model)


def tree_fit(df: DataFrame, features="features", label="label", max_depth=16, min_leaf=40,
             max_bins=256, seed=42) -> ForestFit:
    return FO.forest_fit(df, features, label, 1, max_depth, min_leaf, max_bins, seed, bagging=False)


def forest_fit(df: DataFrame, features="features", label="label", trees=20, max_depth=12,
               min_leaf=80, max_bins=256, seed=42) -> ForestFit:
    return FO.forest_fit(df, features, label, trees, max_depth, min_leaf, max_bins, seed, bagging=trees > 1)
