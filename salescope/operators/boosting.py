"""Histogram boosting with best-first trees.

Features become bin numbers (one byte each) kept in numpy blocks.  A tree
grows by its leaf of greatest gain until it has ``leaves`` of them.  A round
asks for the histograms, (bin, feature) -> sum of residuals and rows, of the
open leaves' children: each task sums its own blocks and the tables are summed
by a tree reduction, so rows leave a task only as histograms, whose size
depends on neither rows nor partitions.

Three things keep the rounds few.  Of two siblings only the smaller is summed,
the other is the parent less that one.  With r splits left, only the r open
leaves of greatest gain can still be split, and all of these are asked for at
once; the tree then grows as far as what is known allows.  And the residuals
of the tree before are brought up to date in the same pass as the next root.

A table of at most ``ROWS_PER_PARTITION`` rows is one partition (a byte a
feature and row): its task goes through all rounds, and only the trees leave
it.  Of more rows each round is a job.

Gain and leaf values carry the L2 penalty, ``sum ** 2 / (rows + l2)``;
``prune`` is the price a leaf of minimal cost-complexity pruning.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators.quantiles import VALUES_AT_ONCE, exact_percentiles, weighted_percentiles
from salescope.session import checkpoint_dir, materialize

# workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEVELS = 256
BLOCK_ROWS = 65_536
#: Rows of a partition below which rounds cost more in jobs than in work.
ROWS_PER_PARTITION = 1_000_000
#: Trees after which the residuals are written to the shared folder.
CHECKPOINT_EVERY = 40
# Fixed values of early stopping: up to so many rows it is off; one row in so
# many is held back; the least gain in half the mean squared error that counts.
STOP_ROWS, HELD_BACK, STOP_GAIN = 10_000, 10, 1e-7


# ------------------------------------------------------------------ bins

def slot_edges(df: DataFrame, features: str = "features", levels: int = LEVELS, drop_ends: bool = False) -> list:
    """Ascending bin edges of each slot of a vector column: its different
    percentiles at ``levels`` levels.  The least is no edge; with
    ``drop_ends`` the greatest is none either (then a column with two
    different percentiles has one bin).  Tasks count the different values;
    where these are few the counts are all that is needed."""
    counts = value_counts(df.select(vector_to_array(F.col(features)).alias("x"))).persist()
    probs = [i / (levels - 1) for i in range(levels)]
    if counts.count() <= VALUES_AT_ONCE:
        got = counts.toArrow()
        slot, value, k = [got.column(c).to_numpy() for c in ("slot", "value", "k")]
        found = {int(j): np.unique(weighted_percentiles(value[slot == j], k[slot == j], probs)) for j in np.unique(slot)}
    else:
        names = [f"p{i}" for i in range(levels)]
        rows = exact_percentiles(counts, "value", probs, by="slot", names=names, weight="k").collect()
        found = {r["slot"]: np.unique([r[n] for n in names]) for r in rows}
    counts.unpersist()
    width = max(found, default=-1) + 1
    none = np.zeros(0)
    return [found.get(j, none)[1:-1] if drop_ends else found.get(j, none)[1:] for j in range(width)]


def value_counts(rows: DataFrame) -> DataFrame:
    """``(slot, value, k)`` of the array column ``x``: how many rows hold each
    value (0 for -0; no NaN)."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list = []

        def told() -> pd.DataFrame:
            each = [np.unique(column, return_counts=True) for column in np.concatenate(kept).T]
            return pd.DataFrame({"slot": np.repeat(np.arange(len(each)), [len(v) for v, _ in each]),
                                 "value": np.concatenate([v for v, _ in each]),
                                 "k": np.concatenate([k for _, k in each])})

        for b in batches:
            if len(b):
                kept.append(np.stack(b["x"]) + 0.0)
            if sum(map(len, kept)) >= BLOCK_ROWS:
                yield told()
                kept.clear()
        if kept and kept[0].shape[1]:
            yield told()

    return rows.mapInPandas(counted, "slot int, value double, k long").where(~F.isnan("value")).groupBy(
        "slot", "value").agg(F.sum("k").alias("k"))


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers: how many edges are at or below the value (NaN: all)."""
    out = np.zeros((len(x), len(edges)), np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="right")
    return out


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """Nodes as arrays; ``feature`` is -1 for a leaf; a row goes left if its
    bin is at most ``at``."""
    feature: list = field(default_factory=list)
    at: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, value: float) -> int:
        for of, v in ((self.feature, -1), (self.at, 0), (self.left, -1), (self.right, -1), (self.value, value),
                      (self.gain, 0.0)):
            of.append(v)
        return len(self.value) - 1

    def leaves(self) -> int:
        return self.feature.count(-1)

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        feature, at = np.array(self.feature), np.array(self.at)
        left, right = np.array(self.left), np.array(self.right)
        node, open_ = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            open_ = open_[feature[node[open_]] >= 0]
            if not len(open_):
                return node
            here = node[open_]
            go = bins[open_, feature[here]] <= at[here]
            node[open_] = np.where(go, left[here], right[here])

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.node_of(bins)]


@dataclass
class _Leaf:
    """A node of the growing tree: rows, sum of residuals, best split."""
    rows: float
    total: float
    table: np.ndarray | None = None       # (2, features, bins): sums, rows
    gain: float = 0.0
    split: tuple | None = None            # feature, last bin of the left side
    sides: tuple | None = None            # (rows, sum) of the left and right side
    children: tuple | None = None         # their _Leaf, when their tables are known

    def look(self, l2: float, min_leaf: int) -> None:
        """The best split of the known table; ties go to the first feature,
        then to the first bin."""
        sums, rows = np.cumsum(self.table[0], axis=1), np.cumsum(self.table[1], axis=1)
        other, less = self.total - sums, self.rows - rows
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = sums ** 2 / (rows + l2) + other ** 2 / (less + l2) - self.total ** 2 / (self.rows + l2)
        gain[(rows < min_leaf) | (less < min_leaf)] = -np.inf
        place = int(np.argmax(gain))
        j, b = divmod(place, gain.shape[1])
        # what remains of rounding is no gain
        if gain[j, b] > 1e-10 * (1e-12 + self.total ** 2 / (self.rows + l2)) and np.isfinite(gain[j, b]):
            self.gain, self.split = float(gain[j, b]), (j, b)
            self.sides = ((float(rows[j, b]), float(sums[j, b])), (float(less[j, b]), float(other[j, b])))


def _histograms(columns: np.ndarray, residual: np.ndarray, rows: np.ndarray | None, slot: np.ndarray, slots: int,
                width: int) -> np.ndarray:
    """(slots, 2, features, width) of ``rows`` (None: all, in slot 0), whose
    slots are ``slot``; ``columns``: the bins by feature."""
    out = np.zeros((slots, 2, len(columns), width))
    r = residual if rows is None else residual[rows]
    base = 0 if rows is None else slot * width
    for j, column in enumerate(columns):
        place = column if rows is None else base + column[rows]
        out[:, 0, j] = np.bincount(place, r, slots * width).reshape(slots, width)
        out[:, 1, j] = np.bincount(place, minlength=slots * width).reshape(slots, width)
    return out


def _go_down(tree: Tree, columns: np.ndarray, node: np.ndarray, before: int | None = None) -> np.ndarray:
    """``node`` (of each row, changed) brought on to the leaves of the tree, as
    far as its nodes have numbers below ``before``."""
    feature, at = np.array(tree.feature), np.array(tree.at)
    left, right = np.array(tree.left), np.array(tree.right)
    inner = (feature >= 0) & (left < (before or len(left)))
    open_ = np.flatnonzero(inner[node])
    while len(open_):
        here = node[open_]
        node[open_] = np.where(columns[feature[here], open_] <= at[here], left[here], right[here])
        open_ = open_[inner[node[open_]]]
    return node


def grow_tree(ask, leaves: int, l2: float, min_leaf: int, prune: float = 0.0) -> Tree:
    """The best-first tree.  ``ask(tree, nodes)`` gives the summed histograms
    of the rows in each of ``nodes`` of the tree so far."""
    tree = Tree()
    table = ask(None, [0])[0]
    rows, total = float(table[1, 0].sum()), float(table[0, 0].sum())
    root = _Leaf(rows, total, table)
    root.look(l2, min_leaf)
    of = {tree.add(total / (rows + l2) if rows else 0.0): root}
    open_ = [0] if root.split else []
    left = leaves - 1
    while left and open_:
        # only the ``left`` best of the open leaves can still be split
        best = sorted(open_, key=lambda i: (-of[i].gain, i))[:left]
        unknown = [i for i in best if of[i].children is None] if left > 1 else []
        if unknown:
            _ask_children(tree, of, unknown, ask, l2, min_leaf)
        while left and open_:
            i = min(open_, key=lambda n: (-of[n].gain, n))
            leaf = of[i]
            if leaf.children is None and left > 1:
                break  # its children are not known yet
            open_.remove(i)
            left -= 1
            pair = leaf.children or tuple(_Leaf(*side) for side in leaf.sides)
            tree.feature[i], tree.at[i] = leaf.split
            tree.gain[i] = leaf.gain
            for side, child in zip((tree.left, tree.right), pair):
                side[i] = tree.add(child.total / (child.rows + l2))
                of[side[i]] = child
                if child.split:
                    open_.append(side[i])
    return _pruned(tree, of, prune) if prune > 0 else tree


def _ask_children(tree: Tree, of: dict, nodes: list, ask, l2: float, min_leaf: int) -> None:
    """Children of open leaves: the smaller side's tables are asked for, the
    other's are the rest."""
    trial = Tree(*[list(x) for x in (tree.feature, tree.at, tree.left, tree.right, tree.value, tree.gain)])
    small = []
    for i in nodes:
        leaf = of[i]
        trial.feature[i], trial.at[i] = leaf.split
        trial.left[i], trial.right[i] = trial.add(0.0), trial.add(0.0)
        small.append(trial.left[i] if leaf.sides[0][0] <= leaf.sides[1][0] else trial.right[i])
    for i, s, table in zip(nodes, small, ask(trial, small)):
        leaf = of[i]
        rest = leaf.table - table
        tables = (table, rest) if s == trial.left[i] else (rest, table)
        leaf.children = tuple(_Leaf(*side, t) for side, t in zip(leaf.sides, tables))
        leaf.table = None
        for child in leaf.children:
            child.look(l2, min_leaf)


def _pruned(tree: Tree, of: dict, price: float) -> Tree:
    """Minimal cost-complexity pruning: inner nodes whose branch saves at most
    ``price`` a leaf (in squared error over all rows) become leaves, weakest
    first."""
    n = of[0].rows
    saved = {i: leaf.total ** 2 / leaf.rows / n for i, leaf in of.items() if leaf.rows}  # squared error explained
    while tree.feature[0] >= 0:
        weakest = None
        for i, below in sorted(_leaves_below(tree).items()):
            if tree.feature[i] < 0:
                continue
            rate = (sum(saved[b] for b in below) - saved[i]) / (len(below) - 1)
            if weakest is None or rate < weakest[0]:
                weakest = (rate, i)
        if weakest[0] > price:
            break
        tree.feature[weakest[1]] = -1
    return _compact(tree)


def _leaves_below(tree: Tree) -> dict:
    """The leaves below each node that the root reaches, in one pass (a
    child's number is greater than its parent's)."""
    reached = [0]
    for i in reached:
        if tree.feature[i] >= 0:
            reached += (tree.left[i], tree.right[i])
    below: dict = {}
    for i in reversed(reached):
        below[i] = [i] if tree.feature[i] < 0 else below[tree.left[i]] + below[tree.right[i]]
    return below


def _compact(tree: Tree) -> Tree:
    """The nodes that are still reached, numbered anew."""
    out = Tree()

    def copy(i: int) -> int:
        n = out.add(tree.value[i])
        if tree.feature[i] >= 0:
            out.feature[n], out.at[n], out.gain[n] = tree.feature[i], tree.at[i], tree.gain[i]
            out.left[n] = copy(tree.left[i])
            out.right[n] = copy(tree.right[i])
        return n

    copy(0)
    return out


# ------------------------------------------------------------------ boosting

@dataclass
class BoostFit:
    edges: list
    trees: list
    init: float
    step: float

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = binned(x, self.edges)
        out = np.full(len(x), self.init)
        for t in self.trees:
            out += self.step * t.predict(bins)
        return out

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        fit = self

        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(fit.score(np.stack(x.to_numpy())))

        score.__annotations__ = {"x": pd.Series, "return": pd.Series}
        return df.withColumn(out, F.pandas_udf(score, "double")(vector_to_array(F.col(features))))

    def importances(self) -> np.ndarray:
        """Gain of all splits by feature; they add up to 1 (0 without splits)."""
        total = np.zeros(len(self.edges))
        for t in self.trees:
            for j, g in zip(t.feature, t.gain):
                if j >= 0:
                    total[j] += g
        return total / total.sum() if total.sum() > 0 else total

    def state(self) -> dict:
        return {"edges": [list(map(float, e)) for e in self.edges], "init": self.init, "step": self.step,
                "trees": [vars(t) for t in self.trees]}

    @staticmethod
    def of_state(state: dict) -> "BoostFit":
        return BoostFit([np.array(e, float) for e in state["edges"]], [Tree(**t) for t in state["trees"]],
                        state["init"], state["step"])


def _blocks(df: DataFrame, features: str, label: str, edges: list, held: str) -> DataFrame:
    """Kept blocks ``(held, bins by feature, y)`` of up to ``BLOCK_ROWS`` rows."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[bool, list] = {False: [], True: []}

        def block(held_: bool) -> pd.DataFrame:
            x, y = zip(*kept[held_])
            kept[held_] = []
            return pd.DataFrame({"held": [held_], "bins": [np.concatenate(x).T.tobytes()],
                                 "y": [np.concatenate(y).tobytes()]})

        for b in batches:
            for held_, part in b.groupby("held"):
                kept[held_].append((binned(np.stack(part["x"]), edges), part["y"].to_numpy("<f8")))
                if sum(len(y) for _, y in kept[held_]) >= BLOCK_ROWS:
                    yield block(held_)
        for held_, rest in kept.items():
            if rest:
                yield block(held_)

    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"),
                     F.col(held).alias("held"))
    return materialize(rows.mapInPandas(pack, "held boolean, bins binary, y binary"), "boost-blocks")


def no_progress(losses: list, rounds: int) -> bool:
    """Whether none of the last ``rounds`` losses is below the one before them."""
    return len(losses) > rounds and not any(v < losses[-rounds - 1] - STOP_GAIN for v in losses[-rounds:])


def boost_fit(df: DataFrame, features: str = "features", label: str = "label", iters: int = 100, step: float = 0.08,
              leaves: int = 31, l2: float = 0.0, min_leaf: int = 1, prune: float = 0.0,
              drop_ends: bool = False, stop_after: int | None = None, edges: list | None = None) -> BoostFit:
    """Boosted trees on the squared error, started at the mean.  Every tree is
    fitted to the residuals, ``step`` times its leaf values are added.

    ``stop_after``: of a table of more than ``STOP_ROWS`` rows one in
    ``HELD_BACK`` (by a hash of its content) is not learned from, and the
    boosting ends once the loss on these has not improved for so many trees.
    ``edges``: the ``slot_edges`` of the rows, if they are there already.
    Rows with a NULL label are left out; an empty table gives a model without
    trees that predicts 0."""
    df = df.where(F.col(label).isNotNull())
    total = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if not total:
        return BoostFit([], [], 0.0, step)
    watch = bool(stop_after) and total > STOP_ROWS
    mark = F.pmod(F.xxhash64(vector_to_array(F.col(features)), F.col(label)), F.lit(HELD_BACK)) == 0
    df = df.withColumn("__held", mark if watch else F.lit(False))
    learn = df.where(~F.col("__held"))
    init = float(learn.agg(F.avg(label).alias("m")).first()["m"])
    edges = edges or slot_edges(learn, features, drop_ends=drop_ends)
    width = max(len(e) for e in edges) + 1
    p = len(edges)
    parts = max(1, min(df.rdd.getNumPartitions(), -(-total // ROWS_PER_PARTITION)))
    packed = _blocks(df, features, label, edges, "__held")
    checkpoint_dir(df.sparkSession)

    def unpack(r) -> tuple[bool, np.ndarray, np.ndarray]:
        y = np.frombuffer(r["y"], "<f8")
        return r["held"], np.frombuffer(r["bins"], np.uint8).reshape(p, len(y)), y - init

    patience = stop_after if watch else None
    real = np.arange(width) <= np.array([len(e) for e in edges])[:, None]
    blocks: RDD = packed.rdd.coalesce(parts).map(unpack)
    if total <= ROWS_PER_PARTITION and blocks.getNumPartitions() == 1:  # no job a round
        trees = blocks.mapPartitions(lambda it: _boosted(_TaskRounds(list(it), step, real, prune > 0), iters, leaves, l2,
                                                         min_leaf, prune, patience)).collect()
    else:
        rounds = _JobRounds(blocks.persist(), step, real)
        trees = _boosted(rounds, iters, leaves, l2, min_leaf, prune, patience)
        rounds.state.unpersist()
    return BoostFit(edges, trees, init, step)


def _block_table(block: tuple, tree: Tree | None, nodes: list, real: np.ndarray, node: np.ndarray | None = None) -> tuple:
    """Of a block the histograms of ``nodes``, of each feature only the bins
    that there are, and the sum of the losses and the rows held back.
    ``nodes`` are children (one of two) of leaves of the tree so far, the last
    ones of ``tree``; ``node``: where the rows were at last, changed."""
    aside, columns, residual = block
    if aside:  # counts for the loss alone, once a tree
        return 0.0, np.array([residual @ residual / 2, len(residual)])
    if tree is None:
        return _histograms(columns, residual, None, None, 1, real.shape[1])[:, :, real], np.zeros(2)
    before = len(tree.feature) - 2 * len(nodes)
    node = _go_down(tree, columns, np.zeros(len(residual), np.int32) if node is None else node, before)
    split = np.array(tree.left) >= before
    rows = np.flatnonzero(split[node])
    here = node[rows]
    go = columns[np.array(tree.feature)[here], rows] <= np.array(tree.at)[here]
    slots = np.full(len(tree.feature), -1)
    slots[nodes] = np.arange(len(nodes))
    slot = slots[np.where(go, np.array(tree.left)[here], np.array(tree.right)[here])]
    asked = slot >= 0
    return _histograms(columns, residual, rows[asked], slot[asked], len(nodes), real.shape[1])[:, :, real], np.zeros(2)


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


def _stepped(block: tuple, tree: Tree, step: float, node: np.ndarray | None = None) -> tuple:
    """``node``: where the rows were in this tree at last."""
    aside, columns, residual = block
    node = _go_down(tree, columns, np.zeros(len(residual), np.int32) if node is None else node)
    return aside, columns, residual - step * np.array(tree.value)[node]


class _TaskRounds:
    """The rounds over the blocks of the one partition, inside its task.
    ``cut``: finished trees are pruned, their nodes numbered anew."""

    def __init__(self, state: list, step: float, real: np.ndarray, cut: bool):
        self.state, self.step, self.real, self.cut = state, step, real, cut
        self._start()

    def _start(self) -> None:
        self.nodes = [np.zeros(len(b[2]), np.int32) for b in self.state]

    def advance(self, tree: Tree, made: int) -> None:
        if self.cut:
            self._start()
        self.state = [_stepped(b, tree, self.step, n) for b, n in zip(self.state, self.nodes)]
        self._start()

    def ask(self, tree: Tree | None, nodes: list) -> tuple:
        return functools.reduce(_added, [_block_table(b, tree, nodes, self.real, n)
                                         for b, n in zip(self.state, self.nodes)])

    def done_root(self) -> None:
        pass


class _JobRounds:
    """The rounds as jobs over the blocks of many partitions."""

    def __init__(self, state: RDD, step: float, real: np.ndarray):
        self.state, self.step, self.real, self.held = state, step, real, []
        # so that few tables are left for the driver to add
        self.depth = 2 if state.getNumPartitions() <= 64 else 3

    def advance(self, tree: Tree, made: int) -> None:
        step = self.step
        self.held.append(self.state)
        self.state = self.state.map(lambda b: _stepped(b, tree, step)).persist()
        if made % CHECKPOINT_EVERY == 0:
            self.state.checkpoint()

    def ask(self, tree: Tree | None, nodes: list) -> tuple:
        real = self.real
        return self.state.map(lambda b: _block_table(b, tree, nodes, real)).treeReduce(_added, depth=self.depth)

    def done_root(self) -> None:
        for old in self.held:  # the residuals before have been read
            old.unpersist()
        self.held = []


def _boosted(rounds, iters: int, leaves: int, l2: float, min_leaf: int, prune: float, patience: int | None) -> list[Tree]:
    """The trees, each fitted to what the ones before leave."""
    real = rounds.real

    def whole(found: np.ndarray, slots: int) -> np.ndarray:
        out = np.zeros((slots, 2, *real.shape))
        out[:, :, real] = found
        return out

    trees: list[Tree] = []
    losses: list = []
    for m in range(iters):
        if trees:
            rounds.advance(trees[-1], m)
        found, loss = rounds.ask(None, [0])
        root = whole(found, 1)
        if loss[1]:
            losses.append(loss[0] / loss[1])
        rounds.done_root()
        if patience and no_progress(losses, patience):
            break
        trees.append(grow_tree(lambda tree, nodes: root if tree is None else whole(rounds.ask(tree, nodes)[0], len(nodes)),
                               leaves, l2, min_leaf, prune))
    return trees
