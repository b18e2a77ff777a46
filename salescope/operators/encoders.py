"""Feature preprocessing fitted on train rows only.

* numeric: NULL -> exact train median; optional z-score with the train mean
  and the *population* standard deviation;
* categorical: NULL -> most frequent train value (smallest on ties), then
  either one-hot (sorted categories, unknown -> all zeros) or ordinal codes
  (sorted as the column's own type, unknown / NULL -> -1).

Fitted state is a handful of scalars plus one small code table per
categorical column (bounded by its cardinality, broadcast after a size
check).  Transform is column expressions + joins + VectorAssembler, all
JVM-side.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators.joins import sized_broadcast
from salescope.operators.quantiles import exact_percentiles


def fit_medians(train: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact train median per numeric column (one pass over the stacked
    columns, bounded memory per task)."""
    cols = list(cols)
    if not cols:
        return {}
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = train.selectExpr(f"stack({len(cols)}, {stack}) as (column, value)")
    rows = exact_percentiles(long, "value", [0.5], by="column", names=["m"]).collect()
    got = {r["column"]: r["m"] for r in rows}
    return {c: got.get(c) for c in cols}


def null_columns(cols: Sequence[str], frames: Sequence[DataFrame]) -> list[str]:
    """Columns that hold a NULL in one of the frames (one aggregate each)."""
    found = set()
    for df in frames:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        found |= {c for c in cols if row[c]}
    return [c for c in cols if c in found]


def fit_modes(train: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-NULL value per column; ties -> smallest value.  One
    job: a two-step group-by per column, one row of each."""
    if not cols:
        return {}
    out = None
    for c in cols:
        counts = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        # the smallest (-n, value) is the most frequent, then the smallest
        best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias("b"))
        row = best.select(F.lit(c).alias("column"), F.to_json(F.struct(F.col("b.v").alias("v"))).alias("v"))
        out = row if out is None else out.union(row)
    types = dict(train.dtypes)
    got = {r["column"]: json.loads(r["v"] or "{}").get("v") for r in out.collect()}
    return {c: datetime.date.fromisoformat(v) if types[c] == "date" and v else v for c, v in got.items()}


def fit_scaling(train: DataFrame, cols: Sequence[str], medians: dict[str, float]):
    """mean and population std of each (median-imputed) column."""
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double"))
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = train.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def code_table(values: DataFrame, col: str) -> DataFrame:
    """``col`` and ``{col}__code``: 0..k-1 in the column's own order, of
    distinct values.  Ranges of values are sorted side by side; a value's code
    is its place in its range plus the sizes of the ranges before (one number
    a range reaches the driver)."""
    code = f"{col}__code"
    placed = (values.repartitionByRange(col).sortWithinPartitions(col)
              .withColumn("__at", F.monotonically_increasing_id()).persist())
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, first = 0, F.lit(0).cast("long")
    for p, n in sizes:
        first = F.when(part == p, F.lit(before).cast("long")).otherwise(first)
        before += n
    return placed.select(col, (first + place).cast("int").alias(code))


def fit_code_tables(train: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """Per column: distinct train values -> code 0..k-1 in the column's own
    sort order (numbers sort as numbers)."""
    return {c: code_table(train.where(F.col(c).isNotNull()).select(c).distinct(), c) for c in cols}


@dataclass
class FeaturePrep:
    """Fitted preprocessor: ``kind`` = 'onehot' (scaled numerics + one-hot) or
    'ordinal' (raw numerics + codes)."""
    numeric: list[str]
    categorical: list[str]
    kind: str = "onehot"
    scale: bool = True
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    scaling: dict = field(default_factory=dict)
    codes: dict = field(default_factory=dict)
    onehot_model: object = None
    output: str = "features"

    def fit(self, train: DataFrame, like: "FeaturePrep | None" = None,
            others: Sequence[DataFrame] | None = None) -> "FeaturePrep":
        """Fit on train rows; ``like`` shares the state of the columns that it
        has in common (imputation, codes) of another preprocessor fitted on
        the same rows.  ``others``: all other tables that will be transformed;
        medians are then only taken of columns in which one of the tables has
        a NULL."""
        self.impute(train, like, others)
        if self.kind == "onehot":
            if self.scale:
                self.scaling = fit_scaling(train, self.numeric, self.medians)
            filled = self._fill(train)
            stages = []
            idx_cols = [f"{c}__idx" for c in self.categorical]
            stages.append(StringIndexer(inputCols=[f"{c}__s" for c in self.categorical],
                                        outputCols=idx_cols, handleInvalid="keep",
                                        stringOrderType="alphabetAsc"))
            from pyspark.ml import Pipeline
            stages.append(OneHotEncoder(inputCols=idx_cols,
                                        outputCols=[f"{c}__oh" for c in self.categorical],
                                        dropLast=True))  # drops the indexer's unknown slot
            self.onehot_model = Pipeline(stages=stages).fit(self._as_strings(filled))
        else:
            known = {} if like is None else {c: like.codes[c] for c in self.categorical if c in like.codes}
            new = fit_code_tables(self._fill(train), [c for c in self.categorical if c not in known])
            self.codes = {c: known.get(c, new.get(c)) for c in self.categorical}
        return self

    def impute(self, train: DataFrame, like: "FeaturePrep | None" = None,
               others: Sequence[DataFrame] | None = None) -> "FeaturePrep":
        """The first part of ``fit``: medians and most frequent values."""
        numeric, categorical = (like.numeric, like.categorical) if like is not None else ([], [])
        new = [c for c in self.numeric if c not in numeric]
        needed = new if others is None or not new else null_columns(new, [train, *others])
        self.medians = {c: m for c, m in like.medians.items() if c in self.numeric} if like is not None else {}
        self.medians |= fit_medians(train, needed)
        self.modes = {c: v for c, v in like.modes.items() if c in self.categorical} if like is not None else {}
        self.modes |= fit_modes(train, [c for c in self.categorical if c not in categorical])
        return self

    def of_numeric(self, numeric: Sequence[str]) -> "FeaturePrep":
        """The same of some of the numeric columns: a column's state is its own."""
        return replace(self, numeric=list(numeric), medians={c: m for c, m in self.medians.items() if c in numeric},
                       scaling={c: self.scaling[c] for c in numeric if c in self.scaling})

    # -- transform helpers
    def _fill(self, df: DataFrame) -> DataFrame:
        cols = {c: F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c)).cast("double"))
                for c in self.numeric}
        for c in self.categorical:
            if self.modes.get(c) is not None:
                cols[c] = F.coalesce(F.col(c), F.lit(self.modes[c]))
        return df.withColumns(cols)

    def _as_strings(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}__s": F.col(c).cast("string") for c in self.categorical})

    def numeric_columns(self) -> list[str]:
        return [f"{c}__z" for c in self.numeric] if self.kind == "onehot" and self.scale \
            else list(self.numeric)

    def columns(self, df: DataFrame) -> DataFrame:
        """One-hot kind: the filled rows with scaled numeric columns and the
        categories as text, without a vector."""
        out = self._fill(df)
        if self.scale:
            out = out.withColumns({
                f"{c}__z": (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
                for c, (m, s) in self.scaling.items()})
        return self._as_strings(out)

    def coded(self, df: DataFrame) -> DataFrame:
        """One-hot kind: ``columns`` and the place of each category among its
        labels (``__idx``; their number if it is none of them)."""
        return self.onehot_model.stages[0].transform(self.columns(df))

    def category_labels(self) -> list[tuple[str, list[str]]]:
        """One-hot kind: the values of each categorical column in vector order."""
        return [(c, list(v)) for c, v in zip(self.categorical, self.onehot_model.stages[0].labelsArray)]

    def transform(self, df: DataFrame) -> DataFrame:
        if self.kind == "onehot":
            out = self.onehot_model.transform(self.columns(df))
            inputs = self.numeric_columns() + [f"{c}__oh" for c in self.categorical]
        else:
            out = self._fill(df)
            for c, table in self.codes.items():
                out = out.join(sized_broadcast(table), c, "left") \
                         .withColumn(f"{c}__code", F.coalesce(F.col(f"{c}__code"), F.lit(-1)))
            inputs = list(self.numeric) + [f"{c}__code" for c in self.categorical]
        asm = VectorAssembler(inputCols=inputs, outputCol=self.output, handleInvalid="keep")
        return asm.transform(out)

    def feature_names(self) -> list[str]:
        """Names in vector order (one-hot names come from the fitted indexers)."""
        names = list(self.numeric)
        if self.kind == "onehot":
            for c, labels in self.category_labels():
                names += [f"{c}_{v}" for v in labels]  # dropLast removes the 'unknown' slot
        else:
            names += list(self.categorical)
        return names


def quantile_bin_edges(train: DataFrame, cols: Sequence[str], n_levels: int = 256) -> dict[str, list]:
    """Per column: unique percentiles at ``n_levels`` evenly spaced levels
    (ends included); the inner ones are the bin edges (``digitize``)."""
    cols = list(cols)
    probs = [i / (n_levels - 1) for i in range(n_levels)]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = train.selectExpr(f"stack({len(cols)}, {stack}) as (column, value)")
    names = [f"p{i}" for i in range(n_levels)]
    rows = exact_percentiles(long, "value", probs, by="column", names=names).collect()
    out = {}
    for r in rows:
        vals = sorted(set(float(r[n]) for n in names if r[n] is not None))
        out[r["column"]] = vals
    return out


def bin_columns(df: DataFrame, edges: dict[str, list], suffix: str = "__b") -> DataFrame:
    """np.digitize(x, edges[1:-1]) per column = index of the left-closed
    bucket [e_i, e_i+1) among (-inf, inner edges..., +inf) (Bucketizer does a
    binary search per value, JVM-side)."""
    from pyspark.ml.feature import Bucketizer
    cols = [c for c in edges if len(edges[c]) > 2]
    # fewer than three distinct percentiles: no inner edge, every value in bin 0
    out = df.withColumns({f"{c}{suffix}": F.lit(0.0) for c in edges if len(edges[c]) <= 2})
    if not cols:
        return out
    splits = [[float("-inf")] + list(edges[c][1:-1]) + [float("inf")] for c in cols]
    b = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"{c}{suffix}" for c in cols],
                   handleInvalid="keep")
    return b.transform(out)
