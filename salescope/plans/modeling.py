"""Model training compositions: the order-revenue variants (with / without
Quantity), the quantity models, the store-sales models, selection and
comparison tables.

Each fit reads cached, assembled train vectors; each evaluation is a metric
aggregate over the scored test DataFrame.  Metric rows are tiny and are
unioned into one DataFrame.
"""

from __future__ import annotations

import datetime
import functools
import itertools
import threading
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.columns import (VARIANT_NO_QUANTITY, VARIANT_WITH_QUANTITY, expm1_clip,
                                         rounded_quantity, variant_note)
from salescope.operators import boosting as BO
from salescope.operators import gram as GR
from salescope.operators import models as MD
from salescope.operators.encoders import FeaturePrep
from salescope.operators.metrics import (metrics_row, quantity_metrics, regression_metrics,
                                         sales_metrics)
from salescope.operators.quality import assert_no_leakage
from salescope.operators.windows import best_by
from salescope.plans import order_model as OM
from salescope.plans import store_sales as S
from salescope.session import MONTH

# Model settings of the order problem.
VARIANTS = {VARIANT_WITH_QUANTITY: True, VARIANT_NO_QUANTITY: False}
ORDER_MODELS = ("Baseline_Mean", "Ridge", "Lasso", "DecisionTree", "RandomForest",
                "HistGradientBoosting")
ORDER_TREES = {"leaves": 31, "l2": 0.05, "min_leaf": 20, "stop_after": 10}
QUANTITY_MODELS = ("Baseline_Mean", "Baseline_Median", "Ridge", "Lasso", "PoissonRegressor",
                   "HistGradientBoosting", "RandomForest")


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def kept_rows(metrics: DataFrame) -> DataFrame:
    """The few rows of a metric table as values: a row a model, whose plan would
    otherwise hold those of all fits."""
    return metrics.sparkSession.createDataFrame(metrics.collect(), metrics.schema)


#: Fits that run side by side: most of a fit on few rows is waiting for small jobs.
FITS_AT_ONCE = 6


def side_by_side(spark: SparkSession, makers: Sequence[Callable]) -> list:
    """What the makers return, in their order; their Spark jobs share the
    executors."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return list(pool.map(lambda make: inheritable_thread_target(spark)(make)(), makers))


def _fit_order_model(name: str, onehot_train: DataFrame, ordinal_train: DataFrame, label: str,
                     system: GR.GramSystem | None = None):
    if name == "Baseline_Mean":
        return MD.mean_fit(onehot_train, label), "onehot"
    if name == "Baseline_Median":
        return MD.median_fit(onehot_train, label), "onehot"
    if name == "Ridge":
        return MD.ridge_fit(onehot_train, 1.0, label=label), "onehot"
    if name == "Lasso":
        return MD.lasso_fit(onehot_train, 0.2, label=label, system=system), "onehot"
    if name == "DecisionTree":
        return MD.tree_fit(onehot_train, label=label, max_depth=16, min_leaf=40), "onehot"
    if name == "RandomForest":
        return MD.forest_fit(onehot_train, label=label, trees=20, max_depth=12, min_leaf=80), "onehot"
    if name == "HistGradientBoosting":
        return BO.boost_fit(ordinal_train, label=label, iters=100, step=0.08, **ORDER_TREES), "ordinal"
    raise ValueError(name)


def fitted_preps(train: DataFrame, test: DataFrame, numeric, categorical, ordinal: bool = True) -> tuple:
    """The preprocessors fitted on train (imputation state shared).  Medians are
    only taken of columns in which either table has a NULL."""
    oh = FeaturePrep(list(numeric), list(categorical), "onehot").fit(train, others=[test])
    return oh, FeaturePrep(list(numeric), list(categorical), "ordinal").fit(train, like=oh) if ordinal else None


def prepared_vectors(train: DataFrame, test: DataFrame, numeric, categorical, label: str,
                     ordinal: bool = True, fitted: Callable | None = None):
    """Preprocessors and cached vectors for train and test.  ``ordinal=False``
    skips the ordinal ones.  ``fitted``: gives ``fitted_preps`` of these and
    more numeric columns.  Vectors that do not fit in memory are made again when
    they are read.  ``release_vectors`` drops the caches."""
    oh, od = fitted() if fitted else fitted_preps(train, test, numeric, categorical, ordinal)
    oh, od = oh.of_numeric(numeric), od and od.of_numeric(numeric)
    keep = [label]
    tr_oh = oh.transform(train).select(*keep, "features").persist(StorageLevel.MEMORY_ONLY)
    te_oh = oh.transform(test).persist(StorageLevel.MEMORY_ONLY)
    if not ordinal:
        return oh, None, tr_oh, None, te_oh, None
    tr_od = od.transform(train).select(*keep, "features").persist(StorageLevel.MEMORY_ONLY)
    te_od = od.transform(test).persist(StorageLevel.MEMORY_ONLY)
    return oh, od, tr_oh, tr_od, te_oh, te_od


def release_vectors(*frames) -> None:
    for f in frames:
        if f is not None:
            f.unpersist()


def order_variants(flat: DataFrame, models=ORDER_MODELS, prep=None):
    """Metric rows (variant, model, include_quantity, feature_count, MAE, MSE,
    RMSE, R2) of every model of both variants, kept as a small table, and the
    scored test rows by (variant, model).  The fits run side by side: most of
    them leave executors idle between their jobs."""
    prep = prep or OM.prepare_model_data(flat)
    spark, scored_by = flat.sparkSession, {}
    widest, lock = OM.feature_sets(True), threading.Lock()

    @functools.cache
    def shared(what: str):
        """Made once: what is known of a column is the same in both variants."""
        if what == "preps":
            return fitted_preps(prep.train, prep.test, *widest[:2])
        return GR.prepared_system(shared("preps")[0], prep.train, OM.TARGET)

    def fitted():
        with lock:
            return shared("preps")

    def of_variant(variant: str, include_q: bool) -> DataFrame:
        numeric, categorical, feats = OM.feature_sets(include_q)
        assert_no_leakage(feats, include_q)
        oh, _, tr_oh, tr_od, te_oh, te_od = prepared_vectors(
            prep.train, prep.test, numeric, categorical, OM.TARGET, True, fitted)
        system = None
        if "Lasso" in models:
            with lock:
                system = shared("system").without(
                    [1 + i for i, c in enumerate(widest[0]) if c not in numeric])

        def of_model(order_i: int, name: str) -> DataFrame:
            fit, kind = _fit_order_model(name, tr_oh, tr_od, OM.TARGET, system)
            scored = fit.predict(te_oh if kind == "onehot" else te_od)
            scored_by[variant, name] = scored
            m = regression_metrics(scored, OM.TARGET, "prediction")
            return m.select(F.lit(variant).alias("variant"), F.lit(name).alias("model"),
                            F.lit(include_q).alias("include_quantity"),
                            F.lit(len(feats)).alias("feature_count"),
                            F.lit(order_i).alias("listing_order"), *m.columns)

        part = kept_rows(union_all(side_by_side(spark, [functools.partial(of_model, i, name)
                                                        for i, name in enumerate(models)])))
        release_vectors(tr_oh, tr_od, te_oh, te_od)
        return part

    rows = side_by_side(spark, [functools.partial(of_variant, *v) for v in VARIANTS.items()])
    return union_all(rows), scored_by


def order_variant_metrics(flat: DataFrame, models=ORDER_MODELS, prep=None) -> DataFrame:
    return order_variants(flat, models, prep)[0]


def best_by_variant(metrics: DataFrame, metric: str = "RMSE") -> DataFrame:
    """Row with the smallest metric per variant; the first listed wins ties."""
    return best_by(metrics, "variant", metric, "listing_order")


def select_model(metrics: DataFrame, metric: str, exclude_prefix: str = "Baseline") -> str:
    """Name of the model with the smallest metric, baselines left out; the
    first listed wins ties.  One row reaches the driver."""
    row = (metrics.where(~F.col("model").startswith(exclude_prefix))
           .orderBy(F.col(metric).asc(), F.col("listing_order").asc()).select("model").first())
    if row is None:
        raise ValueError("no model to select from")
    return row["model"]


def compare_variants(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("feature_set_note", variant_note("variant")) \
                  .orderBy("variant", "RMSE", "listing_order")


# ------------------------------------------------------------------ quantity

def quantity_model_metrics(flat: DataFrame, models=QUANTITY_MODELS, prep=None):
    """Quantity target, no-quantity features; six metrics per model.  The
    rounding clip bounds come from the whole table (train + test)."""
    prep = prep or OM.prepare_model_data(flat)
    bounds = flat.agg(F.min("Quantity").alias("lo"), F.max("Quantity").alias("hi")).first()
    lo, hi = float(bounds["lo"]), float(bounds["hi"])
    numeric, categorical, _ = OM.quantity_feature_set()
    label = "Quantity"
    train = prep.train.withColumn(label, F.col(label).cast("double"))
    test = prep.test.withColumn(label, F.col(label).cast("double"))
    oh, _, tr_oh, tr_od, te_oh, te_od = prepared_vectors(train, test, numeric, categorical, label)
    system = GR.prepared_system(oh, train, label) if "Lasso" in models else None

    def of_model(order_i: int, name: str) -> tuple:
        if name == "Ridge":
            fit, kind = MD.ridge_fit(tr_oh, 2.0, label=label), "onehot"
        elif name == "Lasso":
            fit, kind = MD.lasso_fit(tr_oh, 0.001, label=label, system=system), "onehot"
        elif name == "PoissonRegressor":
            fit, kind = MD.poisson_fit(tr_oh, 0.01, label=label), "onehot"
        elif name == "HistGradientBoosting":
            fit, kind = BO.boost_fit(tr_od, label=label, iters=120, step=0.05, **ORDER_TREES), "ordinal"
        elif name == "RandomForest":
            fit, kind = MD.forest_fit(tr_od, label=label, trees=30, max_depth=12, min_leaf=80), "ordinal"
        else:
            fit, kind = _fit_order_model(name, tr_oh, tr_od, label)
        scored = fit.predict(te_oh if kind == "onehot" else te_od)
        m = quantity_metrics(scored, label, "prediction", lo, hi)
        return m.select(F.lit(name).alias("model"), F.lit(order_i).alias("listing_order"), *m.columns), scored

    made = side_by_side(flat.sparkSession, [functools.partial(of_model, i, name) for i, name in enumerate(models)])
    scored_by = {name: scored for name, (_, scored) in zip(models, made)}
    metrics = kept_rows(union_all([m for m, _ in made]))
    release_vectors(tr_oh, tr_od, te_oh, te_od)
    best_scored = scored_by[select_model(metrics, "RMSE")]
    # downstream revenue from the selected (lowest RMSE) quantity model
    return metrics, downstream_revenue(best_scored, "prediction", lo, hi)


def downstream_revenue(scored: DataFrame, pred: str, lo: float, hi: float) -> DataFrame:
    """Revenue errors of price times predicted quantity, raw and rounded."""
    q_hat = F.col(pred)
    q_round = rounded_quantity(pred, lo, hi)
    best_scored = scored
    rev = [regression_metrics(best_scored.withColumn("__r", F.col("Unit_Price") * q_hat), "Revenue", "__r")
           .select(F.lit("Unit_Price * Quantity_hat").alias("method"), "MAE", "MSE", "RMSE", "R2"),
           regression_metrics(best_scored.withColumn("__r", F.col("Unit_Price") * q_round), "Revenue", "__r")
           .select(F.lit("Unit_Price * rounded_Quantity_hat").alias("method"), "MAE", "MSE", "RMSE", "R2")]
    return union_all(rev)


# ------------------------------------------------------------------ store sales

# Store models in listing order, with the blend's weights.
STORE_MODELS = ("Ridge_Scratch", "MLP_Scratch", "HistGradientBoosting_Scratch_160",
                "HistGradientBoosting_Raw_Target", "HistGradientBoosting_Interactions",
                "Blend_0.6HGB_0.4Lag28")
BOOSTED = "HistGradientBoosting_Scratch_160"
BLEND_WEIGHTS = (0.6, 0.4)
#: The price a leaf is a hundredth of 0.1; no edge at the greatest percentile.
STORE_TREES = {"leaves": 31, "prune": 0.001, "drop_ends": True}
INTERACTIONS = {"promo_x_lag28": ("onpromotion", "lag_28"), "weekend_x_lag28": ("is_weekend", "lag_28")}


class StoreModels:
    """The store-sales models on one window of rows.  Preprocessing and fits
    are made when first asked for and shared: ridge (alpha 10) and a
    one-hidden-layer network on one-hot vectors, boosted best-first trees (160
    rounds, 0.04) on percentile bins, all on log1p(sales); boosting on the raw target;
    boosting with two product features; the blend with lag_28."""

    def __init__(self, rows: DataFrame, others: Sequence[DataFrame] | None = None):
        """``others``: all tables that will be predicted, if they are known."""
        self.rows = rows.withColumn("__y", F.log1p("sales"))
        self.others = others
        self._made: dict = {}
        self._locks: dict = {}

    def _once(self, key, make):
        with self._locks.setdefault(key, threading.Lock()):  # models may be fitted side by side
            if key not in self._made:
                self._made[key] = make()
            return self._made[key]

    def _imputed(self):
        """Medians and most frequent values, which all models share."""
        return self._once("imputed", lambda: FeaturePrep(
            S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES, "ordinal").impute(self.rows, others=self.others))

    def _codes(self):
        """The same with the codes of the categories, which all trees share."""
        return self._once("codes", lambda: FeaturePrep(
            S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES, "ordinal").fit(self.rows, like=self._imputed()))

    def _onehot(self):
        def make():
            prep = FeaturePrep(S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES, "onehot").fit(
                self.rows, like=self._imputed())
            return prep, prep.transform(self.rows).select("__y", "sales", "features").persist()
        return self._once("onehot", make)

    def _ordinal(self, interactions: bool):
        def make():
            extra = {k: F.col(a) * F.col(b) for k, (a, b) in INTERACTIONS.items()} if interactions else {}

            def wider(df: DataFrame) -> DataFrame:
                return df.withColumns(extra) if extra else df

            prep = self._codes() if not extra else FeaturePrep(
                S.NUMERIC_FEATURES + list(extra), S.CATEGORICAL_FEATURES, "ordinal").fit(
                wider(self.rows), like=self._codes(), others=self.others and [wider(o) for o in self.others])

            def vectors(df: DataFrame) -> DataFrame:
                return prep.transform(wider(df))

            return prep, vectors, vectors(self.rows).select("__y", "sales", "features").persist()
        return self._once(("ordinal", interactions), make)

    def _boosted(self, label: str, interactions: bool):
        def make():
            prep, vectors, train = self._ordinal(interactions)
            edges = self._edges()
            edges = [edges[c] for c in prep.feature_names()] if edges else None
            return vectors, BO.boost_fit(train, "features", label, iters=160, step=0.04, edges=edges, **STORE_TREES)
        return self._once(("boosted", label, interactions), make)

    def _edges(self) -> dict:
        """Bin edges by feature, those of the interactions with them: a
        feature's edges depend on no other.  Nor on the label: sales and __y
        are NULL in the same rows."""
        def make():
            prep, _, train = self._ordinal(True)
            found = BO.slot_edges(train.where("sales is not null"), "features", drop_ends=STORE_TREES["drop_ends"])
            return dict(itertools.zip_longest(prep.feature_names(), found, fillvalue=np.zeros(0))) if found else {}
        return self._once("edges", make)

    def _linear(self, name: str):
        prep, train = self._onehot()
        return prep, self._once(name, lambda: GR.prepared_system(prep, self.rows, "__y").solve(10.0)
                                if name == "Ridge_Scratch" else
                                MD.mlp_fit(train, "features", "__y", hidden=16, lr=0.01, epochs=20, batch_size=1024,
                                           task_cells=MD.TASK_CELLS))

    def predict(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction`` in units of sales, never below 0."""
        if name in ("Ridge_Scratch", "MLP_Scratch"):
            prep, fit = self._linear(name)
            return fit.predict(prep.transform(rows)).withColumn("prediction", expm1_clip("prediction"))
        if name == "Blend_0.6HGB_0.4Lag28":
            a, b = BLEND_WEIGHTS
            return self.predict(BOOSTED, rows).withColumn("prediction", a * F.col("prediction") + b * F.col("lag_28"))
        raw = name == "HistGradientBoosting_Raw_Target"
        vectors, fit = self._boosted("sales" if raw else "__y", name == "HistGradientBoosting_Interactions")
        out = fit.predict(vectors(rows))
        return out.withColumn("prediction", F.greatest("prediction", F.lit(0.0)) if raw else expm1_clip("prediction"))

    def metrics(self, name: str, valid: DataFrame) -> DataFrame:
        m = sales_metrics(self.predict(name, valid), "sales", "prediction")
        return m.select(F.lit(name).alias("model"), F.lit(STORE_MODELS.index(name)).alias("listing_order"), *m.columns)

    def importances(self, top: int = 20, name: str = BOOSTED) -> DataFrame:
        """What the features weigh in a model, named from the vector layout:
        of boosted trees (also those in the blend) their share of all gain, of
        a linear model the absolute coefficients; a network tells nothing."""
        if name == "MLP_Scratch":
            pairs = []
        elif name == "Ridge_Scratch":
            prep, fit = self._linear(name)
            pairs = zip(prep.feature_names(), map(float, np.abs(fit.coef)))
        else:
            interactions = name == "HistGradientBoosting_Interactions"
            prep, _, _ = self._ordinal(interactions)
            _, fit = self._boosted("sales" if name == "HistGradientBoosting_Raw_Target" else "__y", interactions)
            pairs = zip(prep.feature_names(), map(float, fit.importances()))
        df = self.rows.sparkSession.createDataFrame(list(pairs), "feature string, importance double")
        return df.orderBy(F.col("importance").desc(), "feature").limit(top)

    def release(self) -> None:
        for made in self._made.values():
            if isinstance(made, tuple):
                release_vectors(*[x for x in made if isinstance(x, DataFrame)])


def baseline_metrics(valid: DataFrame) -> DataFrame:
    """Metric rows of the four lag and rolling-mean baselines."""
    return union_all([metrics_row(valid, "sales", col, {"model": f"Baseline_{name}", "listing_order": -4 + i}, "sales")
                      for i, (name, col) in enumerate(S.BASELINES.items())])


def final_forecast(train: DataFrame, test: DataFrame, stores, oil, holidays, model: str = BOOSTED) -> DataFrame:
    """Features on train + test, ``model`` refit on the last 366 days of train
    with the preprocessing it was measured with, predictions for the test rows
    -> (id, sales).  Of train only the rows are read that these features reach."""
    end = train.agg(F.max("date")).first()[0]
    start = end - datetime.timedelta(days=S.RECENT_TRAIN_DAYS)
    both = S.union_train_test(S.forecast_history(train, test, start).drop(MONTH), test)
    ff = S.build_feature_frame(both, stores, oil, holidays)
    models = StoreModels(S.final_fit_window(ff.where(F.col("sales").isNotNull()), end).persist())
    test_rows = ff.join(test.select("id"), "id", "left_semi")
    return models.predict(model, test_rows).select("id", F.col("prediction").alias("sales"))


def feature_weights(flat: DataFrame, top: int = 15, prep=None) -> DataFrame:
    """Ridge weights of the no-quantity variant named from the one-hot layout,
    largest absolute values first."""
    prep = prep or OM.prepare_model_data(flat)
    numeric, categorical, _ = OM.feature_sets(False)
    oh, _, tr_oh, _, _, _ = prepared_vectors(prep.train, prep.test, numeric, categorical, OM.TARGET,
                                             ordinal=False)
    fit = MD.ridge_fit(tr_oh, 1.0, label=OM.TARGET)
    coef = fit.model.coefficients.toArray().tolist()
    names = oh.feature_names()
    spark = flat.sparkSession
    df = spark.createDataFrame(list(zip(names, [float(c) for c in coef])), "feature string, weight double")
    return df.withColumn("abs_weight", F.abs("weight")) \
             .orderBy(F.col("abs_weight").desc(), "feature").limit(top)


def compare_models(flat: DataFrame, prep=None) -> DataFrame:
    """The solvers written here against Spark ML's on the same vectors: for
    ordinary least squares and ridge a row of each and one of their difference
    in every metric, with the largest difference of a prediction.  One Gram
    pass serves both penalties."""
    prep = prep or OM.prepare_model_data(flat)
    numeric, categorical, _ = OM.feature_sets(False)
    oh, _, tr_oh, _, te_oh, _ = prepared_vectors(prep.train, prep.test, numeric, categorical, OM.TARGET,
                                                 ordinal=False)
    system = GR.prepared_system(oh, prep.train, OM.TARGET)
    scored = te_oh.select(OM.TARGET, "features", *[
        GR.prepared_prediction(oh, system.solve(alpha)).alias(f"{kind}_Scratch")
        for kind, alpha in (("OLS", 0.0), ("Ridge", 1.0))])
    for kind, alpha in (("OLS", 0.0), ("Ridge", 1.0)):
        scored = MD.ridge_fit(tr_oh, alpha, label=OM.TARGET).predict(scored, out=f"{kind}_SparkML")
    names = [f"{kind}_{by}" for kind in ("OLS", "Ridge") for by in ("Scratch", "SparkML")]
    # one pass over the scored rows: a row of (model, prediction) each
    long = scored.select(OM.TARGET, F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(n).alias("p")) for n in names])).alias("x")).select(
        OM.TARGET, "x.*")
    rows = regression_metrics(long, OM.TARGET, "p", by=["model"], decimals=None)
    gap = scored.agg(*[F.max(F.abs(F.col(f"{k}_Scratch") - F.col(f"{k}_SparkML"))).alias(k) for k in ("OLS", "Ridge")])
    gap = gap.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("max_abs_pred_diff"))
                                         for k in ("OLS", "Ridge")])).alias("x")).select("x.*")
    metrics = ["MAE", "MSE", "RMSE", "R2"]
    pairs = rows.withColumn("kind", F.split("model", "_")[0]).withColumn(
        "sign", F.when(F.col("model").endswith("Scratch"), 1.0).otherwise(-1.0))
    diff = pairs.groupBy("kind").agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in metrics]).join(
        gap, "kind").select(F.concat("kind", F.lit("_Difference")).alias("model"), *metrics, "max_abs_pred_diff")
    out = rows.withColumn("max_abs_pred_diff", F.lit(None).cast("double")).unionByName(diff)
    out = kept_rows(out)
    release_vectors(tr_oh, te_oh)
    return out.orderBy("model")


def svr_check(flat: DataFrame, prep=None) -> DataFrame:
    """Linear SVR on standardised features and standardised target (B
    variant) against the mean baseline, metrics in revenue units."""
    prep = prep or OM.prepare_model_data(flat)
    numeric, categorical, _ = OM.feature_sets(False)
    oh, _ = fitted_preps(prep.train, prep.test, numeric, categorical, ordinal=False)
    train, test = [oh.coded(rows) for rows in (prep.train, prep.test)]
    s = train.agg(F.avg(OM.TARGET).alias("m"), F.stddev_pop(OM.TARGET).alias("s")).first()
    tr = train.withColumn("__z", (F.col(OM.TARGET) - F.lit(s["m"])) / F.lit(s["s"]))
    groups = [(f"{c}__idx", len(labels)) for c, labels in oh.category_labels()]
    svr = MD.linear_svr_fit(tr, "features", "__z", epsilon=0.1, learning_rate=0.03, epochs=500, l2=0.001,
                            columns=(oh.numeric_columns(), groups))
    scored = test.withColumn("prediction", GR.prepared_prediction(oh, svr) * F.lit(s["s"]) + F.lit(s["m"]))
    m = regression_metrics(scored, OM.TARGET, "prediction")
    base = regression_metrics(test.withColumn("__b", F.lit(s["m"])), OM.TARGET, "__b")
    return union_all([m.select(F.lit("LinearSVR_Scratch").alias("model"), *m.columns,
                               F.lit(svr.loss_history[0]).alias("first_loss"),
                               F.lit(svr.loss_history[-1]).alias("last_loss")),
                      base.select(F.lit("Baseline_Mean").alias("model"), *base.columns)])
