"""Registered model queries (rows-only checks: no SQL oracle can train the
models).  Their numeric behaviour is tested in tests/ against independent
numpy calculations and against the baselines they must beat."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import functions as F

from salescope.functions import columns as C
from salescope.functions import dates as D
from salescope.functions.columns import VARIANT_NO_QUANTITY
from salescope.operators import aggregates as A
from salescope.operators import chartdata as CH
from salescope.operators import gram as GR
from salescope.plans import modeling as ML
from salescope.plans import order_model as OM
from salescope.plans import store_sales as S
from salescope.plans.catalog import register
from salescope.plans.q_orders import KEY, flat, prepared
from salescope.plans.q_panel import feature_frame, tables
from salescope.plans.scoring import parse_json_orders, score_orders
from salescope.session import checkpoint_dir
from salescope.sources.sinks import Bundle, load_bundle, save_bundle, submission


_MEMO: dict = {}


def _once(spark, sf, key, fn):
    """Model runs shared by several registered tables are made once per
    session and input."""
    k = (spark.sparkContext.applicationId, sf, key)
    if k not in _MEMO:
        _MEMO[k] = fn()
    return _MEMO[k]


def _variants(spark, sf):
    """(metric rows, scored test rows by variant and model)."""
    return _once(spark, sf, "variants", lambda: ML.order_variants(flat(spark, sf), prep=prepared(spark, sf)))


def _quantity(spark, sf):
    return _once(spark, sf, "quantity", lambda: ML.quantity_model_metrics(flat(spark, sf), prep=prepared(spark, sf)))


@register("order_variant_metrics", group="models")
def q_order_variants(spark, sf):
    return _variants(spark, sf)[0]


@register("order_best_by_variant", group="models")
def q_order_best(spark, sf):
    return ML.best_by_variant(_variants(spark, sf)[0], "RMSE")


@register("order_compare_variants", group="models")
def q_order_compare(spark, sf):
    return ML.compare_variants(_variants(spark, sf)[0])


def _selected_orders(spark, sf):
    """Test rows scored by the best model that does not see the quantity."""
    metrics, scored = _variants(spark, sf)
    name = ML.select_model(metrics.where(F.col("variant") == VARIANT_NO_QUANTITY), "RMSE")
    return scored[VARIANT_NO_QUANTITY, name].withColumn("residual", C.residual("Revenue", "prediction"))


@register("selected_residual_by_category", group="models")
def q_selected_category(spark, sf):
    return A.residual_summary(_selected_orders(spark, sf), "Category")


@register("selected_residual_by_month", group="models")
def q_selected_month(spark, sf):
    return A.residual_summary(_selected_orders(spark, sf), D.month_period("Order_Date"), name="month")


@register("quantity_model_metrics", group="models")
def q_quantity(spark, sf):
    return _quantity(spark, sf)[0]


@register("downstream_revenue_metrics", group="models")
def q_downstream(spark, sf):
    return _quantity(spark, sf)[1]


# ---------------------------------------------------------------- store models

def _store(spark, sf):
    """(models on the recent window, its validation rows); fits are shared by
    the queries below."""
    def make():
        sp = S.recent_window_split(feature_frame(spark, sf))
        valid = sp.valid.persist()
        return ML.StoreModels(sp.fit.persist(), [valid]), valid
    return _once(spark, sf, "store", make)


def _store_metrics(spark, sf, name):
    def make():
        models, valid = _store(spark, sf)
        row = models.metrics(name, valid).persist()
        row.count()
        return row
    return _once(spark, sf, ("store", name), make)


STORE_QUERIES = {
    "store_model_ridge": "Ridge_Scratch",
    "store_model_mlp": "MLP_Scratch",
    "store_model_boosting": "HistGradientBoosting_Scratch_160",
    "store_model_raw_target": "HistGradientBoosting_Raw_Target",
    "store_model_interactions": "HistGradientBoosting_Interactions",
    "store_model_blend": "Blend_0.6HGB_0.4Lag28",
}


def _store_query(model: str):
    def build(spark, sf):
        return _store_metrics(spark, sf, model)
    return build


for _name, _model in STORE_QUERIES.items():
    register(_name, group="models")(_store_query(_model))


@register("store_model_metrics", group="models")
def q_store_models(spark, sf):
    return ML.union_all(_all_store_metrics(spark, sf)).drop("listing_order").orderBy("RMSLE")


def _all_store_metrics(spark, sf) -> list:
    _store(spark, sf)  # the rows that all of them share
    return ML.side_by_side(spark, [functools.partial(_store_metrics, spark, sf, m) for m in ML.STORE_MODELS])


def _leaderboard(spark, sf):
    """A row a model or baseline, kept: the queries of the winner read it again."""
    def make():
        _, valid = _store(spark, sf)
        return ML.union_all([ML.baseline_metrics(valid), *_all_store_metrics(spark, sf)]).persist()
    return _once(spark, sf, "leaderboard", make)


@register("store_leaderboard", group="models")
def q_leaderboard(spark, sf):
    return _leaderboard(spark, sf).orderBy("RMSLE", "listing_order")


def _store_winner(spark, sf) -> str:
    return _once(spark, sf, "winner", lambda: ML.select_model(_leaderboard(spark, sf), "RMSLE"))


@register("store_selected_model", group="models")
def q_store_selected(spark, sf):
    return _leaderboard(spark, sf).where(F.col("model") == _store_winner(spark, sf))


def _store_selected(spark, sf):
    """Validation rows scored by the selected store model, kept: they are
    scored once for all the tables of residuals."""
    def make():
        models, valid = _store(spark, sf)
        scored = models.predict(_store_winner(spark, sf), valid).drop("features")
        return scored.withColumn("residual", C.residual("sales", "prediction")).persist()
    return _once(spark, sf, "selected", make)


@register("selected_residual_by_day", group="models")
def q_selected_day(spark, sf):
    return A.residual_summary(_store_selected(spark, sf), "date")


@register("selected_family_error_top15", group="models")
def q_selected_family(spark, sf):
    return A.error_by_group_top(_store_selected(spark, sf), "family", "sales", "prediction", 15)


@register("selected_residual_box_by_type", group="models")
def q_selected_box(spark, sf):
    return CH.box_stats(_store_selected(spark, sf), "residual", "type")


@register("selected_residual_histogram", group="models")
def q_selected_histogram(spark, sf):
    return CH.histogram(_store_selected(spark, sf), C.clip_range("residual", -1000.0, 1000.0), 80)


@register("selected_bin2d_actual_predicted", group="models")
def q_selected_grid(spark, sf):
    return CH.bin2d(_store_selected(spark, sf), "sales", "prediction", 40)


@register("selected_hexbin_actual_predicted", group="models")
def q_selected_hexagons(spark, sf):
    return CH.hexbin(_store_selected(spark, sf), "sales", "prediction", 40)


@register("selected_residual_kde", group="models")
def q_selected_density(spark, sf):
    return CH.kde(_store_selected(spark, sf), C.clip_range("residual", -1000.0, 1000.0), 300)


@register("store_feature_importance", group="models")
def q_importance(spark, sf):
    return _store(spark, sf)[0].importances(20)


@register("selected_feature_importance", group="models")
def q_selected_importance(spark, sf):
    """Of the model that the leaderboard selects."""
    return _store(spark, sf)[0].importances(20, _store_winner(spark, sf))


@register("linear_feature_importance", group="models")
def q_linear_importance(spark, sf):
    return _store(spark, sf)[0].importances(20, "Ridge_Scratch")


@register("order_feature_weights", group="models")
def q_weights(spark, sf):
    return ML.feature_weights(flat(spark, sf), 15, prep=prepared(spark, sf))


@register("compare_models_ridge", group="models")
def q_compare_models(spark, sf):
    return ML.compare_models(flat(spark, sf), prep=prepared(spark, sf))


@register("linear_svr_check", group="models")
def q_svr(spark, sf):
    return ML.svr_check(flat(spark, sf), prep=prepared(spark, sf))


@register("final_forecast_submission", group="models")
def q_final(spark, sf):
    """The forecast of the selected model, refit on the last year."""
    t = tables(spark, sf)
    pred = ML.final_forecast(t["train_by_month"], t["test"], t["stores"], t["oil"], t["holidays_events"],
                             _store_winner(spark, sf))
    return submission(pred)


@register("score_orders", group="models")
def q_score_orders(spark, sf):
    """Fit the selected no-quantity model (Lasso), save the bundle to the
    shared checkpoint folder, load it back and score the test orders given
    as JSON text; both predictions are returned side by side."""
    prep = prepared(spark, sf)
    numeric, categorical, feats = OM.feature_sets(False)
    oh = ML.FeaturePrep(numeric, categorical, "onehot").fit(prep.train)
    model = GR.prepared_system(oh, prep.train, OM.TARGET).lasso(0.2)
    bundle = Bundle(model, oh, prep.lookups, prep.defaults, feats)
    path = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    save_bundle(bundle, path)
    loaded = load_bundle(spark, path)
    test = OM.time_split(flat(spark, sf))[1]
    text = test.select(*KEY, F.to_json(F.struct(
        F.date_format("Order_Date", "MM-dd-yy").alias("Order_Date"), "City", "State", "Region",
        "Category", "Sub_Category", "Product_Name", "Unit_Price")).alias("value"))
    orders = parse_json_orders(text)
    a, _ = score_orders(orders, bundle, keep=KEY)
    b, _ = score_orders(orders, loaded, keep=KEY)
    return a.join(b.select(*KEY, F.col("predicted_revenue").alias("predicted_revenue_loaded")), KEY)
