import uuid

from pyspark.sql import functions as F

from salescope.operators import boosting as BO
from salescope.operators import models as MD
from salescope.operators.encoders import FeaturePrep
from salescope.plans import order_model as OM
from salescope.plans.scoring import parse_json_orders, score_orders
from salescope.session import checkpoint_dir
from salescope.sources.sinks import Bundle, load_bundle, save_bundle
from salescope.sources.tables import order_view

SF = "/root/testdata/sf0.001"


def test_score_orders_bundle_roundtrip_and_rejects(spark):
    prep = OM.prepare_model_data(order_view(spark, SF))
    numeric, categorical, feats = OM.feature_sets(False)
    oh = FeaturePrep(numeric, categorical, "onehot").fit(prep.train)
    model = MD.lasso_fit(oh.transform(prep.train), 0.2, label=OM.TARGET)
    bundle = Bundle(model, oh, prep.lookups, prep.defaults, feats)
    path = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    save_bundle(bundle, path)
    loaded = load_bundle(spark, path)
    text = spark.createDataFrame([
        ('{"Order_Date":"7-4-99","City":"MACHINERY","State":"KENYA","Region":"AFRICA",'
         '"Category":"SMALL","Sub_Category":"Brand#1","Product_Name":"part 17",'
         '"Unit_Price":1234.5}',),
        ('{"Order_Date":"2024-12-15","City":"x","Product_Name":"y","Unit_Price":1.0}',)], "value string")
    orders = parse_json_orders(text)
    a, rej = score_orders(orders, bundle)
    b, _ = score_orders(orders, loaded)
    ra, rb = a.collect(), b.collect()
    assert len(ra) == 1 and ra[0]["predicted_revenue"] == rb[0]["predicted_revenue"]
    assert rej.count() == 1 and "M-D-YY" in rej.first()["reason"]


def test_lookups_are_train_only(spark):
    """Changing test rows does not change the encoders / lookups."""
    flat = order_view(spark, SF)
    a = OM.prepare_model_data(flat)
    changed = flat.withColumn("Revenue", F.when(F.col("Order_Date") >= F.lit(OM.TEST_START).cast("date"),
                                                F.lit(1e9)).otherwise(F.col("Revenue")))
    b = OM.prepare_model_data(changed)
    la = OM.lookups_long(a.lookups)
    lb = OM.lookups_long(b.lookups)
    assert la.exceptAll(lb).count() == 0
    # same train rows; float sums may differ in the last bits between runs
    assert all(abs(a.defaults[k] - b.defaults[k]) <= 1e-9 * max(1.0, abs(a.defaults[k]))
               for k in a.defaults)


def test_bundles_of_every_model_kind(spark):
    """Saved and loaded models give equal predictions, in units of the target."""
    prep = OM.prepare_model_data(order_view(spark, SF))
    numeric, categorical, feats = OM.feature_sets(False)
    train, test = prep.train.limit(2000).persist(), prep.test.limit(200).persist()
    oh = FeaturePrep(numeric, categorical, "onehot").fit(train)
    od = FeaturePrep(numeric, categorical, "ordinal").fit(train, like=oh)
    v_oh = oh.transform(train).withColumn("y", F.log1p(OM.TARGET)).persist()
    v_od = od.transform(train).persist()
    kinds = [
        (MD.ridge_fit(v_oh, 1.0, label=OM.TARGET), oh, False),
        (MD.lasso_fit(v_oh, 0.2, label=OM.TARGET), oh, False),
        (BO.boost_fit(v_od, label=OM.TARGET, iters=5), od, False),
        (MD.gram_fit(v_oh, "features", "y", alpha=1.0), oh, True),
        (MD.linear_svr_fit(v_oh, "features", "y", epochs=3), oh, True),
        (MD.mlp_fit(v_oh, "features", "y", hidden=4, epochs=1), oh, True),
        (MD.mean_fit(train, OM.TARGET), oh, False),
    ]
    for model, p, log in kinds:
        bundle = Bundle(model, p, prep.lookups, prep.defaults, feats, log)
        path = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
        save_bundle(bundle, path)
        loaded = load_bundle(spark, path)
        assert type(loaded.model) is type(model) and loaded.log_target is log
        a = [r["prediction"] for r in bundle.predict(test).orderBy("Order_ID", "Revenue").select("prediction").collect()]
        b = [r["prediction"] for r in loaded.predict(test).orderBy("Order_ID", "Revenue").select("prediction").collect()]
        assert a == b or max(abs(x - y) for x, y in zip(a, b)) < 1e-9 * max(map(abs, a))


def test_feature_lists_of_the_models():
    assert OM.quantity_feature_set()[0] == [
        "Unit_Price", "year", "month", "quarter", "day_of_week", "is_weekend",
        "product_order_count", "product_avg_quantity", "category_avg_quantity",
        "sub_category_avg_quantity", "state_avg_quantity", "region_avg_quantity"]
    assert len(OM.feature_sets(True)[2]) == 28 and len(OM.feature_sets(False)[2]) == 27


def test_unknown_variant_is_an_error(spark):
    from salescope.functions.columns import VARIANT_NOTES, variant_note
    ok = spark.createDataFrame([(v,) for v in VARIANT_NOTES], "v string").select(variant_note("v").alias("n"))
    assert {r["n"] for r in ok.collect()} == set(VARIANT_NOTES.values())
    try:
        spark.createDataFrame([("other",)], "v string").select(variant_note("v")).collect()
        raise AssertionError("no error")
    except Exception as e:
        assert "unknown model variant" in str(e)
