"""The streaming front end scores like the batch plan, file by file."""
import json

from pyspark.sql import functions as F

from salescope.operators import models as MD
from salescope.operators.encoders import FeaturePrep
from salescope.plans import order_model as OM
from salescope.plans.scoring import score_orders
from salescope.sources.sinks import Bundle
from salescope.sources.tables import order_view
from salescope.streaming.scoring_stream import start_scoring

SF = "/root/testdata/sf0.001"


def test_stream_scores_new_files_and_keeps_rejects(spark, tmp_path):
    prep = OM.prepare_model_data(order_view(spark, SF))
    numeric, categorical, feats = OM.feature_sets(False)
    oh = FeaturePrep(numeric, categorical, "onehot").fit(prep.train)
    bundle = Bundle(MD.ridge_fit(oh.transform(prep.train), 1.0, label=OM.TARGET), oh, prep.lookups, prep.defaults, feats)
    folder = tmp_path / "in"
    folder.mkdir()
    row = prep.test.first()
    order = {c: row[c] for c in ("City", "State", "Region", "Category", "Sub_Category", "Product_Name", "Unit_Price")}
    args = (spark, str(folder), bundle, str(tmp_path / "out"), str(tmp_path / "ckpt"), True)
    (folder / "a.json").write_text(json.dumps(order | {"Order_Date": "4-5-00"}) + "\n"
                                   + json.dumps(order | {"Order_Date": "April"}) + "\n")
    start_scoring(*args).awaitTermination()
    (folder / "b.json").write_text(json.dumps(order | {"Order_Date": "12-31-00"}) + "\n")
    start_scoring(*args).awaitTermination()  # goes on where it stopped
    scored = spark.read.parquet(str(tmp_path / "out" / "scored"))
    assert scored.count() == 2 and spark.read.parquet(str(tmp_path / "out" / "rejected")).count() == 1
    batch, _ = score_orders(spark.createDataFrame([(*order.values(), "4-5-00")], [*order, "Order_Date"]), bundle)
    want = batch.first()["predicted_revenue"]
    got = scored.where(F.col("Order_Date") == "2000-04-05").first()["predicted_revenue"]
    assert abs(got - want) < 0.01
