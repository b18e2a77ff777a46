import datetime as dt

from salescope.sources.panel import TablesOnDemand, panel_tables


def _tables(spark, folder):
    """Two stores, two families; an order key that comes twice, NULL keys,
    discounts and quantities."""
    day = dt.datetime(2000, 1, 3)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "EAST"), (1, "WEST")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 1)]),
        "customer": ("c_custkey long, c_nationkey int", [(1, 0), (2, 1), (None, 1)]),
        "part": ("p_partkey long, p_type string", [(1, "BIG"), (2, "SMALL")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double", [
            (1, 1, day, 10.0), (2, 2, day + dt.timedelta(days=2), 20.0), (2, 2, day + dt.timedelta(days=2), 20.0),
            (3, None, day, 5.0), (None, 1, day, 5.0)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double, l_discount double", [
            (1, 1, 3.0, 0.08), (1, 1, 4.0, None), (1, 2, None, 0.1), (2, 1, 5.0, 0.01),
            (3, 1, 7.0, 0.1), (None, 1, 9.0, 0.1), (1, None, 9.0, 0.1)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_panel_is_read_from_kept_sales(spark, tmp_path):
    _tables(spark, tmp_path)
    t = panel_tables(spark, str(tmp_path))
    first, third = dt.date(2000, 1, 3), dt.date(2000, 1, 5)
    found = {(r.date, r.store_nbr, r.family): (r.sales, r.onpromotion) for r in t["observed"].collect()}
    assert found == {(first, 0, "BIG"): (7.0, 1), (first, 0, "SMALL"): (None, 1), (third, 1, "BIG"): (10.0, 0)}
    assert t["train"].count() == 9 and t["test"].count() == 48
    # the fact tables are joined once, not once a reader of the sales
    for name in ("train", "test"):
        assert "lineitem" not in " ".join(t[name].inputFiles())
        assert "l_orderkey" not in t[name]._jdf.queryExecution().optimizedPlan().toString()


def test_holidays_need_no_sales(spark, tmp_path):
    day = dt.datetime(2000, 12, 25)
    spark.createDataFrame([(1, 1, day, 10.0)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    t = panel_tables(spark, str(tmp_path))  # no table of lines is there
    assert [(r.date, r.type) for r in t["holidays_events"].collect()] == [(day.date(), "Holiday")]


def test_a_table_is_made_once(spark):
    made = []
    t = TablesOnDemand({"a": lambda: made.append("a") or spark.range(1), "b": lambda: made.append("b")})
    assert t["a"] is t["a"] and made == ["a"] and list(t) == ["a", "b"]
