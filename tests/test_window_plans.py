"""Values of a week are formed before its windows are."""

from demandloom.catalog.queries import QUERIES


def test_no_value_is_formed_once_a_window(spark, tmp_path):
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 1L l_orderkey, 1L l_partkey, 1L l_suppkey, timestamp'2000-03-01' l_shipdate, 'N' l_returnflag, 2.5D l_quantity, "
              "10D l_extendedprice, 0D l_discount, 0D l_tax").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("SELECT 1L c_custkey, 1 c_nationkey, 'A' c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    for name in ("window_features", "window_features_compat", "sliding_windows"):
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Generate explode", 1)
        assert "round(" in below and "round(" not in above, name
        assert "weeks#" in above and "].quantity" not in above
