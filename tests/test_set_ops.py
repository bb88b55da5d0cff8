"""set_ops: sets of keys as SQL sees them, a null key being one, and tasks that follow the rows."""

from tickloom.plans import queries


def test_sets_hold_a_null_key_once_and_are_dealt_by_rows(spark, tmp_path):
    spark.createDataFrame([(1, "P"), (2, "O"), (2, "O"), (3, None), (None, "O")], "o_orderkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(2, 50.0, 0.1), (2, 50.0, 0.1), (4, 46.0, None), (5, None, 0.1), (None, 1.0, 0.1)], "l_orderkey long, l_quantity double, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = queries.set_ops(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "known"), (1, "left"), (2, "both"), (2, "known"), (3, "left"), (4, "known"), (None, "both")]
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
