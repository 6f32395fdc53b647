"""Checked dimension broadcast."""

from ledgerline.operators.joins import BROADCAST_ROWS_CONF, join_dimension


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_cap(spark):
    fact = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
    dim = spark.range(10).selectExpr("id AS k", "id * 2 AS w")
    assert "BroadcastHashJoin" in _plan(join_dimension(fact, dim, "k", dim_rows=10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set(BROADCAST_ROWS_CONF, "5")
        assert "BroadcastHashJoin" not in _plan(join_dimension(fact, dim, "k", dim_rows=10))
        assert "BroadcastHashJoin" not in _plan(join_dimension(fact, dim, "k"))
    finally:
        spark.conf.unset(BROADCAST_ROWS_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
