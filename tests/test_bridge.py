"""The bridge gives the same silver rows whichever join order its size checks pick."""

from pitchhouse.sources.bridge import silver_from_tables

SF = "/root/testdata/sf0.001"


def test_join_order_fallback_gives_same_rows(spark):
    small = sorted(map(tuple, silver_from_tables(spark, SF).collect()))
    spark.conf.set("pitchhouse.broadcast.maxRows", "10")  # nothing counts as small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # nor does Spark broadcast by itself
    try:
        df = silver_from_tables(spark, SF)
        big = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.unset("pitchhouse.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert big == small and len(small) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
