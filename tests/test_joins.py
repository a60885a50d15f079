"""Size-driven choices: broadcast only within a checked bound, bounded sorts."""

from pyspark.sql import functions as F

from pitchhouse.operators.joins import bounded_broadcast, ordered, row_counts


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no implicit broadcasts
    try:
        big = spark.range(2000).withColumnRenamed("id", "k")
        small = spark.range(50).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, 50, max_rows=100), "k"))
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, None, max_rows=100), "k"))
        # bound unknown or too large and the counted size over the limit: no hint
        joined = big.join(bounded_broadcast(small, 10**9, max_rows=10), "k")
        p = _plan(joined)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordered_sorts_small_results_in_one_partition(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g")).groupBy("g").count()
    bounded = ordered(df, [F.col("g").asc()], upper_bound=7)
    assert [r["g"] for r in bounded.collect()] == list(range(7))
    assert "rangepartitioning" not in _plan(bounded)
    unbounded = ordered(df, [F.col("g").asc()])
    assert [r["g"] for r in unbounded.collect()] == list(range(7))
    assert "rangepartitioning" in _plan(unbounded)


def test_a_known_bound_is_never_counted(spark):
    class Uncounted:
        def count(self):
            raise AssertionError("counted")

    side = Uncounted()
    assert bounded_broadcast(side, 10**9, max_rows=10) is side


def test_bounded_sort_leaves_the_aggregate_parallel(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g")).groupBy("g").count()
    p = ordered(df, [F.col("g").asc()], upper_bound=7)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in p and p.index("SinglePartition") < p.index("HashAggregate")


def test_row_counts(spark):
    a, b = spark.range(3), spark.range(11)
    assert row_counts({"a": a, "b": b}) == {"a": 3, "b": 11}
