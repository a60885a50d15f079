"""Surrogate keys: the distributed two-pass numbering equals a global ROW_NUMBER."""

import random

from pyspark.sql import functions as F

from pitchhouse.operators.keys import dense_ids, small_ids, surrogate_ids


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one hot key
        k = "hot" if i % 3 == 0 else f"k{rnd.randint(0, 200):03d}"
        rows.append((k, rnd.choice([None, rnd.randint(0, 50)]), i))
    return spark.createDataFrame(rows, "k string, v int, u int")


def _expected(rows):
    key = lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] if r[1] is not None else 0, r[2])
    return {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=key))}


def test_dense_ids_equal_global_row_number(spark):
    df = _frame(spark)
    got = {r["u"]: r["id"] for r in dense_ids(df, ["k", "v", "u"], "id", num_partitions=6).collect()}
    assert got == _expected([tuple(r) for r in df.collect()])


def test_dense_ids_with_ties_are_a_permutation_in_order(spark):
    df = _frame(spark).select("k", "v")
    out = dense_ids(df, ["k"], "id", num_partitions=5).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(1, df.count() + 1))
    keys = [r["k"] for r in out]
    assert keys == sorted(keys)


def test_hot_key_is_split_over_partitions(spark):
    df = _frame(spark).where(F.col("k") == "hot").select("k")  # every row identical
    out = dense_ids(df, ["k"], "id", num_partitions=4)
    assert sorted(r["id"] for r in out.collect()) == list(range(1, 1001))


def test_small_ids_and_size_check(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "name string")
    assert [(r["id"], r["name"]) for r in small_ids(df, ["name"], "id").orderBy("id").collect()] == [
        (1, "a"), (2, "b"), (3, None)]
    numbered, n = surrogate_ids(df, ["name"], "id")
    assert n == 3 and numbered.count() == 3


def test_range_partitions_grow_with_rows(spark):
    from pitchhouse.operators.keys import range_partitions
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(spark, None) == base
    assert range_partitions(spark, 10) == base
    assert range_partitions(spark, 10**12) == 10**12 // 4_000_000
    spark.conf.set("pitchhouse.keys.rowsPerPartition", "10")
    try:
        assert range_partitions(spark, 1000) == max(base, 100)
        df = spark.range(1000).withColumnRenamed("id", "v")
        out = dense_ids(df, ["v"], "id", rows=1000)
        assert sorted(r["id"] for r in out.collect()) == list(range(1, 1001))
    finally:
        spark.conf.unset("pitchhouse.keys.rowsPerPartition")


def test_large_dimension_path_is_deterministic(spark):
    spark.conf.set("pitchhouse.broadcast.maxRows", "5")  # force the distributed path
    try:
        names = spark.createDataFrame([(f"team{i:03d}",) for i in range(50)] + [(None,)], "team_name string")
        numbered, n = surrogate_ids(names, ["team_name"], "team_id", unique_order=True)
        got = [(r["team_id"], r["team_name"]) for r in numbered.orderBy("team_id").collect()]
    finally:
        spark.conf.unset("pitchhouse.broadcast.maxRows")
    assert n == 51
    assert got == [(i + 1, f"team{i:03d}") for i in range(50)] + [(51, None)]
