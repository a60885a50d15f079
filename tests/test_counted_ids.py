"""Numbering by exact counts of the order's first column: one write, no sample."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from pitchhouse.operators import keys
from pitchhouse.plans.warehouse import build_gold
from tests.fixtures import SCHEMA, silver_row


def _numbers(df, **kw):
    got = keys.counted_ids(df, ["day", "v"], "id", ["day", "v", "u"], "u", **kw).collect()
    rows = sorted(((r.day, r.v, r.u) for r in df.collect()), key=lambda r: [(x is None, x) for x in r])
    assert sorted((r.id, r.day, r.v, r.u) for r in got) == [(i, *r) for i, r in enumerate(rows, 1)]


def test_numbers_equal_the_global_order(spark, monkeypatch):
    """Null and many values of the first column, few values, one that fills a partition, none."""
    sampled = []
    monkeypatch.setattr(keys, "dense_ids", lambda *a, _f=keys.dense_ids: sampled.append(1) or _f(*a))
    schema = "day int, v int, u long"
    even = [(None if i % 40 == 7 else i % 40, (i * 7) % 13 if i % 5 else None, i) for i in range(800)]
    df = spark.createDataFrame(even, schema).repartition(5)
    for n in (1, 3, 6):
        _numbers(df, num_partitions=n)
    _numbers(spark.createDataFrame([], schema), num_partitions=3)
    assert not sampled
    _numbers(spark.createDataFrame([(3 if i % 2 else i % 9, i % 4, i) for i in range(300)], schema), num_partitions=4)
    assert sampled  # half of the rows have one day: its rows are split by ranges


def test_fact_is_written_once(spark):
    rows = [silver_row("2022-23", dt.date(2022, 8, 1) + dt.timedelta(days=i % 100), f"T{i % 7}", f"T{(i + 3) % 7}", i % 4, i % 3, "H")
            for i in range(1000)]
    g = build_gold(spark.createDataFrame(rows, SCHEMA))
    first = g.fact.inputFiles()[0].replace("file:", "").replace("//", "")
    tables = first.split("/tables/")[0] + "/tables"
    name = first.split("/tables/")[1].split("/")[0]
    later = [t for t in glob.glob(os.path.join(tables, "fact_matches-rows-*")) if os.path.getmtime(t) > os.path.getmtime(
        max(glob.glob(os.path.join(tables, "silver-*")), key=os.path.getmtime))]
    assert name.startswith("fact_matches-numbered") and not later
    ids = [r.match_id for r in g.fact.orderBy("date_id", "team_id_home", "match_id").select("match_id").collect()]
    assert ids == list(range(1, 1001)) and g.fact.where(F.col("season_id").isNull()).count() == 0
