"""A third of all matches are copies of one match (same date, teams, score):
the gold build still numbers every row and spreads the copies over the range
partitions; per-team totals stay exact."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pitchhouse.plans import analytics as A
from pitchhouse.plans.warehouse import build_gold
from tests.fixtures import SCHEMA, silver_row


def test_hot_group_is_numbered_and_split(spark):
    rows = []
    for i in range(3000):
        if i % 3 == 0:  # the hot group: identical rows
            rows.append(silver_row("2022-23", dt.date(2022, 9, 1), "Hot", "Cold", 1, 0, "H"))
        else:
            rows.append(silver_row("2022-23", dt.date(2022, 8, 1) + dt.timedelta(days=i % 200),
                                   f"T{i % 7}", f"T{(i + 3) % 7}", i % 4, i % 3,
                                   "H" if i % 4 > i % 3 else ("A" if i % 4 < i % 3 else "D")))
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        g = build_gold(spark.createDataFrame(rows, SCHEMA))
        ids = sorted(r["match_id"] for r in g.fact.select("match_id").collect())
        # where the numbering's shuffle put the hot rows: its stored partition ids
        files = [f.replace("file:", "") for f in g.fact.inputFiles() if "season_id=" in f]
        tables = glob.glob(os.path.join(files[0].split("/tables/")[0], "tables", "fact_matches-rows-*"))
        hot_parts = set()
        for f in glob.glob(os.path.join(max(tables, key=os.path.getmtime), "*.parquet")):
            t = pq.read_table(f, columns=["team_id_home", "_ph_pid"])
            hot_id = g.dim_team.where(F.col("team_name") == "Hot").first()["team_id"]
            hot_parts |= {p for h, p in zip(t.column(0).to_pylist(), t.column(1).to_pylist()) if h == hot_id}
        perf = {r["team_name"]: r for r in A.team_performance(g).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ids == list(range(1, 3001))
    assert len(hot_parts) >= 2  # 1000 identical rows did not land in one task
    assert (perf["Hot"]["total_matches"], perf["Hot"]["wins"], perf["Hot"]["goals_scored"]) == (1000, 1000, 1000)
    assert os.path.isdir(os.path.dirname(files[0]))
    assert glob.glob(os.path.join(os.path.dirname(os.path.dirname(files[0])), "season_id=*"))
