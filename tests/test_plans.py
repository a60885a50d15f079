"""Plan shape: no cartesian / nested-loop join for the IN join, pruned scans,
and no fact-wide single-partition exchange in the key assignment."""

import pytest

from pitchhouse.plans import analytics as A
from pitchhouse.plans import dashboard as D
from pitchhouse.plans.warehouse import warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark):
    return warehouse(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fn", [A.team_performance, A.home_away_advantage, A.top_team_seasons,
                                lambda g: D.team_match_log(g, "NATION_3")])
def test_in_join_is_an_equi_join(gold, fn):
    p = plan(fn(gold))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fact_scan_is_pruned(gold):
    p = plan(A.season_summary(gold))
    scan = [line for line in p.splitlines() if "FileScan" in line and "home_goals" in line]
    assert scan, p
    read_schema = scan[0].split("ReadSchema:")[1]
    assert "home_goals" in read_schema
    for unused in ("home_fouls", "home_corners", "team_id_home"):
        assert unused not in read_schema


def test_fact_read_has_no_single_partition_exchange(gold):
    # the gold fact is written and read back; aggregations over it shuffle by key only
    p = plan(A.team_performance(gold))
    assert "Coalesce 1" not in p
    # only the final, aggregated rows meet in one partition, to be sorted
    assert p.count("SinglePartition") == 1 and p.index("SinglePartition") < p.index("HashAggregate")


@pytest.mark.parametrize("fn", [lambda g: D.team_match_log(g, "NATION_3"), lambda g: D.team_kpis(g, "NATION_3"),
                                lambda g: D.head_to_head_summary(g, "NATION_3", "NATION_7")])
def test_team_is_filtered_below_the_unpivot(gold, fn):
    lines = plan(fn(gold)).splitlines()
    unpivot = next(i for i, x in enumerate(lines) if "Generate inline" in x)
    assert any("Filter" in x and "team_id_home" in x and "team_id_away" in x and "subquery" in x.lower()
               for x in lines[unpivot + 1:])


def test_season_filter_prunes_fact_partitions(gold):
    df = D.team_match_log(gold, "NATION_3", "1997-98")
    df.collect()
    p = plan(df)
    assert "dynamicpruningexpression(season_id" in p


def test_top_k_per_season_uses_window_group_limit(gold):
    df = A.top_team_seasons(gold)
    df.collect()
    assert "WindowGroupLimit" in plan(df)


def test_bronze_queries_build_no_gold(spark, tmp_dir, monkeypatch):
    import os
    from pitchhouse import registry
    from pitchhouse.plans import warehouse as W
    fresh = os.path.join(tmp_dir, "sf")  # a folder that no other test has built from
    os.symlink("/root/testdata/sf0.001", fresh)
    monkeypatch.setattr(W, "build_gold", lambda *a, **k: pytest.fail("gold was built"))
    for name in ("bronze_csv_landing", "silver_sql_view", "silver_matches", "load_report"):
        assert registry.queries()[name](spark, fresh).count() > 0
