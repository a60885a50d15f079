"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each callable reads the driver tables in ``sf_dir`` — through the memoised
gold build where it needs the star schema, or the bridge's silver rows for
the bronze/silver operators — and runs over the whole tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchhouse import oracle_sql as O
from pitchhouse.functions.season import season_start_year_as_written
from pitchhouse.operators.keys import materialize
from pitchhouse.operators.quality import integrity_by_group, row_count_integrity
from pitchhouse.plans import analytics as A
from pitchhouse.plans import bronze as B
from pitchhouse.plans import dashboard as D
from pitchhouse.plans import data_tests as T
from pitchhouse.plans.gold import FACT_MEASURES
from pitchhouse.plans.silver import (SOURCE_TO_SILVER, bronze_view, bronze_view_sql, cleaned, near_copies, silver_view,
                                     silver_view_sql)
from pitchhouse.plans.warehouse import Gold, sources, warehouse
from pitchhouse.session import work_dir
from pitchhouse.sources.bridge import source_rows
from pitchhouse.sources.csv_bronze import columns_of_files, csv_headers, land_csv
from pitchhouse.sources.inference import file_types, joined_types, typed
from pitchhouse.sources.layers import create_view, ensure_layers, write_table

TEAM, OPP, SEASON = O.TEAM, O.OPPONENT, O.SEASON
QueryFn = Callable[[SparkSession, str], DataFrame]


def _gold(fn: Callable[..., DataFrame], *args, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse(spark, sf_dir), *args, **kw)
    return run


def _bronze(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    """Bronze operators over the stored source rows."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(sources(spark, sf_dir).bronze)
    return run


def _csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows written as real CSV files (two header generations), then
    landed by header group and merged by column name."""
    pattern = B.write_source_files(sources(spark, sf_dir).source, work_dir(spark, "raw-csv"))
    return land_csv(spark, pattern, source_name="directory").drop("_loaded_at")


def _odd_csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a last column that has no name and values over two lines."""
    pattern = B.write_source_files(sources(spark, sf_dir).source, work_dir(spark, "raw-csv"), odd=True)
    return land_csv(spark, pattern, source_name="directory").drop("_loaded_at")


def _typed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files with the types inferred over all their values; the two columns
    that only some files have are shown as doubles, whose gaps every client reads alike."""
    gaps = {c: F.col(f"`{c}`").cast("double") for c in (B.OLD_ONLY, B.NEW_ONLY)}
    return typed(*_landed(spark, sf_dir)).withColumns(gaps)


def _inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of each column, and what it was in the files that have it."""
    raw, present = _landed(spark, sf_dir)
    kinds = file_types(raw, present)
    per_kind = kinds.groupBy("column").agg(F.count(F.lit(1)).alias("files"), F.count_distinct("kind").alias("kinds"))
    return joined_types(kinds).join(per_kind, "column")


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pattern = B.write_source_files(sources(spark, sf_dir).source, work_dir(spark, "raw-csv"))
    raw = materialize(land_csv(spark, pattern, source_name="directory").drop("_loaded_at"), "bronze-text")
    return raw, columns_of_files(csv_headers(spark, pattern), "directory")


def _silver_sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persistent silver view over the bronze view over the landed catalog table."""
    mine = "pitchhouse_" + hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    ensure_layers(spark, [mine], location=work_dir(spark, "catalog"))
    raw = write_table(sources(spark, sf_dir).bronze, name=f"{mine}.matches_raw")
    create_view(spark, bronze_view_sql(raw.columns, f"{mine}.matches_raw"), f"{mine}.bronze_matches")
    return create_view(spark, silver_view_sql(f"{mine}.bronze_matches"), f"{mine}.silver_matches")


def _source_integrity(lossy: bool) -> QueryFn:
    """Bronze text against silver, read from it and written out as text again, for
    every season and file; ``lossy`` loses some of silver's rows and doubles others."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze = sources(spark, sf_dir).bronze
        silver = silver_view(bronze_view(bronze))
        if lossy:
            lost = (F.col("season") == O.SEASON) & (F.col("home_team") == TEAM) & (F.col("away_team") == OPP)
            doubled = (F.col("home_team") == OPP) & (F.col("away_team") == TEAM)
            silver = silver.where(~F.coalesce(lost, F.lit(False))).unionByName(silver.where(doubled))
        return integrity_by_group(bronze, source_rows(silver), ["season", "_source_file"], list(SOURCE_TO_SILVER),
                                  ("bronze", "silver"))
    return run


def _gold_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver against the fact with its keys turned back into names, by season."""
    g = warehouse(spark, sf_dir)
    named = (g.fact.join(g.dim_season.select("season_id", F.col("season_label").alias("season")), "season_id")
             .join(g.dim_team.select(F.col("team_id").alias("team_id_home"), F.col("team_name").alias("home_team")), "team_id_home")
             .join(g.dim_team.select(F.col("team_id").alias("team_id_away"), F.col("team_name").alias("away_team")), "team_id_away")
             .join(g.dim_date.select("date_id", F.col("full_date").alias("match_date")), "date_id", "left"))
    columns = ["match_date", "home_team", "away_team", *FACT_MEASURES]
    return integrity_by_group(g.silver, named, ["season"], columns, ("silver", "gold"))


def _relationships(dirty: bool) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        g = warehouse(spark, sf_dir)
        team = g.dim_team.where(F.col("team_name") != TEAM) if dirty else g.dim_team
        season = g.dim_season.where(F.col("season_label") != SEASON) if dirty else g.dim_season
        return T.relationship_report(g, season=season, team=team)
    return run


def _completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = warehouse(spark, sf_dir)
    return B.completeness(g.bronze, groups_bound=g.season_rows)


def _projection(b: DataFrame) -> DataFrame:
    return bronze_view(b).drop("_loaded_at")


def _silver(b: DataFrame) -> DataFrame:
    return silver_view(bronze_view(b))


def _dim_season_as_written(g: Gold) -> DataFrame:
    return g.dim_season.select("season_id", "season_label",
                               season_start_year_as_written("season_label").alias("start_year"),
                               "end_year")


def _integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = warehouse(spark, sf_dir)
    return row_count_integrity(g.bronze, g.fact)


def _dirty_report(g: Gold) -> DataFrame:
    tables = T.gold_tables(g)
    tables["fact_matches"] = T.dirty_fact(g.fact)
    return T.gold_test_report(g, tables=tables)


def queries() -> dict[str, QueryFn]:
    return {
        # bronze / silver
        "bronze_union_by_name": _bronze(lambda b: b),
        "bronze_csv_landing": _csv_landing,
        "bronze_odd_csv_landing": _odd_csv_landing,
        "bronze_typed_landing": _typed_landing,
        "bronze_inferred_types": _inferred_types,
        "season_from_filename": _bronze(B.season_from_file),
        "bronze_projection": _bronze(_projection),
        "silver_matches": _bronze(_silver),
        "silver_matches_cleaned": _bronze(lambda b: silver_view(bronze_view(b), trim_text=True).dropDuplicates()),
        "silver_survivors": _bronze(lambda b: cleaned(near_copies(_silver(b)))),
        "silver_sql_view": _silver_sql_view,
        "load_report": _bronze(B.load_report),
        "completeness_by_season": _completeness,
        "sample_rows": _bronze(B.sample_rows),
        # gold tables
        "dim_season": _gold(lambda g: g.dim_season),
        "dim_season_as_written": _gold(_dim_season_as_written),
        "dim_team": _gold(lambda g: g.dim_team),
        "dim_date": _gold(lambda g: g.dim_date),
        "fact_matches": _gold(lambda g: g.fact),
        "role_playing_names": _gold(A.role_playing_names),
        # analytic queries
        "season_summary": _gold(A.season_summary),
        "team_performance": _gold(A.team_performance),
        "home_away_advantage": _gold(A.home_away_advantage, O.MIN_MATCHES),
        "monthly_goals": _gold(A.monthly_goals),
        "top_team_seasons": _gold(A.top_team_seasons, O.TOP),
        # dashboard frames
        "league_overview": _gold(D.league_overview),
        "latest_season_kpis": _gold(D.latest_season_kpis),
        "result_distribution": _gold(D.result_distribution),
        "team_match_log": _gold(D.team_match_log, TEAM),
        "team_match_log_season": _gold(D.team_match_log, TEAM, SEASON),
        "team_kpis": _gold(D.team_kpis, TEAM),
        "team_kpis_season": _gold(D.team_kpis, TEAM, SEASON),
        "team_result_breakdown": _gold(D.team_result_breakdown, TEAM),
        "team_result_breakdown_season": _gold(D.team_result_breakdown, TEAM, SEASON),
        "team_goals_by_season": _gold(D.team_goals_by_season, TEAM),
        "team_goals_by_season_season": _gold(D.team_goals_by_season, TEAM, SEASON),
        "team_venue_split": _gold(D.team_venue_split, TEAM),
        "team_venue_split_season": _gold(D.team_venue_split, TEAM, SEASON),
        "head_to_head": _gold(D.head_to_head, TEAM, OPP),
        "head_to_head_season": _gold(D.head_to_head, TEAM, OPP, SEASON),
        "head_to_head_as_written": _gold(D.head_to_head, TEAM, OPP, SEASON, as_written=True),
        "head_to_head_summary": _gold(D.head_to_head_summary, TEAM, OPP),
        "head_to_head_win_share": _gold(D.head_to_head_win_share, TEAM, OPP),
        "head_to_head_avg_stats": _gold(D.head_to_head_avg_stats, TEAM, OPP),
        **{f"{fn.__name__}_{form}": _gold(fn, TEAM, OPP, SEASON, as_written=form == "as_written")
           for fn in (D.head_to_head_summary, D.head_to_head_win_share, D.head_to_head_avg_stats)
           for form in ("season", "as_written")},
        "pick_list_teams": _gold(D.pick_list_teams),
        "pick_list_seasons": _gold(D.pick_list_seasons),
        # data quality
        "row_count_integrity": _integrity,
        "integrity_by_source": _source_integrity(False),
        "integrity_by_source_lossy": _source_integrity(True),
        "integrity_gold": _gold_integrity,
        "dq_relationships": _relationships(False),
        "dq_relationships_dirty": _relationships(True),
        "dq_unique": _gold(T.gold_test_report, ("unique",)),
        "dq_not_null": _gold(T.gold_test_report, ("not_null",)),
        "dq_accepted_values": _gold(T.gold_test_report, ("accepted_values",)),
        "dq_report": _gold(T.gold_test_report),
        "dq_report_dirty": _gold(_dirty_report),
    }


def oracle_sql() -> dict[str, str]:
    names = queries().keys()
    return {k: v for k, v in O.Q.items() if k in names}
