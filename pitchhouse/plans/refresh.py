"""The reference's whole workflow as one full refresh.

1. land every CSV file into ``bronze.matches_raw`` (replaced each run);
2. expose the bronze and silver views over it;
3. build the gold star schema and publish it as catalog tables
   ``gold.dim_season``, ``gold.dim_team``, ``gold.dim_date`` and
   ``gold.fact_matches`` (the fact partitioned by ``season_id``);
4. run the 13 declared data tests.

Every step replaces its output, so running it twice gives the same tables; a table
is swapped whole, so readers see the rows of one run.  The views are persistent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitchhouse.plans import data_tests
from pitchhouse.plans.silver import bronze_view_sql, silver_view_sql
from pitchhouse.plans.warehouse import Gold, build_gold
from pitchhouse.sources.csv_bronze import land_csv
from pitchhouse.sources.layers import create_view, write_table


@dataclass
class Refresh:
    gold: Gold
    tests: DataFrame


def full_refresh(spark: SparkSession, csv_pattern: str, source_name: str = "file") -> Refresh:
    raw = write_table(land_csv(spark, csv_pattern, source_name), name="bronze.matches_raw")
    create_view(spark, bronze_view_sql(raw.columns, "bronze.matches_raw"), "bronze.bronze_matches")
    silver = create_view(spark, silver_view_sql("bronze.bronze_matches"), "silver.silver_matches")
    built = build_gold(silver)
    gold = Gold(
        dim_season=write_table(built.dim_season, name="gold.dim_season"),
        dim_team=write_table(built.dim_team, name="gold.dim_team"),
        dim_date=write_table(built.dim_date, name="gold.dim_date"),
        fact=write_table(built.fact, name="gold.fact_matches", partition_by=["season_id"]),
        season_rows=built.season_rows, team_rows=built.team_rows, date_rows=built.date_rows,
        silver=built.silver)
    return Refresh(gold, data_tests.gold_test_report(gold))
