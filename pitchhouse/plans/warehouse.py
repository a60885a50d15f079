"""Build and hold the gold layer.

``build_gold`` runs the reference's model DAG in dependency order: the three
dimensions from one silver pass, then the fact.  Each gold table is stored as
Parquet under the session's checkpoint folder (the fact partitioned by
``season_id``, so a season filter joined through ``dim_season`` prunes files
by dynamic partition pruning) and read back, so every analytic query starts
from stored tables exactly as the reference's queries do.

``warehouse(spark, sf_dir)`` memoises one build per (application, source dir).
``sources`` stores the driver tables' source rows as text first; bronze is read from
those, silver from bronze, and gold from silver, so a row lost on the way shows.
Queries over bronze take ``sources`` alone and build no gold.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitchhouse.operators.keys import materialize
from pitchhouse.plans import gold as G
from pitchhouse.session import work_dir
from pitchhouse.sources.layers import write_table


@dataclass
class Gold:
    dim_season: DataFrame
    dim_team: DataFrame
    dim_date: DataFrame
    fact: DataFrame
    season_rows: int
    team_rows: int
    date_rows: int
    silver: DataFrame | None = None  # the stored silver rows the build read
    source: DataFrame | None = None  # the stored source rows, all text
    bronze: DataFrame | None = None  # both generations of them, merged by name


#: A unique stored column of the rows that gold is built from.
ROW_ID = "_row"


def build_gold(silver: DataFrame, name: str = "gold") -> Gold:
    spark = silver.sparkSession
    root = work_dir(spark, name)
    # silver is read twice (dimension values: four columns; fact: all): unless it
    # is a view over stored rows that brings their identity along, it is stored
    # once.  That identity ends the fact's numbering order
    if ROW_ID not in silver.columns:
        silver = materialize(silver, "silver", row_id=ROW_ID)
    silver_rows = silver.count()  # Parquet footers only; sizes the fact's numbering
    dims = G.build_dimensions(silver)
    season = write_table(dims.season, path=f"{root}/dim_season")
    team = write_table(dims.team, path=f"{root}/dim_team")
    date = write_table(dims.date, path=f"{root}/dim_date")
    # stored by the numbering pass, partitioned by season_id
    fact = G.fact_matches(silver, season, team, dims.season_rows, dims.team_rows,
                          silver_rows=silver_rows)
    return Gold(season, team, date, fact, dims.season_rows, dims.team_rows, dims.date_rows, silver)


@dataclass
class Sources:
    source: DataFrame  # the stored source rows, all text
    bronze: DataFrame  # both generations of them, merged by name
    rows: DataFrame    # the stored rows with their identity


_LOCK = threading.RLock()
_SOURCES: dict[tuple[str, str], Sources] = {}
_BUILDS: dict[tuple[str, str], Gold] = {}


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The source rows of the driver tables in ``sf_dir``, stored as text (memoised):
    all that bronze and the views over it need."""
    from pitchhouse.plans.bronze import bronze_from_source, with_generation
    from pitchhouse.sources.bridge import silver_from_tables, source_rows

    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _SOURCES:
            rows = materialize(with_generation(source_rows(silver_from_tables(spark, sf_dir))), "source-rows",
                               row_id=ROW_ID, codec="snappy")
            source = rows.drop(ROW_ID)
            _SOURCES[key] = Sources(source, bronze_from_source(source), rows)
        return _SOURCES[key]


def warehouse(spark: SparkSession, sf_dir: str) -> Gold:
    """The gold layer built from the driver tables in ``sf_dir`` (memoised)."""
    from pitchhouse.plans.bronze import bronze_from_source
    from pitchhouse.plans.silver import bronze_view, silver_view

    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _BUILDS:
            stored = sources(spark, sf_dir)
            keep = (ROW_ID,)
            built = build_gold(silver_view(bronze_view(bronze_from_source(stored.rows), keep), keep=keep))
            built.source, built.bronze = stored.source, stored.bronze
            _BUILDS[key] = built
        return _BUILDS[key]
