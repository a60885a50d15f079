"""Silver → gold star schema: three dimensions and the fact table.

Dimension values for all three dimensions come from one pass over silver:
season, both team columns and the date are stacked into (kind, value) pairs and
de-duplicated with a partial (map-side) aggregation, so the shuffle carries at
most one row per distinct value per task, whatever the fact size or skew.

The fact joins its dimensions on natural keys (inner joins, as the reference:
rows with an unmatched or NULL key drop) and is numbered with ``counted_ids`` in
``(match_date, home_team)`` order.  Inside such a group the order is that of an MD5
over the fact's other columns, so the numbering is total (rows tying on it are
identical) and its sort key has three columns and the row identity, however many
measures there are.  The order is applied to the fact's own keys: ``date_id`` is
monotone in the date and ``team_id`` is assigned in name order.  ``match_id`` is
stored with the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.functions.calendar import date_key, is_weekend, iso_week, weekday_name
from pitchhouse.functions.season import (season_end_year, season_start_year,
                                         season_start_year_as_written)
from pitchhouse.operators.joins import bounded_broadcast
from pitchhouse.operators.keys import counted_ids, dense_ids, materialize, surrogate_ids

# The fact's measures and codes.
FACT_MEASURES = [
    "home_goals", "away_goals", "result", "home_goals_ht", "away_goals_ht", "result_ht",
    "home_shots", "away_shots", "home_shots_on_target", "away_shots_on_target",
    "home_fouls", "away_fouls", "home_corners", "away_corners",
    "home_yellow_cards", "away_yellow_cards", "home_red_cards", "away_red_cards",
]
FACT_COLUMNS = ["match_id", "season_id", "team_id_home", "team_id_away", "date_id", *FACT_MEASURES]
_REST = "_ph_rest"
FACT_KEY_ORDER = ["date_id", "team_id_home", _REST]
# what the digest inside a (date, home team) group covers, NULL as '~'
REST_COLUMNS = ["season_id", "team_id_away", *FACT_MEASURES]


@dataclass
class Dimensions:
    season: DataFrame
    team: DataFrame
    date: DataFrame
    season_rows: int
    team_rows: int
    date_rows: int


def dimension_values(silver: DataFrame) -> DataFrame:
    """Distinct (kind, value) pairs for season, team and date, one silver pass."""
    pairs = F.array(
        F.struct(F.lit("season").alias("kind"), F.col("season").alias("value")),
        F.struct(F.lit("team").alias("kind"), F.col("home_team").alias("value")),
        F.struct(F.lit("team").alias("kind"), F.col("away_team").alias("value")),
        F.struct(F.lit("date").alias("kind"), F.col("match_date").cast("string").alias("value")))
    return silver.select(F.inline(pairs)).distinct()


def dim_season_from(labels: DataFrame, as_written: bool = False,
                    rows: int | None = None) -> tuple[DataFrame, int]:
    """``labels`` has one column ``season_label`` (distinct).

    ``start_year`` is the label's first four characters; ``as_written=True``
    keeps the reference's ``'20' || LEFT(label, 2)``, which is 2020 for every
    20xx season.
    """
    numbered, rows = surrogate_ids(labels, ["season_label"], "season_id", "dim_season", rows,
                                   unique_order=True)
    start = season_start_year_as_written if as_written else season_start_year
    return numbered.select("season_id", "season_label",
                           start("season_label").alias("start_year"),
                           season_end_year("season_label").alias("end_year")), rows


def dim_team_from(names: DataFrame, rows: int | None = None) -> tuple[DataFrame, int]:
    """``names`` has one column ``team_name`` (distinct, NULL kept as a value)."""
    numbered, rows = surrogate_ids(names, ["team_name"], "team_id", "dim_team", rows,
                                   unique_order=True)
    return numbered.select("team_id", "team_name"), rows


def dim_date_from(dates: DataFrame) -> DataFrame:
    """``dates`` has one column ``full_date`` (distinct, no NULL)."""
    d = F.col("full_date")
    return dates.select(date_key(d).alias("date_id"), d.alias("full_date"),
                        F.year(d).cast("int").alias("year"), F.month(d).cast("int").alias("month"),
                        F.dayofmonth(d).cast("int").alias("day"), iso_week(d).alias("week_number"),
                        weekday_name(d).alias("day_of_week"), is_weekend(d).alias("is_weekend"))


def build_dimensions(silver: DataFrame, season_as_written: bool = False) -> Dimensions:
    values = materialize(dimension_values(silver), "dimension-values")
    sizes = {r["kind"]: r["n"] for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    kind, value = F.col("kind"), F.col("value")
    season, season_rows = dim_season_from(
        values.where(kind == "season").select(value.alias("season_label")), season_as_written,
        sizes.get("season", 0))
    team, team_rows = dim_team_from(values.where(kind == "team").select(value.alias("team_name")),
                                    sizes.get("team", 0))
    date = dim_date_from(values.where((kind == "date") & value.isNotNull())
                         .select(value.cast("date").alias("full_date")))
    return Dimensions(season, team, date, season_rows, team_rows, sizes.get("date", 0))


def dim_season(silver: DataFrame, as_written: bool = False) -> DataFrame:
    labels = silver.select(F.col("season").alias("season_label")).distinct()
    return dim_season_from(labels, as_written)[0]


def dim_team(silver: DataFrame) -> DataFrame:
    names = (silver.select(F.col("home_team").alias("team_name"))
             .union(silver.select(F.col("away_team").alias("team_name"))).distinct())
    return dim_team_from(names)[0]


def dim_date(silver: DataFrame) -> DataFrame:
    dates = silver.where(F.col("match_date").isNotNull()).select(
        F.col("match_date").alias("full_date")).distinct()
    return dim_date_from(dates)


def fact_matches(silver: DataFrame, season: DataFrame, team: DataFrame,
                 season_rows: int | None = None, team_rows: int | None = None,
                 order: list[str] | None = None,
                 partition_by: list[str] | None = ("season_id",),
                 row_id: str | None = "_row", silver_rows: int | None = None) -> DataFrame:
    """The fact table: surrogate key, four foreign keys, 18 measures/codes.

    The rows are stored (partitioned by ``season_id``) by the numbering pass.
    ``row_id``: a unique column of the stored silver rows that ends the
    numbering order (``None`` if ``silver`` has none).  ``silver_rows`` bounds
    the fact's size and sizes the numbering shuffle.
    """
    row_id = row_id if row_id in silver.columns else None
    ds = bounded_broadcast(season.select("season_id", F.col("season_label").alias("season")),
                           season_rows)
    home = bounded_broadcast(team.select(F.col("team_id").alias("team_id_home"),
                                         F.col("team_name").alias("home_team")), team_rows)
    away = bounded_broadcast(team.select(F.col("team_id").alias("team_id_away"),
                                         F.col("team_name").alias("away_team")), team_rows)
    rest = F.unhex(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in REST_COLUMNS])))
    joined = (silver.join(ds, "season").join(home, "home_team").join(away, "away_team")
              .select(*FACT_COLUMNS[1:4], date_key("match_date").alias("date_id"),
                      rest.alias(_REST), *FACT_MEASURES, *([row_id] if row_id else [])))
    number = counted_ids if row_id else dense_ids
    numbered = number(joined, order or FACT_KEY_ORDER, "match_id", keep=FACT_COLUMNS[1:],
                      partition_by=list(partition_by) if partition_by else None,
                      name="fact_matches", tiebreak=row_id, rows=silver_rows)
    return numbered.select(*FACT_COLUMNS)
