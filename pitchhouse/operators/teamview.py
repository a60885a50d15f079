"""Team grain: one row per (match, participating team).

The reference answers per-team questions with the disjunctive join
``dim_team t ON t.team_id IN (f.team_id_home, f.team_id_away)``.  Spark can
only plan that as a nested-loop or cartesian join, so the fact is unpivoted
instead: each match emits a home row and an away row (no shuffle, same stage as
the scan) and per-team work becomes an equi-join / group-by on ``team_id``.

``IN (home, away)`` yields a single row when home = away, so such a match emits
only the home row, with both ``is_home`` and ``is_away`` true.  With

* ``win  = is_home AND result = 'H' OR is_away AND result = 'A'``
* ``loss = is_home AND result = 'A' OR is_away AND result = 'H'``

every CASE of the reference's queries is reproduced, including a decided
self-match counting as one win and one loss.  Role-dependent measures
(goals for, shots, …) read such a row as the home side, as the reference's
first-branch CASEs do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# measure name → (column when the team is at home, column when it is away)
MEASURES = {
    "gf": ("home_goals", "away_goals"),
    "ga": ("away_goals", "home_goals"),
    "shots_on_target": ("home_shots_on_target", "away_shots_on_target"),
    "corners": ("home_corners", "away_corners"),
    "yellows": ("home_yellow_cards", "away_yellow_cards"),
    "reds": ("home_red_cards", "away_red_cards"),
    "shots": ("home_shots", "away_shots"),
    "shots_on_target_against": ("away_shots_on_target", "home_shots_on_target"),
    "corners_against": ("away_corners", "home_corners"),
    "yellows_against": ("away_yellow_cards", "home_yellow_cards"),
}

# Outcome codes of the match log and venue labels.
WIN, DRAW, LOSS = "W", "D", "L"
HOME, AWAY = "Home", "Away"


def team_view(fact: DataFrame, measures: tuple[str, ...] = ("gf", "ga"),
              keep: tuple[str, ...] = ("match_id", "season_id", "date_id")) -> DataFrame:
    """Unpivot ``fact`` to team grain.

    Output: ``keep`` columns, ``team_id``, ``opponent_id``, ``is_home``,
    ``is_away``, ``result``, ``win``, ``draw``, ``loss``, ``outcome``, ``venue``
    and the requested ``measures``.  Only the columns asked for are read.
    """
    home_id, away_id = F.col("team_id_home"), F.col("team_id_away")
    same = home_id == away_id

    def side(is_home: bool) -> Column:
        fields = [(home_id if is_home else away_id).alias("team_id"),
                  (away_id if is_home else home_id).alias("opponent_id"),
                  F.lit(is_home).alias("is_home"),
                  (F.coalesce(same, F.lit(False)) if is_home else F.lit(True)).alias("is_away")]
        for m in measures:
            home_col, away_col = MEASURES[m]
            fields.append(F.col(home_col if is_home else away_col).alias(m))
        return F.struct(*fields)

    sides = F.when(same, F.array(side(True))).otherwise(F.array(side(True), side(False)))
    rows = fact.select(*keep, "result", F.inline(sides))
    # NULL keys never match a dimension row in the reference's IN join.
    rows = rows.where(F.col("team_id").isNotNull())
    res = F.col("result")
    win = F.coalesce((F.col("is_home") & (res == "H")) | (F.col("is_away") & (res == "A")), F.lit(False))
    loss = F.coalesce((F.col("is_home") & (res == "A")) | (F.col("is_away") & (res == "H")), F.lit(False))
    draw = F.coalesce(res == "D", F.lit(False))
    return rows.select(
        *keep, "team_id", "opponent_id", "is_home", "is_away", "result",
        win.alias("win"), draw.alias("draw"), loss.alias("loss"),
        F.when(win, F.lit(WIN)).when(draw, F.lit(DRAW)).otherwise(F.lit(LOSS)).alias("outcome"),
        F.when(F.col("is_home"), F.lit(HOME)).otherwise(F.lit(AWAY)).alias("venue"),
        *measures)
