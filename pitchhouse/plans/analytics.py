"""The five analytic queries and the role-playing read-back.

Every query aggregates the fact (or its team-grain unpivot) on integer keys
first — a partial, map-side aggregation, so a hot season or team never
concentrates fact rows in one task — and only then joins the few aggregated
rows to dimension names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.functions.parity import asc, desc, pct, ratio, round_half_away
from pitchhouse.operators.joins import bounded_broadcast, ordered
from pitchhouse.operators.teamview import team_view
from pitchhouse.plans.warehouse import Gold


def _count_when(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _season_totals(fact: DataFrame, extra: dict | None = None) -> DataFrame:
    """Per season_id: match count, goal sum/avg inputs, result counts."""
    goals = F.col("home_goals") + F.col("away_goals")
    aggs = [F.count("match_id").alias("total_matches"),
            F.count(F.lit(1)).alias("_rows"),
            F.sum(goals).alias("total_goals"),
            F.count(goals).alias("_goal_rows"),
            _count_when(F.col("result") == "H").alias("home_wins"),
            _count_when(F.col("result") == "D").alias("draws"),
            _count_when(F.col("result") == "A").alias("away_wins")]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return fact.groupBy("season_id").agg(*aggs)


def season_summary(g: Gold) -> DataFrame:
    """Per season matches, goals, average goals, H/D/A counts, home win %."""
    t = _season_totals(g.fact).join(g.dim_season.select("season_id", "season_label"), "season_id")
    return ordered(t.select(
        "season_label", "total_matches", "total_goals",
        round_half_away(ratio("total_goals", "_goal_rows"), 2).alias("avg_goals_per_match"),
        "home_wins", "draws", "away_wins",
        round_half_away(pct("home_wins", "_rows"), 1).alias("home_win_pct"),
    ), asc("season_label"), g.season_rows)


def team_totals(g: Gold, keys=("team_id",)) -> DataFrame:
    """Per team (and optional extra keys): matches, W/D/L, goals for/against."""
    tv = team_view(g.fact, ("gf", "ga"), keep=("match_id", "season_id"))
    return tv.groupBy(*keys).agg(
        F.count("match_id").alias("total_matches"),
        _count_when(F.col("win")).alias("wins"),
        _count_when(F.col("draw")).alias("draws"),
        _count_when(F.col("loss")).alias("losses"),
        F.sum("gf").alias("goals_scored"),
        F.sum("ga").alias("goals_conceded"))


def _team_names(g: Gold) -> DataFrame:
    return bounded_broadcast(g.dim_team.select("team_id", "team_name"), g.team_rows)


def team_performance(g: Gold) -> DataFrame:
    """All-time table per team, ordered by wins then goal difference."""
    t = team_totals(g).join(_team_names(g), "team_id")
    return ordered(t.select(
        "team_name", "total_matches", "wins", "draws", "losses", "goals_scored",
        "goals_conceded", (F.col("goals_scored") - F.col("goals_conceded")).alias("goal_difference"),
    ), desc("wins", "goal_difference") + asc("team_name"), g.team_rows)


def home_away_advantage(g: Gold, min_matches: int = 30) -> DataFrame:
    """Home and away win % per team with at least ``min_matches`` matches."""
    tv = team_view(g.fact, (), keep=("match_id",))
    home, away = F.col("is_home"), F.col("is_away")
    t = tv.groupBy("team_id").agg(
        F.count_if(home).alias("home_matches"),
        F.count_if(away).alias("away_matches"),
        _count_when(home & (F.col("result") == "H")).alias("_home_wins"),
        _count_when(away & (F.col("result") == "A")).alias("_away_wins"),
        F.count("match_id").alias("_matches"),
    ).where(F.col("_matches") >= min_matches)
    t = t.join(_team_names(g), "team_id")
    return ordered(t.select(
        "team_name", "home_matches", "away_matches",
        round_half_away(pct("_home_wins", "home_matches"), 1).alias("home_win_pct"),
        round_half_away(pct("_away_wins", "away_matches"), 1).alias("away_win_pct"),
    ), desc("home_win_pct") + asc("team_name"), g.team_rows)


def monthly_goals(g: Gold) -> DataFrame:
    """C4: per calendar month matches, goals and average goals."""
    goals = F.col("home_goals") + F.col("away_goals")
    per_day = g.fact.groupBy("date_id").agg(
        F.count("match_id").alias("n"), F.sum(goals).alias("g"), F.count(goals).alias("gn"))
    days = g.dim_date.select("date_id", "year", "month")
    t = per_day.join(days, "date_id").groupBy("year", "month").agg(
        F.sum("n").alias("matches_played"), F.sum("g").alias("total_goals"),
        F.sum("gn").alias("_goal_rows"))
    return ordered(t.select(
        "year", "month", "matches_played", "total_goals",
        round_half_away(ratio("total_goals", "_goal_rows"), 2).alias("avg_goals_per_match"),
    ), asc("year", "month"), g.date_rows)


def top_team_seasons(g: Gold, top: int = 3) -> DataFrame:
    """The ``top`` scoring teams of each season (RANK, so ties may add rows)."""
    tv = team_view(g.fact, ("gf",), keep=("match_id", "season_id"))
    per = tv.groupBy("team_id", "season_id").agg(
        F.sum("gf").alias("goals_scored"), F.count("match_id").alias("matches"))
    per = (per.join(_team_names(g), "team_id")
           .join(g.dim_season.select("season_id", "season_label"), "season_id"))
    w = Window.partitionBy("season_label").orderBy(F.col("goals_scored").desc_nulls_last())
    ranked = per.select("season_label", "team_name", "goals_scored", "matches",
                        F.rank().over(w).cast("long").alias("rank_in_season"))
    return ordered(ranked.where(F.col("rank_in_season") <= top),
                   asc("season_label", "rank_in_season", "team_name"),
                   g.season_rows * g.team_rows)


def role_playing_names(g: Gold) -> DataFrame:
    """The fact read back with both team roles named."""
    names = _team_names(g)
    home = names.select(F.col("team_id").alias("team_id_home"), F.col("team_name").alias("home_team"))
    away = names.select(F.col("team_id").alias("team_id_away"), F.col("team_name").alias("away_team"))
    return (g.fact.select("team_id_home", "team_id_away", "home_goals", "away_goals")
            .join(home, "team_id_home").join(away, "team_id_away")
            .select("home_team", "away_team", "home_goals", "away_goals"))
