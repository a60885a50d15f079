"""The dashboard's frames (league overview, team deep-dive, head to head).

The reference builds these with SQL f-strings plus row-wise pandas
(``apply``, ``groupby.apply``, ``melt``); here every step is a column
expression in the same Spark plan.  Names and seasons are literals (never
spliced into SQL text), so a quote in a team name is harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.functions.parity import (asc, pct, ratio, round_half_away,
                                         round_half_even, round_printed)
from pitchhouse.operators.joins import bounded_broadcast, ordered
from pitchhouse.operators.teamview import DRAW, LOSS, WIN, team_view
from pitchhouse.plans.analytics import _season_totals
from pitchhouse.plans.warehouse import Gold

# Display labels of the dashboard frames.
RESULT_LABELS = {"home_wins": "Home Win", "draws": "Draw", "away_wins": "Away Win"}
BREAKDOWN_LABELS = (("Win", "wins"), ("Draw", "draws"), ("Loss", "losses"))
STAT_CATEGORIES = ("Goals/Match", "Shots on Target", "Corners", "Yellow Cards")


# ── League overview ──────────────────────────────────────────────────────────

def league_overview(g: Gold) -> DataFrame:
    """C1 plus yellow and red card totals."""
    extra = {"yellow_cards": F.sum(F.col("home_yellow_cards") + F.col("away_yellow_cards")),
             "red_cards": F.sum(F.col("home_red_cards") + F.col("away_red_cards"))}
    t = _season_totals(g.fact, extra).join(g.dim_season.select("season_id", "season_label"),
                                           "season_id")
    return ordered(t.select(
        "season_label", F.col("total_matches").alias("matches"), "total_goals",
        round_half_away(ratio("total_goals", "_goal_rows"), 2).alias("avg_goals"),
        "home_wins", "draws", "away_wins",
        round_half_away(pct("home_wins", "_rows"), 1).alias("home_win_pct"),
        "yellow_cards", "red_cards",
    ), asc("season_label"), g.season_rows)


def latest_season_kpis(g: Gold) -> DataFrame:
    """The last row of the overview (seasons ascending, NULLs last)."""
    return (league_overview(g)
            .orderBy(F.col("season_label").desc_nulls_first()).limit(1)
            .select("season_label", "total_goals", "avg_goals", "home_win_pct", "red_cards"))


def result_distribution(g: Gold) -> DataFrame:
    """Home wins / draws / away wins per season in long form."""
    wide = league_overview(g).select("season_label", *RESULT_LABELS)
    long = wide.unpivot("season_label", list(RESULT_LABELS), "result", "count")
    labels = F.create_map(*[F.lit(x) for kv in RESULT_LABELS.items() for x in kv])
    return long.select("season_label", labels[F.col("result")].alias("result"), "count")


# ── Team deep-dive ───────────────────────────────────────────────────────────

def _named(g: Gold, name: str) -> DataFrame:
    """``dim_team`` rows with this name (at most one: team_name is unique)."""
    one = g.dim_team.where(F.col("team_name") == F.lit(name)).select("team_id")
    return bounded_broadcast(one, g.team_rows)


def _seasons(g: Gold, season: str | None) -> DataFrame:
    ds = g.dim_season.select("season_id", F.col("season_label").alias("season"))
    if season is not None:
        ds = ds.where(F.col("season") == F.lit(season))
    return bounded_broadcast(ds, g.season_rows)


def _team_id(g: Gold, name: str):
    """The team's id as a one-row subquery."""
    return g.dim_team.where(F.col("team_name") == F.lit(name)).select("team_id").scalar()


def _matches_of(g: Gold, team: str) -> DataFrame:
    """The fact rows in which ``team`` plays, filtered at the scan (before any
    unpivot) by the id that a one-row subquery looks up."""
    tid = _team_id(g, team)
    return g.fact.where((F.col("team_id_home") == tid) | (F.col("team_id_away") == tid))


def team_match_log(g: Gold, team: str, season: str | None = None) -> DataFrame:
    """Every match of ``team`` (optionally one season), oldest first."""
    tv = team_view(_matches_of(g, team), ("gf", "ga", "shots_on_target", "yellows"),
                   keep=("season_id", "date_id"))
    opp = bounded_broadcast(g.dim_team.select(F.col("team_id").alias("opponent_id"),
                                              F.col("team_name").alias("opponent")), g.team_rows)
    days = g.dim_date.select("date_id", F.col("full_date").alias("date"))
    log = (tv.join(_named(g, team), "team_id")
           .join(_seasons(g, season), "season_id")
           .join(opp, "opponent_id")
           .join(days, "date_id"))
    return log.select("season", "date", "venue", "opponent", "gf", "ga",
                      F.col("outcome").alias("result"), "shots_on_target", "yellows"
                      ).orderBy(*asc("date"))


def team_kpis(g: Gold, team: str, season: str | None = None) -> DataFrame:
    """One row — matches, W/D/L, goals for, goal difference."""
    log = team_match_log(g, team, season)
    gf = F.coalesce(F.sum("gf"), F.lit(0))
    ga = F.coalesce(F.sum("ga"), F.lit(0))
    return log.agg(F.count(F.lit(1)).alias("matches"),
                   F.count_if(F.col("result") == WIN).alias("wins"),
                   F.count_if(F.col("result") == DRAW).alias("draws"),
                   F.count_if(F.col("result") == LOSS).alias("losses"),
                   gf.cast("long").alias("gf"), (gf - ga).cast("long").alias("goal_diff"))


def team_result_breakdown(g: Gold, team: str, season: str | None = None) -> DataFrame:
    """Win/Draw/Loss counts as (result, count) rows (the share chart's input)."""
    k = team_kpis(g, team, season)
    rows = F.array(*[F.struct(F.lit(label).alias("result"), F.col(c).alias("count"))
                     for label, c in BREAKDOWN_LABELS])
    return k.select(F.inline(rows))


def team_goals_by_season(g: Gold, team: str, season: str | None = None) -> DataFrame:
    """C11: goals for and against per season (NULL seasons dropped, sorted)."""
    log = team_match_log(g, team, season).where(F.col("season").isNotNull())
    return ordered(log.groupBy("season").agg(
        F.coalesce(F.sum("gf"), F.lit(0)).cast("long").alias("goals_for"),
        F.coalesce(F.sum("ga"), F.lit(0)).cast("long").alias("goals_against"),
    ), asc("season"), g.season_rows)


def team_venue_split(g: Gold, team: str, season: str | None = None) -> DataFrame:
    """Home vs away record; win % rounded half-even to one digit."""
    log = team_match_log(g, team, season).where(F.col("venue").isNotNull())
    t = log.groupBy("venue").agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if(F.col("result") == WIN).alias("wins"),
        F.count_if(F.col("result") == DRAW).alias("draws"),
        F.count_if(F.col("result") == LOSS).alias("losses"),
        F.coalesce(F.sum("gf"), F.lit(0)).cast("long").alias("goals_for"),
        F.coalesce(F.sum("ga"), F.lit(0)).cast("long").alias("goals_against"))
    win_pct = round_half_even(F.col("wins") / F.col("matches") * 100, 1)
    return ordered(t.select("*", win_pct.alias("win_pct")), asc("venue"), 2)


# ── Head to head ─────────────────────────────────────────────────────────────

# Columns of the meetings list; measures behind the stat categories after goals.
H2H_STATS = ("shots_on_target", "corners", "yellows")
H2H_COLUMNS = ["season", "date", "home_team", "away_team", "home_goals", "away_goals", "result",
               "home_shots_on_target", "away_shots_on_target", "home_corners", "away_corners",
               "home_yellow_cards", "away_yellow_cards"]


def head_to_head(g: Gold, team_a: str, team_b: str, season: str | None = None,
                 as_written: bool = False) -> DataFrame:
    """All meetings of two teams, either way round, oldest first.

    ``as_written=True`` reproduces the reference's precedence slip
    ``(A home AND B away) OR (B home AND A away) AND season = s``, where the
    season filter binds to the second pairing only.
    """
    a, b = _team_id(g, team_a), _team_id(g, team_b)
    h, w = F.col("team_id_home"), F.col("team_id_away")
    ab, ba = (h == a) & (w == b), (h == b) & (w == a)
    # the ids of one-row subqueries filter at the scan; names and dates join the few rows left
    met = g.fact.where(ab | ba).withColumn("_hosted", h == a)
    rows = (met.join(_seasons(g, None if as_written else season), "season_id")
            .join(g.dim_date.select("date_id", F.col("full_date").alias("date")), "date_id"))
    if as_written and season is not None:
        rows = rows.where(F.col("_hosted") | (F.col("season") == F.lit(season)))
    names = [F.when(F.col("_hosted"), F.lit(x)).otherwise(F.lit(y)).alias(c)
             for x, y, c in ((team_a, team_b, "home_team"), (team_b, team_a, "away_team"))]
    return rows.select(*[c for c in rows.columns if c not in ("home_team", "away_team")], *names).select(
        *H2H_COLUMNS).orderBy(*asc("date"))


def _meetings(g: Gold, team_a: str, team_b: str, season: str | None = None,
              as_written: bool = False) -> DataFrame:
    """The meetings at team grain, from ``team_a``'s side (``as_written`` as in
    ``head_to_head``: the season binds to the meetings that ``team_b`` hosts)."""
    other = _named(g, team_b).select(F.col("team_id").alias("opponent_id"))
    tv = team_view(_matches_of(g, team_a), ("gf", "ga", *H2H_STATS, *[f"{m}_against" for m in H2H_STATS]),
                   keep=("season_id", "date_id"))
    rows = (tv.join(_named(g, team_a), "team_id").join(other, "opponent_id")
            .join(_seasons(g, None if as_written else season), "season_id")
            .join(g.dim_date.select("date_id"), "date_id"))
    if as_written and season is not None:
        rows = rows.where(F.col("is_home") | (F.col("season") == F.lit(season)))
    return rows


def head_to_head_summary(g: Gold, team_a: str, team_b: str, season: str | None = None,
                         as_written: bool = False) -> DataFrame:
    """C14: one row — meetings, wins of A, draws, wins of B, goals of each.

    ``wins_b`` counts A's non-wins that are not draws, so a meeting with a
    NULL result counts for B, as in the reference.
    """
    outcome = F.col("outcome")
    return _meetings(g, team_a, team_b, season, as_written).agg(
        F.count(F.lit(1)).alias("meetings"),
        F.count_if(outcome == WIN).alias("wins_a"),
        F.count_if(outcome == DRAW).alias("draws"),
        F.count_if(outcome == LOSS).alias("wins_b"),
        F.coalesce(F.sum("gf"), F.lit(0)).cast("long").alias("goals_a"),
        F.coalesce(F.sum("ga"), F.lit(0)).cast("long").alias("goals_b"))


def head_to_head_win_share(g: Gold, team_a: str, team_b: str, season: str | None = None,
                           as_written: bool = False) -> DataFrame:
    """(team, count) rows: A's wins, draws, B's wins."""
    k = head_to_head_summary(g, team_a, team_b, season, as_written)
    rows = F.array(F.struct(F.lit(team_a).alias("team"), F.col("wins_a").alias("count")),
                   F.struct(F.lit("Draw").alias("team"), F.col("draws").alias("count")),
                   F.struct(F.lit(team_b).alias("team"), F.col("wins_b").alias("count")))
    return k.select(F.inline(rows))


def head_to_head_avg_stats(g: Gold, team_a: str, team_b: str, season: str | None = None,
                           as_written: bool = False) -> DataFrame:
    """(team, category, value) — per-meeting averages, two decimals: goals
    as Python rounds a ratio, the other means as pandas rounds a column."""
    one = _meetings(g, team_a, team_b, season, as_written).agg(
        F.count(F.lit(1)).alias("n"), F.sum("gf").alias("gf"), F.sum("ga").alias("ga"),
        *[F.avg(m + side).alias(m + side) for m in H2H_STATS for side in ("", "_against")])

    def values(goals: str, side: str) -> list:
        per_match = round_printed(ratio(F.coalesce(F.col(goals), F.lit(0)), "n"), 2)
        return [per_match, *[round_half_even(F.col(m + side), 2) for m in H2H_STATS]]

    rows = F.array(*[F.struct(F.lit(team).alias("team"), F.lit(cat).alias("category"), v.alias("value"))
                     for team, goals, side in ((team_a, "gf", ""), (team_b, "ga", "_against"))
                     for cat, v in zip(STAT_CATEGORIES, values(goals, side))])
    return one.select(F.inline(rows))


# ── Pick lists ───────────────────────────────────────────────────────────────

def pick_list_teams(g: Gold) -> DataFrame:
    return ordered(g.dim_team.select("team_name"), asc("team_name"), g.team_rows)


def pick_list_seasons(g: Gold) -> DataFrame:
    return ordered(g.dim_season.select("season_label"), asc("season_label"), g.season_rows)

