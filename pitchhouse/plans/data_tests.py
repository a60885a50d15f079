"""The gold layer's declared data tests (13 in total).

Fixed values: the table/column/test list and the accepted result codes, as
declared for the reference's gold models.
"""

from __future__ import annotations

from pitchhouse.operators.quality import TableTests, relationships, run_tests
from pitchhouse.plans.warehouse import Gold

RESULT_CODES = ["H", "A", "D"]

# (table, unique columns, not_null columns, accepted_values)
GOLD_TESTS = [
    ("fact_matches", ["match_id"], ["match_id", "home_goals", "result"], {"result": RESULT_CODES}),
    ("dim_team", ["team_id", "team_name"], ["team_id", "team_name"], {}),
    ("dim_season", ["season_id"], ["season_id"], {}),
    ("dim_date", ["date_id"], ["date_id"], {}),
]


def gold_tables(g: Gold) -> dict:
    return {"fact_matches": g.fact, "dim_team": g.dim_team, "dim_season": g.dim_season,
            "dim_date": g.dim_date}


def gold_test_report(g: Gold, kinds=("unique", "not_null", "accepted_values"), tables=None):
    frames = tables or gold_tables(g)
    specs = [TableTests(name, frames[name], unique=u, not_null=n, accepted_values=a)
             for name, u, n, a in GOLD_TESTS]
    return run_tests(specs, kinds)


def dirty_fact(fact):
    """The fact plus a corrupted copy of every drawn match (same match_id,
    result 'X', home_goals NULL): a derived input on which the tests fail."""
    from pyspark.sql import functions as F
    bad = fact.where(F.col("result") == "D").withColumn("result", F.lit("X")) \
        .withColumn("home_goals", F.lit(None).cast("int"))
    return fact.unionByName(bad)


def relationship_report(g: Gold, season=None, team=None):
    """The fact's four foreign keys against their dimensions (``season``, ``team``:
    other parents, for inputs on which the tests fail)."""
    season, team = season or g.dim_season, team or g.dim_team
    return relationships([(g.fact, "season_id", season, "season_id", "fact_matches"),
                          (g.fact, "team_id_home", team, "team_id", "fact_matches"),
                          (g.fact, "team_id_away", team, "team_id", "fact_matches"),
                          (g.fact, "date_id", g.dim_date, "date_id", "fact_matches")])
