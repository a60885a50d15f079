"""Hand-made silver rows covering the edge cases of the reference's SQL."""

import datetime as dt

from pitchhouse.plans.silver import SILVER_COLUMNS

D = dt.date


def silver_row(season, date, home, away, hg, ag, result, **kw):
    row = dict.fromkeys(SILVER_COLUMNS)
    row.update(season=season, match_date=date, match_time="20:00", home_team=home,
               away_team=away, home_goals=hg, away_goals=ag, result=result,
               home_goals_ht=0, away_goals_ht=0, result_ht="D", home_shots=10, away_shots=8,
               home_shots_on_target=4, away_shots_on_target=3, home_fouls=12, away_fouls=11,
               home_corners=5, away_corners=4, home_yellow_cards=2, away_yellow_cards=1,
               home_red_cards=0, away_red_cards=0)
    row.update(kw)
    return tuple(row[c] for c in SILVER_COLUMNS)


SCHEMA = ("season string, match_date date, match_time string, home_team string, "
          "away_team string, home_goals int, away_goals int, result string, home_goals_ht int, "
          "away_goals_ht int, result_ht string, home_shots int, away_shots int, "
          "home_shots_on_target int, away_shots_on_target int, home_fouls int, away_fouls int, "
          "home_corners int, away_corners int, home_yellow_cards int, away_yellow_cards int, "
          "home_red_cards int, away_red_cards int")

ROWS = [
    # season 2022-23
    silver_row("2022-23", D(2022, 8, 13), "Barcelona", "Real Madrid", 2, 1, "H"),
    silver_row("2022-23", D(2022, 9, 3), "Real Madrid", "Barcelona", 1, 1, "D"),
    silver_row("2022-23", D(2022, 10, 1), "Girona", "Barcelona", 0, 3, "A"),
    silver_row("2022-23", D(2022, 10, 8), "Barcelona", "Girona", 4, 0, "H"),
    # edge 1: NULL date → kept in the fact with a NULL date_id
    silver_row("2022-23", None, "Girona", "Real Madrid", 2, 2, "D"),
    # edge 2: NULL home team → a dim_team row, but the match drops from the fact
    silver_row("2022-23", D(2022, 11, 5), None, "Girona", 1, 0, "H"),
    # edge 3: NULL result → no win/draw/loss in the table, 'L' in the log
    silver_row("2022-23", D(2022, 11, 12), "Real Madrid", "Girona", 1, 0, None),
    # edge 4: home = away (decided) → one win and one loss, home and away match
    silver_row("2022-23", D(2022, 12, 3), "Girona", "Girona", 2, 1, "H"),
    # edge 7: apostrophe in a team name; edge 5: a team with only home games
    silver_row("2023-24", D(2023, 8, 12), "Athletic d'Bilbao", "Girona", 3, 0, "H"),
    # season 2023-24, edge 6: ties at rank 3 (goals scored)
    silver_row("2023-24", D(2023, 8, 19), "Barcelona", "Real Madrid", 1, 1, "D"),
    silver_row("2023-24", D(2023, 8, 26), "Real Madrid", "Girona", 1, 2, "A"),
    # edge 8: the two teams meet in both seasons both ways round
    silver_row("2023-24", D(2023, 9, 2), "Real Madrid", "Barcelona", 0, 2, "A"),
]


def silver_df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def arrow_table():
    import pyarrow as pa
    types = {"string": pa.string(), "date": pa.date32(), "int": pa.int32()}
    fields = [pa.field(n, types[t]) for n, t in (f.split() for f in SCHEMA.split(", "))]
    schema = pa.schema(fields)
    return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in ROWS], schema=schema)
