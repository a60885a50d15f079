"""Column helpers whose results must equal the reference engine's."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from pitchhouse.functions.parity import round_printed
from pitchhouse.functions import (date_key, is_weekend, iso_week, parse_date, pct, ratio,
                                  round_half_away, round_half_even, season_end_year,
                                  season_from_filename, season_start_year,
                                  season_start_year_as_written, weekday_name)


def one(spark, expr, value, schema):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("x,n", [(1.005, 2), (2.675, 2), (0.125, 2), (-1.005, 2), (2.5, 0),
                                 (-2.5, 0), (44.45, 1), (100.0 / 3, 1), (74.25, 1)])
def test_round_half_away_matches_sql_round(spark, x, n):
    expected = duckdb.sql(f"SELECT round({x!r}::DOUBLE, {n})").fetchall()[0][0]
    assert one(spark, round_half_away(F.col("x"), n), x, "x double") == expected


@pytest.mark.parametrize("x,n", [(0.125, 2), (2.5, 0), (3.5, 0), (66.65, 1), (12.25, 1)])
def test_round_half_even_matches_sql_round_even(spark, x, n):
    expected = duckdb.sql(f"SELECT round_even({x!r}::DOUBLE * {10 ** n}, 0) / {10 ** n}").fetchall()[0][0]
    assert one(spark, round_half_even(F.col("x"), n), x, "x double") == expected


def test_ratio_and_pct_are_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a int, b int")
    got = [tuple(r) for r in df.select(ratio("a", "b"), pct("a", "b")).collect()]
    assert got[0] == (None, None)
    assert got[1] == (1 / 3, 100.0 / 3)


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2022, 8, 13),), (None,)], "d date")
    rows = df.select(date_key("d").alias("k"), weekday_name("d").alias("w"),
                     iso_week("d").alias("iw"), is_weekend("d").alias("we")).collect()
    assert tuple(rows[0]) == (20230101, "Sunday", 52, True)
    assert tuple(rows[1]) == (20220813, "Saturday", 32, True)
    assert tuple(rows[2]) == (None, None, None, None)


def test_parse_date_falls_back_through_formats(spark):
    df = spark.createDataFrame([("12/08/2022",), ("12/08/22",), ("2022-08-12",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_date("s")).collect()]
    assert got == [dt.date(2022, 8, 12)] * 3 + [None]


def test_season_rules(spark):
    df = spark.createDataFrame([("LaLiga 22-23.csv",), ("LaLiga 95-96.csv",)], "f string")
    got = [tuple(r) for r in df.select(
        season_from_filename("f").alias("s")).select(
        "s", season_start_year("s"), season_start_year_as_written("s"), season_end_year("s")).collect()]
    assert got == [("2022-23", 2022, 2020, 2023), ("2095-96", 2095, 2020, 2096)]


def test_round_printed_equals_python_round(spark):
    pairs = [(a, b) for b in range(1, 130) for a in range(0, 130, 3)] + [(1, 40), (3, 40), (5, 8), (1, 8), (201, 200)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = df.select("a", "b", round_printed(F.col("a") / F.col("b"), 2).alias("v")).collect()
    assert all(r.v == round(r.a / r.b, 2) for r in got)


def test_file_names_outside_the_rule_fail(spark):
    name = lambda x: spark.createDataFrame([(x,)], "f string").select(season_from_filename("f").alias("s"))
    assert name("LaLiga 22-23.csv").first().s == "2022-23" and name(None).first().s is None
    for bad in ("my-notes.csv", "LaLiga 22-23.csv.bak", "22-23.csv"):
        with pytest.raises(Exception, match="file name without season"):
            name(bad).collect()
