"""Bronze view → silver view: column selection, renaming and typing.

Both are lazy DataFrames (views in the reference); Catalyst folds the two
projections into the bronze scan, so only the 23 used source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchhouse.functions.calendar import parse_date

# Source column → silver column, in the reference's order.
SOURCE_TO_SILVER = {
    "Date": "match_date",
    "Time": "match_time",
    "HomeTeam": "home_team",
    "AwayTeam": "away_team",
    "FTHG": "home_goals",
    "FTAG": "away_goals",
    "FTR": "result",
    "HTHG": "home_goals_ht",
    "HTAG": "away_goals_ht",
    "HTR": "result_ht",
    "HS": "home_shots",
    "AS": "away_shots",
    "HST": "home_shots_on_target",
    "AST": "away_shots_on_target",
    "HF": "home_fouls",
    "AF": "away_fouls",
    "HC": "home_corners",
    "AC": "away_corners",
    "HY": "home_yellow_cards",
    "AY": "away_yellow_cards",
    "HR": "home_red_cards",
    "AR": "away_red_cards",
}
TEXT_COLUMNS = {"match_time", "home_team", "away_team", "result", "result_ht"}
METADATA_COLUMNS = ["season", "_source_file", "_loaded_at"]
# The bronze view: division code, the 22 mapped source columns, lineage.
BRONZE_COLUMNS = ["Div", *SOURCE_TO_SILVER] + METADATA_COLUMNS
SILVER_COLUMNS = ["season", *SOURCE_TO_SILVER.values()]
DATE_FORMATS = ("dd/MM/yyyy", "dd/MM/yy", "yyyy-MM-dd")
# What names a match.
NATURAL_KEY = ["season", "match_date", "match_time", "home_team", "away_team"]


def _q(name: str):
    # backticks: source names such as AS are keywords, odds names hold '.' or '>'
    return F.col(f"`{name}`")


def bronze_view(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project the wide landed table to the 26 bronze-view columns, and ``keep``.

    A column missing from every landed file (possible with evolving sources)
    comes out as NULL text rather than failing the projection.
    """
    present = set(raw.columns)
    return raw.select(*[_q(c) if c in present else F.lit(None).cast("string").alias(c)
                        for c in BRONZE_COLUMNS], *[_q(c) for c in keep])


def silver_view(bronze: DataFrame, date_formats=DATE_FORMATS, trim_text: bool = False,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename and type the bronze view into the 23 silver columns.

    Counts are parsed with ``try_cast`` (bad text → NULL, never a failed job);
    dates with the given formats in turn.  ``trim_text`` trims every value first;
    ``keep`` takes further columns along (a stored row identity).
    """
    cols = [F.col("season")]
    for source, target in SOURCE_TO_SILVER.items():
        c = _q(source)
        if trim_text:
            c = F.trim(c)
        if target == "match_date":
            c = parse_date(c, date_formats)
        elif target not in TEXT_COLUMNS:
            c = c.try_cast("int")
        cols.append(c.alias(target))
    return bronze.select(*cols, *[_q(c) for c in keep])


def bronze_view_sql(columns: list[str], table: str) -> str:
    """The bronze view over the landed table as SQL, from the same column list."""
    have = {c.lower(): c for c in columns}
    picked = [f"`{have[c.lower()]}` AS `{c}`" if c.lower() in have else f"CAST(NULL AS STRING) AS `{c}`" for c in BRONZE_COLUMNS]
    return f"SELECT {', '.join(picked)} FROM {table}"


def silver_view_sql(table: str, date_formats=DATE_FORMATS) -> str:
    """The silver view over the bronze view as SQL, from the same column mapping."""
    picked = ["season"]
    for source, target in SOURCE_TO_SILVER.items():
        if target == "match_date":
            value = "coalesce(" + ", ".join(f"try_to_date(`{source}`, '{f}')" for f in date_formats) + ")"
        else:
            value = f"`{source}`" if target in TEXT_COLUMNS else f"try_cast(`{source}` AS INT)"
        picked.append(f"{value} AS {target}")
    return f"SELECT {', '.join(picked)} FROM {table}"


def cleaned(silver: DataFrame, key: list[str] = NATURAL_KEY, fills: dict[str, Column] | None = None) -> DataFrame:
    """One row for each natural key, with the NULL rules applied.

    1. Text is trimmed, and empty text is NULL; a row without one of the key's
       columns stays a row of its own key (NULLs are equal).
    2. Of the rows of a key, that with the most known values survives; ties go to
       the greatest values, column by column (NULL least).  ``max_by`` keeps one row
       a key in every task before anything is shuffled.
    3. ``fills`` gives a value where the survivor has NULL (default: the result
       and the half-time result from the goals, no cards where none are written).
    """
    names = silver.columns
    text = [c for c, t in silver.dtypes if t == "string"]
    rows = silver.select(*[F.nullif(F.trim(_q(c)), F.lit("")).alias(c) if c in text else _q(c) for c in names])
    rest = [c for c in names if c not in key]
    known = F.lit(0)
    for c in rest:
        known = known + _q(c).isNotNull().cast("int")
    best = F.max(F.struct(known.alias("_known"), *[_q(c) for c in rest])).alias("_best")
    one = rows.groupBy(*[_q(c) for c in key]).agg(best).select(*key, "_best.*").select(*[_q(c) for c in names])
    fills = fills if fills is not None else default_fills()
    return one.select(*[F.coalesce(_q(c), fills[c]).alias(c) if c in fills else _q(c) for c in names])


def default_fills() -> dict[str, Column]:
    """NULL rules: results follow from goals, cards not written were not shown."""
    def code(h: str, a: str) -> Column:
        return F.when(F.col(h) > F.col(a), "H").when(F.col(h) < F.col(a), "A").when(F.col(h) == F.col(a), "D")
    cards = ("home_yellow_cards", "away_yellow_cards", "home_red_cards", "away_red_cards")
    return {"result": code("home_goals", "away_goals"), "result_ht": code("home_goals_ht", "away_goals_ht")} | {
        c: F.lit(0) for c in cards}


def near_copies(silver: DataFrame) -> DataFrame:
    """``silver`` and, for some matches, copies as a second delivery has them: names
    padded with blanks, shots and cards missing, an empty result; and one match in
    five without its result and red cards.  A derived input for the cleaning."""
    some = silver.where("home_goals % 3 = 0")
    padded = {c: F.concat(F.lit(" "), F.col(c), F.lit("  ")) for c in ("home_team", "away_team")}
    null = F.lit(None)
    copy = (some.withColumns(padded).withColumn("result", F.lit(""))
            .withColumn("home_shots", null.cast("int")).withColumn("away_yellow_cards", null.cast("int")))
    poor = F.col("home_fouls") % 5 == 0
    return (silver.withColumn("result", F.when(~poor, F.col("result"))).withColumn("home_red_cards", F.when(~poor, F.col("home_red_cards")))
            .unionByName(copy))
