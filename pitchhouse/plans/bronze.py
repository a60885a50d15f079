"""Bronze-layer frames: load report, column completeness, sample rows, and
the schema-evolution slices derived from the driver tables.

``evolving_source`` cuts the bridge's source rows into two generations of
source files: seasons before ``NEW_LAYOUT_FROM`` lack the kick-off time and
carry an over/under odds column; later seasons have the time, put away goals
before home goals and carry a different odds column.  Merging the two by name
is the ``UNION ALL BY NAME`` of the reference's loader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchhouse.functions.calendar import parse_date
from pitchhouse.functions.parity import asc
from pitchhouse.functions.season import season_from_filename
from pitchhouse.operators.joins import ordered

# Fixed parameters of the derived two-generation source layout.
NEW_LAYOUT_FROM = 1998
OLD_ONLY, NEW_ONLY, DROPPED_IN_OLD = "BbMx>2.5", "BWH", "Time"
SAMPLE_COLUMNS = ["season", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"]


GENERATION = "_generation"


def _q(c: str):
    return F.col(f"`{c}`")


def with_generation(src: DataFrame) -> DataFrame:
    """Source rows with the generation of file they stand in; a match without a
    season counts as old, so every row is in one."""
    start = F.left(F.col("season"), F.lit(4)).cast("int")
    return src.withColumn(GENERATION, F.when(start >= NEW_LAYOUT_FROM, "new").otherwise("old"))


def evolving_source(src: DataFrame) -> tuple[DataFrame, DataFrame]:
    cols = [c for c in src.columns if c != GENERATION]
    old_cols = [c for c in cols if c != DROPPED_IN_OLD]
    old = src.where(F.col(GENERATION) == "old").select(
        *[_q(c) for c in old_cols],
        (F.col("HS").cast("int") + F.col("AS").cast("int")).cast("string").alias(OLD_ONLY))
    new_cols = list(cols)
    i, j = new_cols.index("FTHG"), new_cols.index("FTAG")
    new_cols[i], new_cols[j] = new_cols[j], new_cols[i]
    new = src.where(F.col(GENERATION) == "new").select(
        *[_q(c) for c in new_cols], F.col("HC").alias(NEW_ONLY))
    return old, new


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def bronze_from_source(src: DataFrame) -> DataFrame:
    """Both source generations merged by column name (missing → NULL)."""
    return union_by_name(list(evolving_source(src)))


def season_from_file(bronze: DataFrame) -> DataFrame:
    """Season derived from each file name by the naming rule, with row counts."""
    return bronze.groupBy("_source_file").agg(F.count(F.lit(1)).alias("matches")).select(
        "_source_file", season_from_filename("_source_file").alias("season"), "matches")


def load_report(bronze: DataFrame) -> DataFrame:
    """Rows per season and source file (the loader's verification)."""
    return (bronze.groupBy("season", "_source_file").agg(F.count(F.lit(1)).alias("matches"))
            .orderBy(*asc("season", "_source_file")))


def completeness(bronze: DataFrame, group: str = "season",
                 columns: list[str] | None = None, groups_bound: int | None = None) -> DataFrame:
    """Per group: all rows and the non-NULL count of every column
    (``nonnull_<lower-case name>``, with non-alphanumerics as ``_``).
    ``groups_bound``: a counted bound on the number of groups (e.g. the season
    dimension's size), which lets the small result sort in one partition."""
    columns = columns or [c for c in bronze.columns if c != group and not c.startswith("_")]
    aggs = [F.count(F.lit(1)).alias("total_matches")]
    aggs += [F.count(_q(c)).alias(completeness_name(c)) for c in columns]
    return ordered(bronze.groupBy(group).agg(*aggs), [F.col(group).asc_nulls_last()], groups_bound)


def completeness_name(c: str) -> str:
    return "nonnull_" + "".join(ch if ch.isalnum() else "_" for ch in c.lower())


def sample_rows(bronze: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows by season and date (as a date, not as day-first text);
    the other shown columns break ties so the sample is deterministic."""
    keys = [parse_date(_q(c)) if c == "Date" else _q(c) for c in SAMPLE_COLUMNS]
    return bronze.select(*[_q(c) for c in SAMPLE_COLUMNS]).orderBy(
        *[k.asc_nulls_last() for k in keys]).limit(n)


def write_source_files(src: DataFrame, root: str, odd: bool = False) -> str:
    """Write both source generations as CSV files with header lines, one
    folder per source file (``<root>/<gen>/_source_file=LaLiga YY-YY.csv/``),
    and return the glob that matches them.  The season is not written: the
    loader derives it from the file name, as for the reference's files.  ``odd``
    gives the later files a last column without a name, whose values span lines."""
    for gen, frame in zip(("old", "new"), evolving_source(src)):
        if odd and gen == "new":
            frame = frame.withColumn("", F.concat("HomeTeam", F.lit(' "at"\n'), "AwayTeam"))
        (frame.drop("season").write.mode("overwrite").option("header", True).option("escape", '"')
         .partitionBy("_source_file").csv(f"{root}/{gen}"))
    return f"{root}/*/*/*.csv"
