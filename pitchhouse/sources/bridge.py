"""Bridge from the TPC-H-like driver tables to the match shapes.

One lineitem is one match.  The home team is the supplier's nation, the away
team the customer's nation (one dimension in two roles).  Goals, shots,
cards, … are integer functions of the line's columns; the season runs from July
to June of the order date.

``silver_from_tables`` gives the typed silver shape; ``source_rows`` gives
the same rows as the source files would hold them (every column text, source
column names), which feeds the bronze operators.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchhouse.operators.joins import bounded_broadcast, max_broadcast_rows, row_counts
from pitchhouse.plans.silver import SILVER_COLUMNS, SOURCE_TO_SILVER

# Fixed values of the source format (division code, date and time layout).
DIVISION = "SP1"
SOURCE_DATE_FORMAT = "dd/MM/yyyy"
SEASON_START_MONTH = 7


_READERS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A reader over one driver table; the (lazy) reader is kept per
    application so its schema is inferred once, not on every query."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    key = (spark.sparkContext.applicationId, path)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


def _int_round(c):
    # a double → int cast rounds in the oracle engine and truncates in Spark
    return F.round(c).cast("int")


def silver_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed silver rows (23 columns, ``SILVER_COLUMNS`` order)."""
    t = lambda name: read_table(spark, sf_dir, name)
    nation, supplier, customer, part = t("nation"), t("supplier"), t("customer"), t("part")
    # Key → attribute mappings.  Each is broadcast only while the row count of
    # its base table (an upper bound of the mapping; one footer-only job counts
    # all four) is within the broadcast bound; beyond it the join is left to
    # Catalyst/AQE (sort-merge, skew-split at run time).
    n = row_counts({"nation": nation, "supplier": supplier, "customer": customer, "part": part})
    nation = bounded_broadcast(nation.select("n_nationkey", "n_name"), n["nation"])
    home = bounded_broadcast(supplier.select("s_suppkey", "s_nationkey").join(
        nation.withColumnRenamed("n_nationkey", "s_nationkey").withColumnRenamed("n_name", "home_team"),
        "s_nationkey").select("s_suppkey", "home_team"), n["supplier"])
    away = bounded_broadcast(customer.select("c_custkey", "c_nationkey").join(
        nation.withColumnRenamed("n_nationkey", "c_nationkey").withColumnRenamed("n_name", "away_team"),
        "c_nationkey").select("c_custkey", "away_team"), n["customer"])
    size = bounded_broadcast(part.select("p_partkey", "p_size"), n["part"])
    # orders grows with lineitem: no hint; Catalyst/AQE broadcast it only while
    # its measured size is under spark.sql.autoBroadcastJoinThreshold.
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")

    line = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    if n["customer"] <= max_broadcast_rows(customer):
        # every mapping is broadcast: lineitem streams through hash lookups
        rows = (line
                .join(home, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(size, F.col("l_partkey") == F.col("p_partkey"))
                .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(away, F.col("o_custkey") == F.col("c_custkey")))
    else:
        # the customer side joins orders first (an orders-sized shuffle), so
        # lineitem-sized data is shuffled at most three times (order,
        # supplier, part keys) rather than four
        orders_away = orders.join(away, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", "o_orderdate", "away_team")
        rows = (line
                .join(orders_away, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(home, F.col("l_suppkey") == F.col("s_suppkey"))
                .join(size, F.col("l_partkey") == F.col("p_partkey")))

    od = F.col("o_orderdate")
    sy = F.when(F.month(od) >= SEASON_START_MONTH, F.year(od)).otherwise(F.year(od) - 1).cast("int")
    rows = rows.select(
        sy.alias("sy"), od.cast("date").alias("match_date"), "home_team", "away_team",
        _int_round(F.col("l_quantity")).alias("hg"), F.col("p_size").alias("ag"),
        _int_round(F.col("l_discount") * 100).alias("disc"),
        _int_round(F.col("l_tax") * 100).alias("tax"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")

    hg, ag, ln = F.col("hg"), F.col("ag"), F.col("l_linenumber")
    hg_ht, ag_ht = F.floor(hg / 2).cast("int"), F.floor(ag / 2).cast("int")

    def code(h, a):
        return F.when(h > a, "H").when(h < a, "A").otherwise("D")

    season = F.concat(F.col("sy").cast("string"), F.lit("-"),
                      F.lpad(((F.col("sy") + 1) % 100).cast("string"), 2, "0"))
    out = rows.select(
        season.alias("season"),
        "match_date",
        F.concat(F.lpad((ln + 12).cast("string"), 2, "0"), F.lit(":00")).alias("match_time"),
        "home_team", "away_team",
        hg.alias("home_goals"), ag.alias("away_goals"), code(hg, ag).alias("result"),
        hg_ht.alias("home_goals_ht"), ag_ht.alias("away_goals_ht"),
        code(hg_ht, ag_ht).alias("result_ht"),
        (hg + ln).alias("home_shots"), (ag + ln).alias("away_shots"),
        (hg + F.col("disc")).alias("home_shots_on_target"),
        (ag + F.col("tax")).alias("away_shots_on_target"),
        ln.alias("home_fouls"), (F.col("l_partkey") % 20).cast("int").alias("away_fouls"),
        (F.col("l_suppkey") % 13).cast("int").alias("home_corners"),
        (F.col("l_partkey") % 13).cast("int").alias("away_corners"),
        F.col("disc").alias("home_yellow_cards"), F.col("tax").alias("away_yellow_cards"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("home_red_cards"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("away_red_cards"))
    return out.select(*SILVER_COLUMNS)


def source_file_name(season) -> F.Column:
    """``LaLiga YY-YY.csv`` for a ``YYYY-YY`` season label."""
    season = F.col(season) if isinstance(season, str) else season
    return F.concat(F.lit("LaLiga "), F.substring(season, 3, 2), F.lit("-"),
                    F.right(season, F.lit(2)), F.lit(".csv"))


def source_rows(silver: DataFrame) -> DataFrame:
    """Silver rows rendered as the source files hold them: text columns with
    source names, plus ``season`` and ``_source_file``."""
    cols = [F.lit(DIVISION).alias("Div")]
    for source_name, silver_name in SOURCE_TO_SILVER.items():
        if silver_name == "match_date":
            value = F.date_format(F.col(silver_name), SOURCE_DATE_FORMAT)
        else:
            value = F.col(silver_name).cast("string")
        cols.append(value.alias(source_name))
    return silver.select(*cols, F.col("season"), source_file_name("season").alias("_source_file"))
