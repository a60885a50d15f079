"""Size-driven physical choices: broadcast and sort.

* ``bounded_broadcast`` – a side is broadcast only when its row count is
  known to be within a bound (passed in by a caller that already counted it;
  counted here only if no bound is known).  Beyond the bound the plain join is left to Catalyst/AQE,
  which picks a sort-merge or shuffled-hash join and splits skewed partitions
  at run time.
* ``row_counts`` – several footer-only counts in one job.
* ``ordered`` – a single-partition sort for results of proven small size,
  the distributed ``orderBy`` otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bound: dimension rows are narrow (a key and one or two attributes),
# so two million rows stay well below executor memory when broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
_CONF_KEY = "pitchhouse.broadcast.maxRows"


def max_broadcast_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(value) if value else DEFAULT_MAX_BROADCAST_ROWS


def bounded_broadcast(df: DataFrame, upper_bound: int | None = None,
                      max_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    ``upper_bound`` is a row bound the caller already knows (for instance the
    row count of the dimension that ``df`` filters) and decides alone; only
    without one is ``df`` itself counted.
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    rows = df.count() if upper_bound is None else upper_bound
    return F.broadcast(df) if rows <= limit else df


def row_counts(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several frames in one job (each side reads no columns,
    so Parquet answers from its footers)."""
    names = list(frames)
    tagged = None
    for name in names:
        part = frames[name].select(F.lit(name).alias("t"))
        tagged = part if tagged is None else tagged.unionByName(part)
    got = {r["t"]: r["n"] for r in tagged.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {n: int(got.get(n, 0)) for n in names}


def ordered(df: DataFrame, sort_cols: list, upper_bound: int | None = None,
            max_rows: int | None = None) -> DataFrame:
    """``df`` sorted by ``sort_cols``.

    A result whose row count is bounded by a checked size (e.g. one row per
    team or season) is moved to a single partition and sorted there, which
    skips the sampling job of a range-partitioned sort; anything else uses the
    distributed ``orderBy``.  The move is an exchange of its own, so whatever
    computes ``df`` keeps its parallelism and only final rows reach the one task.
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    if upper_bound is not None and upper_bound <= limit:
        return df.repartition(1).sortWithinPartitions(*sort_cols)
    return df.orderBy(*sort_cols)
