"""Surrogate keys: ``ROW_NUMBER() OVER (ORDER BY ...)`` without a single partition.

``small_ids`` is the plain window; Spark moves all rows into one partition for
it, so it is used only for inputs whose row count was checked.

``dense_ids`` numbers any number of rows:

1. range-partition on the order, sort inside each partition, and tag every
   row with its partition id and position.  The order ends in a unique
   column (``tiebreak``: a row identity stored with the input), so it is
   total: one hot key, or a large group of identical rows, is still split
   over many partitions, and the partitioning is deterministic, so a lost
   executor's map output is recomputed identically.  Without a ``tiebreak``
   a row hash and a random salt are appended instead (still splits hot
   groups, but a lost map task then forces the whole stage to re-run);
2. write that frame as a table to the shared checkpoint folder — range bounds
   come from sampling, so the tagging must be stored, never recomputed;
3. count rows per partition from the stored table (one column read), turn the
   counts into offsets (their prefix sum; one row per partition, so the offset
   table is bounded by the partition count and is broadcast) and write the rows
   again with the id ``offset + position + 1``.

``counted_ids`` gives the same numbers without a sample and with one write, where
the order's leading column has few values and none fills a partition: their counts
tell each row's partition and the partition's first number before the shuffle.

``dense_ids``' second write moves rows without a shuffle; every later read has the id as a
stored column and joins nothing.  Rows that tie on
``order`` get ids in ``tiebreak`` order (or hash-then-random order without
one); when ``order`` covers every output column, tying rows are identical
and the numbered result does not depend on how their ties were broken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.functions.parity import asc
from pitchhouse.operators.joins import max_broadcast_rows
from pitchhouse.session import work_dir

_PID, _POS, _TIE, _SALT, _N, _OFF = ("_ph_pid", "_ph_pos", "_ph_tie", "_ph_salt",
                                     "_ph_n", "_ph_off")
# Rows per range partition of the numbering shuffle (about 0.2–0.5 GB of a
# 25-column fact); the partition count grows with the input beyond
# spark.sql.shuffle.partitions, which AQE cannot split for an explicit
# range repartition.
DEFAULT_ROWS_PER_PARTITION = 4_000_000
_ROWS_CONF = "pitchhouse.keys.rowsPerPartition"


def range_partitions(spark, rows: int | None) -> int:
    """Partition count for numbering ``rows`` rows."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return base
    per = int(spark.conf.get(_ROWS_CONF, None) or DEFAULT_ROWS_PER_PARTITION)
    return max(base, -(-rows // per))


def _quoted(c: str):
    return F.col(f"`{c}`")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                row_id: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back
    (cuts the lineage; a lost executor re-reads instead of recomputing).

    ``row_id`` adds a unique long column (partition id and position at write
    time); once stored it is a fixed row identity for later total orders.
    ``codec``: a compression other than the session's, for rows read once.
    """
    path = work_dir(df.sparkSession, name)
    if row_id:
        df = df.withColumn(row_id, F.monotonically_increasing_id())
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    return out.select(*[_quoted(c) for c in df.columns])


def small_ids(df: DataFrame, order: list[str], id_col: str) -> DataFrame:
    """Plain window numbering; only for inputs of checked, small size."""
    w = Window.orderBy(*asc(*[_quoted(c) for c in order]))
    return df.select(F.row_number().over(w).cast("long").alias(id_col),
                     *[_quoted(c) for c in df.columns])


def dense_ids(df: DataFrame, order: list[str], id_col: str, keep: list[str] | None = None,
              num_partitions: int | None = None, partition_by: list[str] | None = None,
              name: str = "ids", tiebreak: str | None = None, rows: int | None = None,
              unique_order: bool = False, seed: int = 17) -> DataFrame:
    """Global 1-based numbering of ``df`` in ``order`` (NULLs last), distributed.

    ``keep``: output columns besides the id (default: all).  ``partition_by``:
    directory partitioning of the stored rows (e.g. a season key, for pruning).
    ``tiebreak``: a unique, stored column that ends the order;
    ``unique_order``: the order columns alone are unique (e.g. distinct
    dimension values), so no tie-break is needed.  ``rows``: the input's row
    count (or a bound), which sizes the range partitions.
    """
    spark = df.sparkSession
    n = num_partitions or range_partitions(spark, rows)
    cols = df.columns
    keep = keep or [c for c in cols if c != tiebreak]
    if tiebreak or unique_order:
        sort = asc(*[_quoted(c) for c in order]) + ([_quoted(tiebreak).asc()] if tiebreak else [])
        keyed = df
    else:
        sort = asc(*[_quoted(c) for c in order]) + [F.col(_TIE).asc(), F.col(_SALT).asc()]
        keyed = df.select(*[_quoted(c) for c in cols],
                          F.xxhash64(*[_quoted(c) for c in cols]).alias(_TIE),
                          F.rand(seed).alias(_SALT))
    ranged = keyed.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    pid = F.spark_partition_id().cast("long")
    tagged = ranged.select(*[_quoted(c) for c in keep], pid.alias(_PID),
                           (F.monotonically_increasing_id() - F.shiftleft(pid, 33)).alias(_POS))
    stored = materialize(tagged, f"{name}-rows", codec="snappy")

    counts = stored.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(counts.select(
        _PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("long").alias(_OFF)),
        f"{name}-offsets")
    numbered = stored.join(F.broadcast(offsets), _PID).select(
        (F.col(_OFF) + F.col(_POS) + F.lit(1)).alias(id_col), *[_quoted(c) for c in keep])
    return materialize(numbered, f"{name}-numbered", partition_by)


def counted_ids(df: DataFrame, order: list[str], id_col: str, keep: list[str], tiebreak: str,
                partition_by: list[str] | None = None, name: str = "ids", rows: int | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """``dense_ids`` by exact counts of the order's first column.

    1. count the rows of each of its values (that one column is computed);
    2. cut the values in order into partitions of about equal rows, and add up the
       rows before each;
    3. deal the rows to those partitions, sort them and write them once, numbered
       ``rows before the partition + position + 1``.

    Where a value has more rows than a partition, or the values are too many to be
    broadcast, ``dense_ids`` numbers the rows: its ranges split a value.
    """
    spark, lead = df.sparkSession, order[0]
    n = num_partitions or range_partitions(spark, rows)
    counts = materialize(df.groupBy(_quoted(lead).alias("lead")).agg(F.count(F.lit(1)).alias(_N)), f"{name}-counts")
    values, most, total = counts.agg(F.count(F.lit(1)), F.max(_N), F.sum(_N)).first()
    per = -(-(total or 1) // n)
    if values > max_broadcast_rows(df) or (most or 0) > per:
        return dense_ids(df, order, id_col, keep, n, partition_by, name, tiebreak, rows)
    before = Window.orderBy(F.col("lead").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.select("lead", F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("long").alias(_OFF))
               .withColumn(_PID, F.floor(F.col(_OFF) / per).cast("int")))
    places = materialize(offsets.select("lead", _PID, F.min(_OFF).over(Window.partitionBy(_PID)).alias(_OFF)), f"{name}-offsets")
    sort = asc(*[_quoted(c) for c in order]) + [_quoted(tiebreak).asc()]
    dealt = (df.join(F.broadcast(places), _quoted(lead).eqNullSafe(F.col("lead")))
             .repartitionById(n, F.col(_PID)).sortWithinPartitions(*sort))
    pos = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    numbered = dealt.select((F.col(_OFF) + pos + F.lit(1)).alias(id_col), *[_quoted(c) for c in keep])
    return materialize(numbered, f"{name}-numbered", partition_by)


def surrogate_ids(df: DataFrame, order: list[str], id_col: str, name: str = "dim",
                  rows: int | None = None, unique_order: bool = False) -> tuple[DataFrame, int]:
    """Number ``df`` in ``order``; returns the numbered frame and its row count.

    Up to the broadcast bound the single-partition window is used (its size is
    proven by the count), beyond it the distributed two-pass numbering.  A
    caller that already stored and counted ``df`` passes ``rows``; otherwise
    ``df`` is stored and counted here.
    """
    stored = df
    if rows is None:
        stored = materialize(df, name)
        rows = stored.count()
    if rows <= max_broadcast_rows(df):
        return small_ids(stored, order, id_col), rows
    return dense_ids(stored, order, id_col, name=name, rows=rows,
                     unique_order=unique_order), rows
