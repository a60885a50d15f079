"""Operator 10 [native]: mix sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size.
Documents of a source are put in order, the expected copies are summed along
it, one random offset is added, and a document is emitted once for every whole
number that its step of the sum crosses.  Ordered by size, the taken words stay
within about one large document of the target.

The order inside a source is size, id, digest of the text, at every size of input.
Rows are range-partitioned on source and that order and numbered inside each
range; the place in the source is the count of its rows in earlier ranges and the
number among its rows in the range.  A stored row number ends the order of the
ranges, so a hot source, size or row spreads over many of them; how many ranges
there are changes no place.

Null texts have size 0, and null ids, sources and texts sort last.  Rows that are
equal in id, size and text take places next to each other, in any order, which
changes no row's total.  Only the id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchhouse.llm.common import SPACE_WORD, packed, stored

#: Fixed values of the mix: weights by place of the source, share of all sizes, most copies.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Rows of a range, about, where that gives more ranges than shuffle partitions.
BLOCK_ROWS = 250_000
SEED = "mix"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, tie): the words of each whole text."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.coalesce(text, F.lit(""))).alias("tie"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target).  Targets are shares by weight of ``share``
    times all sizes; a source above ``most`` times its size stops there, and the
    excess is shared by weight among the others, again until none is above.

    That fixed point is found in one pass: sources are stopped in the order of
    their limit per weight, so the level of the others follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    rows = placed.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "k")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("w").over(after))
    # the first source whose limit is not below the level sets the level of all after it
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.col("rank"))).over(every)
    found = (rows.withColumn("level", level).withColumn("rank", F.row_number().over(order))
             .withColumn("first", first))
    final = F.max(F.when(F.col("rank") == F.col("first"), F.col("level"))).over(every)
    return (found.withColumn("final", final)
            .select("source", "source_size",
                    F.when(F.col("rank") < F.coalesce("first", F.lit(1 << 30)), F.col("cap"))
                    .otherwise(F.col("final") * F.col("w")).alias("target")))


def _offset(source: Column, seed: str) -> Column:
    """One number in [0, 1) for each source, from a digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\0null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def copies(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED,
           block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source") -> DataFrame:
    """(doc_id, tie, size, source, source_size, target, copies) of every row."""
    base = stored(sized(docs, id_col, text_col, source_col).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    goal = stored(targets(base, weights, share, most), "mix-targets")
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-base.count() // block_rows))
    order = [F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_last(), "tie", "row"]
    # range bounds come from a sample: the numbers are stored, never computed again
    numbered = stored(base.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                      .select("doc_id", "tie", "size", "source", F.monotonically_increasing_id().alias("at")), "mix-order")
    numbered = numbered.withColumn("range", F.shiftright("at", 33))
    counts = numbered.groupBy("source", "range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    by_range = Window.partitionBy("source").orderBy("range")
    # the range of a source is found again through null-safe keys
    before = (counts.withColumn("before", F.sum("n").over(by_range) - F.col("n")).alias("c")
              .join(goal.alias("g"), F.col("c.source").eqNullSafe(F.col("g.source")))
              .select("c.source", "c.range", "first", "before", "source_size", "target"))
    placed = (numbered.alias("r").join(before.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source"))
                                       & (F.col("r.range") == F.col("b.range")))
              .select("doc_id", "tie", "size", "r.source", "source_size", "target",
                      (F.col("before") + F.col("at") - F.col("first") + 1).cast("double").alias("place")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = _offset(F.col("source"), seed)
    crossed = F.floor(F.col("place") * rate + u) - F.floor((F.col("place") - 1) * rate + u)
    return placed.withColumn("copies", F.least(crossed, F.lit(most).cast("long")))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED,
          block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.  Rows are told
    apart by id, source and a digest of the text; of equal rows, each is emitted
    as often as their places are crossed on the whole, spread evenly."""
    found = copies(docs, weights, share, most, seed, block_rows, id_col, text_col, source_col)
    times = (found.groupBy("doc_id", "source", "tie")
             .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0"))
    rows = packed(docs, id=F.col(f"`{id_col}`").cast("long"), source=F.col(f"`{source_col}`"),
                  md5=F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    joined = (rows.alias("r").join(times.alias("t"), F.col("r.id").eqNullSafe(F.col("t.doc_id"))
                                   & F.col("r.source").eqNullSafe(F.col("t.source")) & (F.col("r.md5") == F.col("t.tie")))
              .select("row", "id", "r.source", "md5", "copies", "rows"))
    # equal rows share their copies: the total is dealt out by a row number among them
    same = Window.partitionBy("id", "source", "md5").orderBy(F.lit(1))
    many = joined.where("rows > 1").withColumn("i", F.row_number().over(same) - 1)
    each = F.floor((F.col("i") + 1) * F.col("copies") / F.col("rows")) - F.floor(F.col("i") * F.col("copies") / F.col("rows"))
    out = joined.where("rows = 1").select("row", F.col("copies").alias("n")).union(many.select("row", each.alias("n")))
    return out.where("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
