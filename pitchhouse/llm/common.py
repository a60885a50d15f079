"""Helpers shared by the operators: table reads, stored intermediates, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchhouse.session import ship_package, work_dir

#: Words that are separated by ASCII white space (Java and Python regular expression).
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one step of a task's inner loop takes at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: the rows are
    fixed, lineage is cut, and the loss of an executor costs nothing."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_package(spark: SparkSession) -> None:
    """Before Python tasks: executors can import this package, and are given batches
    of about ``SLICE_BYTES`` (else of 10,000 rows, which a task holds on both sides)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))
    ship_package(spark)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ascii_uppercase, ascii_lowercase)


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """Whole rows as one column ``row``, and the keys beside it: a column of ``docs``
    may have any name.  ``select("row.*")`` gives the rows back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()])


def filtered(docs: DataFrame, run: Callable) -> DataFrame:
    """``docs.mapInArrow`` that keeps or drops whole rows; columns have plain names
    inside, because that call cannot take a name with a dot."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def slices(batches: Iterator[pa.RecordBatch], text: int,
           limit: int = SLICE_BYTES) -> Iterator[tuple[list, list[str], pa.RecordBatch]]:
    """(ids, texts, rows) in pieces of about ``limit`` bytes of text; column 0 is
    the id, column ``text`` the text, with null read as empty.  A longer text is
    a piece of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate([*sizes, limit + 1]):
            total += n
            if (total > limit or i == len(sizes)) and i > start:
                part = batch.slice(start, i - start)
                yield part.column(0).to_pylist(), [t or "" for t in part.column(text).to_pylist()], part
                start, total = i, n
