"""CSV files → bronze: land every column as text, merged by column name.

Files of different seasons carry different columns, in different orders.

* ``source_files`` lists them through the file system that Spark reads with (any
  scheme, bare paths on the default file system, nested wildcards) as a DataFrame.
* ``csv_headers`` gives every file's column names.  One pass over the lines keeps
  each file's first line and whether any record may span lines; names are
  unquoted, empty ones are named by their position and repeated ones numbered,
  without regard to case.
* ``land_csv`` reads all files in one scan by position, joins each record with
  the names of its own file and puts every field under its name.  Columns that a
  file lacks are NULL.  Each row carries its season (from the file name), the file
  name and the load time.

Files split at line ends unless some record spans lines; then every file is read
as a whole.  Neither paths nor rows are gathered on the driver, only the union of
the column names, which is the schema.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchhouse.functions.season import FILE_NAME, season_from_filename
from pitchhouse.operators.joins import bounded_broadcast
from pitchhouse.operators.keys import materialize
from pitchhouse.session import ship_package

#: Lines that a header may span.
HEADER_LINES = 100
#: Places of one column over all files up to which each is a branch of its own.
MANY_PLACES = 8


class NoSourceFiles(FileNotFoundError):
    """Raised before anything is written when the pattern matches no file."""


def _reader(spark: SparkSession, recursive: bool):
    return spark.read.option("recursiveFileLookup", recursive)


def _checked(load, pattern: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise NoSourceFiles(f"no CSV file matches {pattern}") from e
        raise


def source_files(spark: SparkSession, pattern: str, recursive: bool = False) -> DataFrame:
    """(path, bytes, modified) of the files that match; contents are not read.
    ``recursive`` also takes the files in all folders below a matching one."""
    found = _checked(lambda: _reader(spark, recursive).format("binaryFile").load(pattern), pattern)
    return found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def column_names(header: str, sep: str = ",") -> list[str]:
    """The names of a header record: unquoted, empty ones by position, repeated
    ones (in any case) numbered."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for i, name in enumerate(next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline=""), delimiter=sep), [])):
        name = name or f"column{i}"
        while name.lower() in seen:
            seen[name.lower()] += 1
            name = f"{name}_{seen[name.lower()]}"
        seen[name.lower()] = 0
        out.append(name)
    return out


def csv_headers(spark: SparkSession, pattern: str, sep: str = ",", recursive: bool = False) -> DataFrame:
    """(path, names, spans): a file's columns, and whether a record may span
    lines (some line has an odd number of quotes).  A file without lines has no row."""
    ship_package(spark)
    lines = _checked(lambda: _reader(spark, recursive).text(pattern), pattern).select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("at"),
        (F.col("_metadata.file_block_start") == 0).alias("begins"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    place = F.when(F.col("begins"), F.col("at"))
    heads = materialize(lines.groupBy("path").agg(
        F.min_by("value", place).alias("header"), F.min(place).alias("first"),
        (F.max(quotes % 2) == 1).alias("spans")).where("header is not null"), "csv-heads")
    open_header = heads.where((F.length("header") - F.length(F.replace("header", F.lit('"'), F.lit("")))) % 2 == 1)
    # the same frame is scanned in the same pieces, so a line keeps its place
    more = (lines.where("begins").join(F.broadcast(open_header.select("path", "first")), "path")
            .where((F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + HEADER_LINES))
            .groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("x"))
            .select("path", F.array_join("x.value", "\n").alias("header"), F.lit(True).alias("spans")))
    if open_header.isEmpty():
        texts = heads.select("path", "header", "spans")
    else:
        texts = heads.join(more.select("path"), "path", "left_anti").select("path", "header", "spans").unionByName(more)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [column_names(h, sep) for h in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(names, pa.list_(pa.string())), batch.column(2)],
                                  names=["path", "names", "spans"])

    return materialize(texts.mapInArrow(parse, "path string, names array<string>, spans boolean"), "csv-headers")


def _source_name(source_name: str, path: Column) -> Column:
    if source_name == "file":
        return F.url_decode(F.element_at(F.split(path, "/"), -1))
    if source_name == "directory":
        # files written by a partitioned writer: <dir>/<key=value>/part-*.csv;
        # the logical source file is the partition value
        folder = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
        value = F.regexp_replace(folder, r"^[^=]*=", "")
        # the partitioned writer's folder for NULL: rows without a file name
        return F.when(value != "__HIVE_DEFAULT_PARTITION__", F.url_decode(value))
    raise ValueError(f"source_name must be 'file' or 'directory', not {source_name!r}")


def columns_of_files(heads: DataFrame, source_name: str = "file") -> DataFrame:
    """(file, column) of ``csv_headers``: which source file has which column, in lower case."""
    return heads.select(_source_name(source_name, F.col("path")).alias("file"), F.explode("names").alias("column")).select(
        "file", F.lower("column").alias("column")).distinct()


def land_csv(spark: SparkSession, pattern: str, source_name: str = "file", sep: str = ",",
             recursive: bool = False) -> DataFrame:
    """Read all files matching ``pattern`` into one all-text DataFrame.

    Columns: the union of all file columns (by file, then position; names that
    differ in case only are one column), then ``season``, ``_source_file`` and
    ``_loaded_at``.  A record with fewer fields than its header has NULLs at its
    end; one with a value beyond its header fails the load.  ``source_name`` says
    where the source file name (and so the season) comes from: the file itself
    (``LaLiga 22-23.csv``) or, for the part files of a partitioned writer, their
    partition folder (``_source_file=LaLiga 22-23.csv/``).
    """
    heads = csv_headers(spark, pattern, sep, recursive)
    one = heads.agg(F.count(F.lit(1)).alias("files"), F.max(F.size("names")).alias("width"), F.min(F.size("names")).alias("least"),
                    F.max("spans").alias("spans")).first()
    if not one["files"]:
        raise NoSourceFiles(f"no CSV file with a header matches {pattern}")
    found = (heads.select("path", F.posexplode("names").alias("pos", "name"))
             .groupBy(F.lower("name").alias("k"))
             .agg(F.min(F.struct("path", "pos", "name")).alias("first"), F.count(F.lit(1)).alias("files"),
                  F.sort_array(F.collect_set("pos")).alias("at"))
             .orderBy("first").collect())
    moved = [r["k"] for r in found if len(r["at"]) > 1 or r["files"] < one["files"]]
    lower = F.transform("names", F.lower)
    # what depends on the file alone is made once a file, not once a row
    name = _source_name(source_name, F.col("path"))
    places = heads.select("path", F.size("names").alias("n"), name.alias("_source_file"),
                          F.coalesce(name.rlike(FILE_NAME), F.lit(True)).alias("named"),
                          F.array(*[F.array_position(lower, k).cast("int") for k in moved]).cast("array<int>").alias("places"))
    places = places.withColumn("season", F.when(F.col("named"), season_from_filename("_source_file")))
    by_place = ", ".join(f"f{i} string" for i in range(one["width"] + 1))  # one more: fields beyond the widest header
    records = (_reader(spark, recursive).schema(by_place).option("header", True).option("enforceSchema", True)
               .option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", bool(one["spans"])).csv(pattern)
               .select(*[f"f{i}" for i in range(one["width"] + 1)], F.col("_metadata.file_path").alias("path")))
    rows = records.join(bounded_broadcast(places, one["files"]), "path")
    beyond = F.col(f"f{one['width']}").isNotNull()
    for i in range(one["least"], one["width"]):
        beyond = beyond | ((F.col("n") <= i) & F.col(f"f{i}").isNotNull())
    source = F.when(beyond, F.raise_error(F.concat(F.lit("record with more fields than the header of "), "path")).cast("string")) \
        .otherwise(F.col("_source_file"))
    season = F.when(F.col("named"), F.col("season")).otherwise(season_from_filename("_source_file"))

    def field(k: str, at: list[int]) -> Column:
        if k not in moved:
            return F.col(f"f{at[0]}")
        place = F.col("places")[moved.index(k)]
        if len(at) > MANY_PLACES:
            return F.when(place > 0, F.array(*[f"f{i}" for i in range(one["width"])])[place - 1])
        out = F.when(place == at[0] + 1, F.col(f"f{at[0]}"))
        for i in at[1:]:
            out = out.when(place == i + 1, F.col(f"f{i}"))
        return out

    return rows.select(*[field(r["k"], r["at"]).alias(r["first"]["name"]) for r in found], season.alias("season"),
                       source.alias("_source_file"), F.current_timestamp().alias("_loaded_at"))
