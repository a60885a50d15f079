"""Table and view writes for the three layers.

``write_table`` is ``CREATE OR REPLACE TABLE … AS SELECT``, into the catalog
(``layer.name``) or to a path.  In the catalog a table is a view over its current
version: a write makes a new table of its own (``name__v…``) and then swaps the view
in one catalog call.  Readers see the old rows or the new ones, a write that
fails half-way changes nothing, and a reader that started before the swap can
finish, because the version before the current one is kept; older ones are
dropped.

``create_view`` makes a persistent view from SQL, so other sessions of the same
catalog read it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")
_VERSION = "__v"


def ensure_layers(spark: SparkSession, layers=LAYERS, location: str | None = None) -> None:
    """Create the layers' databases (below ``location``, if given)."""
    for layer in layers:
        at = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{at}")


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a table, oldest first."""
    layer, _, table = name.rpartition(".")
    found = [t.name for t in spark.catalog.listTables(layer or None) if t.name.startswith(f"{table}{_VERSION}")]
    return [f"`{layer}`.`{t}`" if layer else f"`{t}`" for t in sorted(found)]


def _replace(df: DataFrame, name: str, partition_by: list[str] | None, fmt: str) -> DataFrame:
    spark = df.sparkSession
    layer, _, table = name.rpartition(".")
    if layer:
        ensure_layers(spark, [layer])
    prefix = f"`{layer}`." if layer else ""
    version = f"{prefix}`{table}{_VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}`"
    earlier = versions(spark, name)
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    known = {t.name: t.tableType for t in spark.catalog.listTables(layer or None)}
    if known.get(table) not in (None, "VIEW"):  # a plain table of that name, from before versions were kept
        spark.sql(f"DROP TABLE {prefix}`{table}`")
    columns = ", ".join("`" + c.replace("`", "``") + "`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {prefix}`{table}` AS SELECT {columns} FROM {version}")
    for old in earlier[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(f"{prefix}`{table}`")


def write_table(df: DataFrame, name: str | None = None, path: str | None = None,
                partition_by: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` replacing any previous content and return a reader over it."""
    if (name is None) == (path is None):
        raise ValueError("give exactly one of name or path")
    if name is not None:
        return _replace(df, name, partition_by, fmt)
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    # read with the written schema: partition column types are not re-inferred,
    # and partition columns (stored last) return to their written position
    out = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
    return out.select(*[f"`{c}`" for c in df.columns])


def create_view(spark: SparkSession, sql: str, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name AS sql``; the result reads it."""
    if "." in name:
        ensure_layers(spark, [name.split(".")[0]])
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)
