"""Declarative data tests: unique, not_null, accepted_values, row-count integrity.

``integrity_by_group`` compares two sides as multisets, group by group; ``relationships``
counts rows whose key has no parent.  Failure counts follow the usual data-test
definitions:

* ``not_null(c)``  – rows where ``c`` is NULL;
* ``unique(c)``    – distinct non-NULL values of ``c`` that occur more than once;
* ``accepted_values(c, vs)`` – distinct non-NULL values of ``c`` outside ``vs``
  (NULL is not a violation).

All not_null and accepted_values tests of one table run in a single
aggregation pass; each unique test is one grouped count on its column, where
partial aggregation collapses a hot value map-side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "column_name", "test_name", "failures"]


@dataclass
class TableTests:
    name: str
    df: DataFrame
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    accepted_values: dict[str, list[str]] = field(default_factory=dict)


def _q(c: str):
    return F.col(f"`{c}`")


def unique_failures(df: DataFrame, table: str, column: str) -> DataFrame:
    dup = (df.where(_q(column).isNotNull()).groupBy(_q(column)).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1))
    return dup.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test_name"), "failures")


def single_pass_failures(t: TableTests) -> DataFrame | None:
    """not_null and accepted_values tests of one table in one aggregation."""
    specs = []
    for c in t.not_null:
        specs.append((c, "not_null", F.count_if(_q(c).isNull())))
    for c, values in t.accepted_values.items():
        bad = F.when(~_q(c).isin(*values), _q(c))
        specs.append((c, "accepted_values", F.count_distinct(bad)))
    if not specs:
        return None
    one = t.df.agg(*[agg.cast("long").alias(f"f{i}") for i, (_, _, agg) in enumerate(specs)])
    rows = F.array(*[F.struct(F.lit(t.name).alias("table_name"), F.lit(c).alias("column_name"),
                              F.lit(test).alias("test_name"), F.col(f"f{i}").alias("failures"))
                     for i, (c, test, _) in enumerate(specs)])
    return one.select(F.inline(rows))


def run_tests(tables: list[TableTests], kinds=("unique", "not_null", "accepted_values")) -> DataFrame:
    """One report row per test: table_name, column_name, test_name, failures."""
    parts = []
    for t in tables:
        if "unique" in kinds:
            parts += [unique_failures(t.df, t.name, c) for c in t.unique]
        sub = TableTests(t.name, t.df,
                         not_null=t.not_null if "not_null" in kinds else [],
                         accepted_values=t.accepted_values if "accepted_values" in kinds else {})
        p = single_pass_failures(sub)
        if p is not None:
            parts.append(p)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_COLUMNS)


def row_count_integrity(source: DataFrame, target: DataFrame,
                        source_name: str = "bronze_rows", target_name: str = "gold_rows") -> DataFrame:
    """One row: both row counts and their difference (0 = no row lost).

    Both inputs are tagged and counted in one aggregation over their union
    (each side pruned to no columns), rather than a join of two scalars.
    """
    tagged = (source.select(F.lit(1).alias("s"), F.lit(0).alias("t"))
              .unionByName(target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))))
    s, t = F.sum("s").cast("long"), F.sum("t").cast("long")
    return tagged.agg(F.coalesce(s, F.lit(0)).alias(source_name),
                      F.coalesce(t, F.lit(0)).alias(target_name)).select(
        source_name, target_name, (F.col(source_name) - F.col(target_name)).alias("difference"))


def relationship_failures(child: DataFrame, fk: str, parent: DataFrame, pk: str, child_name: str) -> DataFrame:
    """Rows of ``child`` whose ``fk`` is not NULL and no ``pk`` of ``parent``.

    Distinct keys are counted first (partial before the shuffle), so the anti join
    handles one row a key however many rows share it."""
    keys = child.where(_q(fk).isNotNull()).groupBy(_q(fk).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(_q(pk).alias("k")).distinct(), "k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("failures")).select(
        F.lit(child_name).alias("table_name"), F.lit(fk).alias("column_name"), F.lit("relationships").alias("test_name"), "failures")


def relationships(tests: list[tuple[DataFrame, str, DataFrame, str, str]]) -> DataFrame:
    """A report row for each (child, fk, parent, pk, child's name)."""
    out = None
    for t in tests:
        one = relationship_failures(*t)
        out = one if out is None else out.unionByName(one)
    return out.select(*REPORT_COLUMNS)


def _digest(columns: list[str]) -> tuple:
    """Two 32-bit numbers from an MD5 over the row's values, NULL as '~'."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(_q(c).cast("string"), F.lit("~")) for c in columns]))
    return tuple(F.conv(F.substring(h, at, 8), 16, 10).cast("long") for at in (1, 9))


def integrity_by_group(source: DataFrame, target: DataFrame, groups: list[str], columns: list[str],
                       names: tuple[str, str] = ("source", "target")) -> DataFrame:
    """One row a group: both sides' row counts, their difference, and whether both
    hold the same rows the same number of times.

    A side's digest is the sum of its rows' digests, which no order changes, and
    which a lost, doubled or altered row does change even where the counts agree.  Both
    sides go through one aggregation over their union, with partial sums before the
    shuffle; groups may be NULL."""
    def side(df: DataFrame, which: int) -> DataFrame:
        a, b = _digest(columns)
        return df.select(*[_q(g) for g in groups], F.lit(which).alias("_side"), a.alias("_a"), b.alias("_b"))

    both = side(source, 0).unionByName(side(target, 1))
    sign = F.when(F.col("_side") == 0, 1).otherwise(-1)
    s, t = (f"{n}_rows" for n in names)
    out = both.groupBy(*[_q(g) for g in groups]).agg(
        F.count_if(F.col("_side") == 0).alias(s), F.count_if(F.col("_side") == 1).alias(t),
        F.sum(F.col("_a") * sign).alias("_a"), F.sum(F.col("_b") * sign).alias("_b"))
    return out.select(*[_q(g) for g in groups], s, t, (F.col(s) - F.col(t)).alias("difference"),
                      ((F.col(s) == F.col(t)) & (F.col("_a") == 0) & (F.col("_b") == 0)).alias("same_rows"))
