"""Column types of an all-text landed table, inferred over every value.

Each value has the set of types that can read it, as bits.  The sets of a column are
intersected inside each source file (``bit_and``: commutative, partial before any
shuffle), and the first type left, in the order of ``KINDS``, is that of the
file's column; a column without a value in a file is text there.  Across files
the types are joined upwards: whole numbers < 38-digit numbers < doubles, days <
timestamps, anything else with something else is text.

A time of day is recognised but stays text.  Whole and broken numbers have no
plus sign and no leading zero.  Days are read year first, day first or month
first, in that order of preference, with four digits of the year; days of a
two-digit year stay text, because their order cannot be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchhouse.operators.joins import bounded_broadcast
from pitchhouse.operators.keys import materialize

# Kinds in order of preference, and the column type of each.
KINDS = {"boolean": "boolean", "bigint": "bigint", "hugeint": "decimal(38,0)", "double": "double", "day ymd": "date",
         "day dmy": "date", "day mdy": "date", "timestamp": "timestamp_ntz", "time": "string"}
TRUE, FALSE = ("true", "t", "yes"), ("false", "f", "no")
NUMBERS, TIMES = ("bigint", "hugeint", "double"), ("date", "timestamp")
DAYS = ("day ymd", "day dmy", "day mdy")
LINEAGE = ("season", "_source_file", "_loaded_at")

_WHOLE = r"^-?(?:0|[1-9][0-9]*)$"
_DOUBLE = r"^(?:-?(?:(?:0|[1-9][0-9]*)(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:nan))$"
_D, _M = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])"
_DAY = {"day ymd": f"^[0-9]{{4}}-{_M}-{_D}$", "day dmy": f"^{_D}-{_M}-[0-9]{{4}}$", "day mdy": f"^{_M}-{_D}-[0-9]{{4}}$"}
_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?$"
_TIME = r"^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?$"


def _dashed(v: Column) -> Column:
    return F.translate(v, "/.", "--")


def _day(v: Column, kind: str) -> Column:
    """The day that a value shaped like ``kind`` is, NULL if the calendar lacks it.  Its
    parts are put year first and cast, which needs no parser and raises nothing."""
    d = _dashed(v)
    if kind == "day ymd":
        return d.try_cast("date")
    first, second = F.split_part(d, F.lit("-"), F.lit(1)), F.split_part(d, F.lit("-"), F.lit(2))
    month, day = (second, first) if kind == "day dmy" else (first, second)
    return F.concat_ws("-", F.right(d, F.lit(4)), month, day).try_cast("date")


def reads(v: Column, kind: str) -> Column:
    """Whether a trimmed value can be read as ``kind``."""
    if kind == "boolean":
        return F.lower(v).isin(*TRUE, *FALSE)
    if kind == "bigint":
        return v.rlike(_WHOLE) & v.try_cast("bigint").isNotNull()
    if kind == "hugeint":
        return v.rlike(_WHOLE) & v.try_cast("decimal(38,0)").isNotNull()
    if kind == "double":
        return v.rlike(_DOUBLE)
    if kind in DAYS:
        return _dashed(v).rlike(_DAY[kind]) & _day(v, kind).isNotNull()
    if kind == "timestamp":
        return v.rlike(_STAMP) & v.try_cast("timestamp_ntz").isNotNull()
    return v.rlike(_TIME)


def _bits(v: Column) -> Column:
    """The kinds that read a trimmed value; NULL for an empty one, which takes no part.

    A value is first told by its shape, and only the kinds that read some value of that
    shape are tried: whole numbers by their length, values without a digit as truth
    values or ``nan``, and of the rest only those that begin like a number or a day."""
    def tried(*kinds: str) -> Column:
        total = F.lit(0)
        for i, k in enumerate(KINDS):
            if k in kinds:
                total = total + F.when(reads(v, k), 1 << i).otherwise(0)
        return total

    bit = {k: 1 << i for i, k in enumerate(KINDS)}
    short = F.lit(bit["bigint"] | bit["hugeint"] | bit["double"])
    whole = F.when(F.length(v) <= 18, short).otherwise(tried("bigint", "hugeint", "double"))
    others = F.when(~v.rlike("^[-.0-9]"), F.lit(0)).otherwise(tried("double", *DAYS, "timestamp", "time"))
    return (F.when(v.isNull() | (v == ""), F.lit(None).cast("int")).when(v.rlike(_WHOLE), whole)
            .when(~v.rlike("[0-9]"), tried("boolean", "double")).otherwise(others))


def data_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in LINEAGE]


def file_types(raw: DataFrame, present: DataFrame | None = None, file_col: str = "_source_file") -> DataFrame:
    """(file, column, kind): one row for every column of every source file.
    ``present``: the (file, column) pairs that exist, in lower case; without it each
    file has every column."""
    names = data_columns(raw)
    # one value a row, so one expression is compiled however many columns there are; its bits are a
    # row of their own, since the aggregate would repeat the expression until it is too long to compile
    values = raw.select(F.col(file_col).alias("file"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]) \
        .unpivot("file", [f"c{i}" for i in range(len(names))], "place", "v").select("file", "place", F.trim("v").alias("v"))
    name_of = F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (f"c{i}", c)])
    long = (values.select("file", "place", F.inline(F.array(F.struct(_bits(F.col("v")).alias("bits")))))
            .groupBy("file", "place").agg(F.bit_and("bits").alias("bits")).withColumn("column", name_of[F.col("place")]))
    kind = F.lit("text")
    for i, k in reversed(list(enumerate(KINDS))):
        kind = F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, k).otherwise(kind)
    kinds = long.select("file", "column", kind.alias("kind"))
    if present is not None:
        had = present.select(F.col("file").alias("_f"), F.col("column").alias("_c"))
        kinds = kinds.join(had, F.col("file").eqNullSafe(F.col("_f")) & (F.lower("column") == F.col("_c")), "left_semi")
    return kinds


def joined_types(kinds: DataFrame) -> DataFrame:
    """(column, type): the least type above those of all files."""
    types = F.col("kind")
    for k in DAYS:
        types = F.when(F.col("kind") == k, "date").otherwise(types)
    sets = kinds.groupBy("column").agg(F.collect_set(types).alias("s"))
    one = F.when(F.size("s") == 1, F.get("s", F.lit(0)))
    for chain in (NUMBERS, TIMES):
        inside = F.size(F.array_except("s", F.array(*map(F.lit, chain)))) == 0
        top = F.lit(chain[0])
        for t in chain[1:]:
            top = F.when(F.array_contains("s", t), t).otherwise(top)
        one = F.when(inside, top).otherwise(one)
    return sets.select("column", F.coalesce(one, F.lit("text")).alias("type"))


def typed(raw: DataFrame, present: DataFrame | None = None, file_col: str = "_source_file") -> DataFrame:
    """``raw`` with every data column cast to its inferred type (``present`` as in
    ``file_types``).  The types, a row a column, reach the driver: they are the schema."""
    kinds = materialize(file_types(raw, present, file_col), "file-types")
    types = {r["column"]: r["type"] for r in joined_types(kinds).collect()}
    days = [c for c, t in types.items() if t in TIMES]
    formats = F.map_from_entries(F.collect_list(F.struct("column", "kind")))
    if days:
        read_as = kinds.where(F.col("column").isin(*days)).groupBy("file").agg(formats.alias("_kinds"))
        rows = raw.join(bounded_broadcast(read_as.withColumnRenamed("file", "_kinds_of"), None),
                        F.col(f"`{file_col}`").eqNullSafe(F.col("_kinds_of")), "left")
    else:
        rows = raw.withColumn("_kinds", F.lit(None))

    def cast(c: str) -> Column:
        v, t = F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")), types.get(c, "text")
        if t == "boolean":
            return F.lower(v).isin(*TRUE)
        if t in TIMES:
            kind = F.col("_kinds")[c]
            day = F.coalesce(*[F.when(kind == k, _day(v, k)) for k in DAYS])
            if t == "date":
                return day
            return F.when(kind == "timestamp", v.try_cast("timestamp_ntz")).otherwise(day.cast("timestamp_ntz"))
        if t in KINDS and t != "time":
            return v.cast(KINDS[t])
        return F.col(f"`{c}`")

    return rows.select(*[(cast(c) if c not in LINEAGE else F.col(c)).alias(c) for c in raw.columns])
