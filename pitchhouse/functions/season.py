"""Season label rules.

The source files are named ``LaLiga YY-YY.csv``; the season label is
``"20" + first part + "-" + second part`` (``LaLiga 22-23.csv`` → ``2022-23``).
Any other name fails the load; no name (NULL) has no season.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source naming convention.
FILE_NAME = r"^LaLiga (\d\d)-(\d\d)\.csv$"
CENTURY = "20"


def season_from_filename(name) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    label = F.concat(F.lit(CENTURY), F.regexp_extract(name, FILE_NAME, 1), F.lit("-"),
                     F.regexp_extract(name, FILE_NAME, 2))
    return F.when(name.isNull(), F.lit(None).cast("string")).when(name.rlike(FILE_NAME), label).otherwise(
        F.raise_error(F.concat(F.lit("file name without season: "), name)).cast("string"))


def season_start_year(label) -> Column:
    """First four characters of a ``YYYY-YY`` label as an int."""
    label = F.col(label) if isinstance(label, str) else label
    return F.left(label, F.lit(4)).cast("int")


def season_start_year_as_written(label) -> Column:
    """The reference's formula ``'20' || LEFT(label, 2)``: gives 2020 for every 20xx label."""
    label = F.col(label) if isinstance(label, str) else label
    return F.concat(F.lit(CENTURY), F.left(label, F.lit(2))).cast("int")


def season_end_year(label) -> Column:
    """``'20' || RIGHT(label, 2)`` as an int."""
    label = F.col(label) if isinstance(label, str) else label
    return F.concat(F.lit(CENTURY), F.right(label, F.lit(2))).cast("int")
