"""pitchhouse: a Spark-native warehouse for two-sided event data (matches).

Layers follow the medallion layout: CSV files land in ``bronze`` (all strings,
merged by column name), ``silver`` renames and types the columns, ``gold`` is a
star schema (season, team, date dimensions and one fact table).  Analytic
questions are plain DataFrame functions over the gold tables.

Every function takes and returns DataFrames.  Only the CSV landing runs Python
on the executors (``mapInPandas`` over header lines) and gathers on the driver
(file names by header line); the star schema and its queries do neither.
"""

from pitchhouse.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
