"""Column expressions (JVM-side, codegen-friendly; no UDFs)."""

from pitchhouse.functions.calendar import (date_key, is_weekend, iso_week,
                                           parse_date, weekday_name)
from pitchhouse.functions.parity import (asc, desc, pct, ratio,
                                         round_half_away, round_half_even)
from pitchhouse.functions.season import (season_end_year, season_from_filename,
                                         season_start_year,
                                         season_start_year_as_written)

__all__ = [
    "asc", "desc", "pct", "ratio", "round_half_away", "round_half_even",
    "date_key", "is_weekend", "iso_week", "parse_date", "weekday_name",
    "season_from_filename", "season_start_year", "season_start_year_as_written",
    "season_end_year",
]
