"""Column helpers whose results must equal the reference engine's.

* ``round_half_away`` – SQL ``ROUND(x, n)`` on a double: scale, round half away
  from zero, unscale.  Spark's own ``round`` works on the decimal text of the
  value, which differs on values such as 1.005.
* ``round_half_even`` – pandas ``Series.round(n)``: scale, round half to even.
* ``round_printed`` – Python ``round(x, n)``: the exact value of the double, half to even.
* ``pct`` – ``100.0 * num / den`` as a double, NULL when ``den`` is 0 (the
  reference guards with ``NULLIF``; Spark's ANSI mode would raise instead).
* ``asc`` / ``desc`` – NULLs last in both directions, the reference's ordering.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c, n: int = 0) -> Column:
    scale = float(10 ** n)
    return F.round(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def round_half_even(c, n: int = 0) -> Column:
    scale = float(10 ** n)
    return F.rint(_col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def round_printed(c, n: int = 2) -> Column:
    """The nearest multiple of 10^-n to the exact value of a double of moderate
    size.  ``k`` is the scaled value's floor; the exact sign of 2·10^n·x - (2k + 1)
    decides, with x cut into a high part of 26 bits and a rest so that both
    products are exact; a tie goes to the even neighbour."""
    x, scale = F.abs(_col(c).cast("double")), float(10 ** n)
    k = F.floor(x * scale).cast("double")
    split = x * 134217729.0
    high = split - (split - x)
    residual = (high * (2 * scale) - (2 * k + 1)) + (x - high) * (2 * scale)
    up = (residual > 0) | ((residual == 0) & (k % 2 == 1))
    return F.signum(_col(c).cast("double")) * (k + F.when(up, 1.0).otherwise(0.0)) / scale


def ratio(num, den) -> Column:
    """num / den as a double, NULL when den is 0 or NULL."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def pct(num, den) -> Column:
    """100.0 * num / den as a double, NULL when den is 0."""
    return F.lit(100.0) * _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def asc(*cols) -> list[Column]:
    return [_col(c).asc_nulls_last() for c in cols]


def desc(*cols) -> list[Column]:
    return [_col(c).desc_nulls_last() for c in cols]
