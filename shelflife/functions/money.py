"""Exact decimal casts and ratios.

Reports round money and percentages to cents.  Averages and ratios are
computed exactly on unscaled integers and rounded half away from zero, so the
result never depends on floating point or on an intermediate rounding step
(Spark's ``avg`` on decimals rounds to 6 digits first; a double would round
``x.xx5`` either way).  Everything stays a JVM expression.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(38, 2)      # money totals: as wide as decimals get
RATE = T.DecimalType(10, 2)       # percentages and per-unit averages
CUM_MONEY = T.DecimalType(38, 2)  # running totals
_INT = T.DecimalType(38, 0)


def _unscaled(c: Column, scale: int) -> Column:
    """The integer ``c * 10**scale`` as decimal(38,0); exact for a column with ``scale`` digits."""
    if scale == 0:
        return c.cast(_INT)
    return (c * F.lit(10 ** scale)).cast(_INT)


def _idiv(x: Column, y: Column) -> Column:
    """Exact integer quotient of non-negative decimal(38,0) values."""
    return ((x - x % y) / y).cast(_INT)


def ratio_half_up(num: Column, den: Column, *, num_scale: int, den_scale: int,
                  scale: int = 2, factor: int = 1, out: T.DecimalType = RATE) -> Column:
    """``round(num * factor / den, scale)``, half away from zero, exactly.

    ``num``/``den`` are integer or decimal columns holding at most
    ``num_scale``/``den_scale`` fractional digits.  NULL when ``den`` is 0 or NULL.
    """
    n = _unscaled(num, num_scale)
    d = _unscaled(den, den_scale)
    exp = den_scale - num_scale + scale
    a = n * F.lit(factor * 10 ** exp) if exp >= 0 else n * F.lit(factor)
    b = d if exp >= 0 else d * F.lit(10 ** (-exp))
    a, b = a.cast(_INT), b.cast(_INT)
    q = _idiv(2 * F.abs(a) + F.abs(b), 2 * F.abs(b))
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    value = signed.cast(_INT) * F.lit(Decimal(1).scaleb(-scale)) if scale else signed
    return F.when(b != 0, value.cast(out))


def avg_half_up(c: Column, in_scale: int, scale: int = 2, out: T.DecimalType = RATE) -> Column:
    """Aggregate: exact average of ``c`` rounded half away from zero."""
    return ratio_half_up(F.sum(c), F.count(c), num_scale=in_scale, den_scale=0,
                         scale=scale, out=out)


def pct(num: Column, den: Column, *, num_scale: int, den_scale: int) -> Column:
    """``num * 100 / den`` as decimal(10,2), exact half-away-from-zero; NULL if den is 0."""
    return ratio_half_up(num, den, num_scale=num_scale, den_scale=den_scale,
                         scale=2, factor=100, out=RATE)
