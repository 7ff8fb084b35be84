"""Date rules: days to expiry and the age band of a batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the model: band names and their day limits, in severity order.
CRITICAL, NEAR_EXPIRY, AGEING, FRESH, EXPIRED = "Critical", "Near Expiry", "Ageing", "Fresh", "Expired"
BAND_ORDER = (CRITICAL, NEAR_EXPIRY, AGEING, FRESH)
DEFAULT_AS_OF = dt.date(2024, 12, 31)


def as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def days_until(expiry: Column, as_of) -> Column:
    """Whole days from ``as_of`` to ``expiry`` (negative once expired)."""
    return F.datediff(expiry, as_date(as_of))


def age_band(days: Column) -> Column:
    """<= 2 Critical, 3-5 Near Expiry, 6-7 Ageing, > 7 Fresh, else Expired."""
    return (F.when(days <= 2, CRITICAL)
            .when(days.between(3, 5), NEAR_EXPIRY)
            .when(days.between(6, 7), AGEING)
            .when(days > 7, FRESH)
            .otherwise(EXPIRED))


def band_rank(band: Column) -> Column:
    """Severity order of a band, for sorting (1 = Critical)."""
    r = F.lit(None).cast("int")
    for i, b in reversed(list(enumerate(BAND_ORDER, start=1))):
        r = F.when(band == b, i).otherwise(r)
    return r
