"""Null-tolerant arithmetic, histogram buckets and great-circle distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnLike, as_column

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KILOMETRES_PER_MILE = 1.60934


def _zero_if_null(values: tuple[ColumnLike, ...]) -> list[Column]:
    if not values:
        raise ValueError("at least one value is needed")
    return [F.coalesce(as_column(v), F.lit(0)) for v in values]


def safe_add(*values: ColumnLike) -> Column:
    """Sum in which a NULL counts as 0."""
    return reduce(lambda a, b: a + b, _zero_if_null(values))


def safe_subtract(*values: ColumnLike) -> Column:
    """First value minus all the others, NULL counting as 0."""
    return reduce(lambda a, b: a - b, _zero_if_null(values))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def width_bucket(
    value: ColumnLike, low: ColumnLike, high: ColumnLike, buckets: ColumnLike | int
) -> Column:
    """Bucket 1..n of equal width over [low, high); 0 below it, n + 1 at or above ``high``."""
    n = F.lit(buckets) if isinstance(buckets, int) else as_column(buckets)
    return F.width_bucket(
        as_column(value).cast("double"), as_column(low).cast("double"),
        as_column(high).cast("double"), n,
    )


def haversine(
    lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, lam1, phi2, lam2 = (F.radians(as_column(c)) for c in (lat1, lon1, lat2, lon2))
    chord = (
        F.pow(F.sin((phi2 - phi1) / 2), 2)
        + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lam2 - lam1) / 2), 2)
    )
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles if unit == "mi" else miles * KILOMETRES_PER_MILE
