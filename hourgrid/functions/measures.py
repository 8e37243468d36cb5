"""Unit conversion, predicates, sampling buckets and guarded statistics as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid import fixed_values as fv


def kelvin_to_celsius(kelvin: Column) -> Column:
    return F.round(kelvin - fv.ZERO_CELSIUS_IN_KELVIN, 2)


def pascal_to_hectopascal(pascal: Column) -> Column:
    return F.round(pascal / fv.PA_PER_HPA, 2)


def metre_to_millimetre(metre: Column) -> Column:
    return F.round(metre * fv.MM_PER_M, 4)


def wind_speed(u: Column, v: Column) -> Column:
    """Squares are taken over doubles: the raw components are floats."""
    u, v = u.cast("double"), v.cast("double")
    return F.round(F.sqrt(u * u + v * v), 2)


def is_extreme(temperature: Column, hot: float = fv.HOT_LIMIT, cold: float = fv.COLD_LIMIT) -> Column:
    return (temperature > hot) | (temperature < cold)


def positive_zero(value: Column) -> Column:
    """-0.0 becomes 0.0; other values stay."""
    return value + F.lit(0.0)


def location_key(latitude: Column, longitude: Column) -> Column:
    """64-bit hash of the coordinates, always taken over doubles: a float hashes differently."""
    return F.xxhash64(latitude.cast("double"), longitude.cast("double"))


def hash_bucket(keys: Sequence[Column], buckets: int, portable: bool = False) -> Column:
    """Repeatable bucket 0..buckets-1 of a row, from its keys only.

    ``portable`` uses the first 32 bits of an MD5 over the keys' text, which other engines can
    compute too; the default is Spark's own 64-bit hash and is much cheaper.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    if portable:
        digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in keys]).cast("binary"))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets
    return F.pmod(F.xxhash64(*keys), F.lit(buckets).cast("long"))


def pearson(x: Column, y: Column) -> Column:
    """Correlation that is null, not an error, for a constant column or no rows.

    A constant is told by its range: merging partial variances leaves a rounding rest above zero.
    """
    paired = x.isNotNull() & y.isNotNull()
    px, py = F.when(paired, x), F.when(paired, y)
    varies = (F.min(px) < F.max(px)) & (F.min(py) < F.max(py))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(px) * F.stddev_pop(py)))


def number_text(value: Column) -> Column:
    """A number as a browser shows it: whole values without the trailing .0."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
