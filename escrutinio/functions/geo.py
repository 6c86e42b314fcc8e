"""Coordinates as text and as points."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(token: Column) -> Column:
    """Text of a JSON number: integers as written, floats as their shortest decimal.

    Spark prints 0.00045 as ``4.5E-4``; coordinates near a meridian need ``0.00045``
    (down to 1e-4, below which the form is ``4.5e-05``).
    """
    token = token.cast("string")
    number = token.cast("double")
    plain = number.cast("string")
    mantissa = F.regexp_extract(plain, r"^-?([\d.]+)E", 1)
    exponent = F.regexp_extract(plain, r"E(-\d+)$", 1)
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    positional = F.concat(sign, F.lit("0.000"), F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), r"\.", ""))
    scientific = F.concat(
        sign,
        F.regexp_replace(mantissa, r"\.0$", ""),
        F.lit("e-"),
        F.lpad(F.substring(exponent, 2, 3), F.greatest(F.length(exponent) - 1, F.lit(2)), F.lit("0")),
    )
    return (
        F.when(~token.rlike("[.eE]"), token)
        .when(~F.contains(plain, F.lit("E")), plain)
        .when(exponent == "-4", positional)
        .when(exponent != "", scientific)
        .otherwise(plain)
    )


def coordinate_text(lat: Column, lon: Column) -> Column:
    """``lat,lon``; NULL unless both are present."""
    return F.concat(number_text(lat), F.lit(","), number_text(lon))


def parse_geo_point(text: Column) -> Column:
    """``lat,lon`` text as a point; NULL if malformed or out of range, which also
    catches most swapped pairs."""
    parts = F.split(text, ",")
    lat = F.trim(F.get(parts, F.lit(0))).try_cast("double")
    lon = F.trim(F.get(parts, F.lit(1))).try_cast("double")
    valid = (F.size(parts) == 2) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(valid, F.struct(lat.alias("lat"), lon.alias("lon")))
