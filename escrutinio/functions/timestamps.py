"""Timestamps in the three spellings a served vote may carry."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MICROSECOND_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_STRICT_ISO = r"^\d{4}(-\d{2}(-\d{2}(T.*)?)?)?$"
_EPOCH = r"^-?\d{1,15}$"  # years up to 31,000 or so; microseconds of more digits overflow


def parse_timestamp(text: Column) -> Column:
    """Microsecond pattern, else ISO date with optional time, else epoch milliseconds, else NULL.

    The ISO form needs a four-digit year: Spark alone would read other digit runs as years.
    """
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(MICROSECOND_PATTERN)),
        F.when(text.rlike(_STRICT_ISO), F.try_to_timestamp(text)),
        F.when(text.rlike(_EPOCH), F.timestamp_millis(text.try_cast("bigint"))),
    )
