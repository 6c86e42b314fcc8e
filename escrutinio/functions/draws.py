"""Uniform numbers as a pure function of a row's id.

Retried tasks and repeated runs see the same numbers, unlike with ``rand()``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits are 52 bits, which a double holds exactly.
_HEX_DIGITS = 13
_RANGE = float(16**_HEX_DIGITS)


def uniform(id_column: Column, purpose: str, seed: int = 0) -> Column:
    """A number in [0, 1); draws with different purposes are independent."""
    digest = F.md5(F.concat_ws("|", id_column.cast("string"), F.lit(purpose), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("bigint") / F.lit(_RANGE)


def bernoulli(id_column: Column, probability: float, purpose: str = "bernoulli", seed: int = 0) -> Column:
    """True with the given probability."""
    return uniform(id_column, purpose, seed) < F.lit(probability)
