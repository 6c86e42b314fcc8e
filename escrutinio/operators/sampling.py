"""Reproducible draws as parallel column operators over an input id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.functions.draws import bernoulli, uniform
from escrutinio.operators.positions import pick, weighted_ranges

# Fixed value: probability of a blank vote.
BLANK_VOTE_PROBABILITY = 0.01


def weighted_draw(
    df: DataFrame, id_column: str, weights: DataFrame, item: str, weight: str, output: str, seed: int = 0
) -> DataFrame:
    """Draw one item per row with probability proportional to its weight."""
    ranges = weighted_ranges(weights, [], item, F.col(weight))
    return pick(df, uniform(F.col(id_column), output, seed), ranges, [], item, output)


def bernoulli_flag(
    df: DataFrame, id_column: str, output: str, probability: float = BLANK_VOTE_PROBABILITY, seed: int = 0
) -> DataFrame:
    """Add a flag that is true with the given probability."""
    return df.withColumn(output, bernoulli(F.col(id_column), probability, output, seed))


def coordinate_pick(
    df: DataFrame, id_column: str, points: DataFrame, strict: bool = True, seed: int = 0, output: str = "location"
) -> DataFrame:
    """Draw one coordinate of each row's province (``prov_code``).

    ``points`` has one row per coordinate (``prov_code``, ``coordinate``); copies count as
    weight. A province without coordinates is an error, or NULL if not ``strict``.
    """
    ranges = weighted_ranges(points, ["prov_code"], "coordinate", F.lit(1))
    drawn = pick(df, uniform(F.col(id_column), output, seed), ranges, ["prov_code"], "coordinate", output)
    if not strict:
        return drawn
    missing = F.concat(
        F.lit("there is no coordinate to draw for the province "), F.coalesce("prov_code", F.lit("NULL"))
    )
    return drawn.withColumn(output, F.coalesce(F.col(output), F.raise_error(missing).cast("string")))
