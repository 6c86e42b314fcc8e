"""The batch side of the lake: all tables rebuilt from bronze, and put in place at once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.operators.seats import allocate_seats
from escrutinio.operators.votes import accepted, dedup_in_time, dedup_votes, normalize_blank, vote_messages, votes_per_party
from escrutinio.schemas import BRONZE, MESSAGE, SEATS, SILVER, SILVER_COLUMNS, THRESHOLD
from escrutinio.sinks.versions import read_version, versions, write_version
from escrutinio.streaming.lake import Lake

#: The tables of a rebuild, in the order in which they are written; the last one makes it visible.
TABLES = {"silver": SILVER, "clean": MESSAGE, "seats": SEATS}


def _path(lake: Lake, table: str) -> str:
    return f"{lake.rebuilt}/{table}"


def rebuild(
    spark: SparkSession,
    lake: Lake,
    seats_reference: DataFrame,
    threshold: float = THRESHOLD,
    within: str | None = None,
) -> int:
    """Silver, clean messages and seats from all of bronze, as a new version; returns its number.

    ``within`` is the delay of a lake in event time. Of copies that differ the earliest vote
    stays, where the stream has kept the first to arrive.
    """
    known = versions(spark, _path(lake, "seats"))
    version = known[-1] + 1 if known else 0
    votes = accepted(spark.read.schema(BRONZE).parquet(lake.bronze))
    votes = dedup_votes(votes.select(*SILVER_COLUMNS)) if within is None else dedup_in_time(votes, within)
    write_version(normalize_blank(votes.select(*SILVER_COLUMNS)), _path(lake, "silver"), version)
    silver = read_version(spark, _path(lake, "silver"), version, SILVER)
    write_version(vote_messages(silver), _path(lake, "clean"), version)
    write_version(allocate_seats(votes_per_party(silver), seats_reference, threshold), _path(lake, "seats"), version)
    return version


def rebuilt(spark: SparkSession, lake: Lake, table: str, version: int | None = None) -> DataFrame:
    """A table of the newest complete rebuild, or of the one given.

    The seats are written last: a rebuild is seen with all its tables or not at all.
    """
    if version is None:
        known = versions(spark, _path(lake, "seats"))
        if not known:
            return spark.createDataFrame([], TABLES[table])
        version = known[-1]
    return read_version(spark, _path(lake, table), version, TABLES[table])


def differences(streamed: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of one side only, with how many more of them there are: ``extra`` above 0 in the stream.

    One aggregate over both, in which equal rows meet in the map tasks; NULLs are equal.
    """
    names = streamed.columns
    both = streamed.withColumn("_n", F.lit(1)).unionByName(batch.select(*names).withColumn("_n", F.lit(-1)))
    return both.groupBy(*names).agg(F.sum("_n").alias("extra")).filter("extra <> 0")
