"""Silver by event date: pruned reads, and compaction that readers never see half-done.

A lake with ``by_date`` keeps bronze and silver in a folder per day, month or year of the votes.
Micro-batches leave many small files there. Once a period is closed, ``compact`` copies its votes
into few files. The copies of one run are a version numbered by the day up to which all votes
are in versions, complete or not seen; ``silver`` takes what is before the newest such day from
the versions and the rest from the stream's own files. A vote is read from one of the two,
whatever happens meanwhile, and only the folders of the dates asked for are read.

A date is closed when no vote of it can come any more. With ``event_time`` that is so after the
delay, as later votes go to the table of votes out of time; else the caller has to know.
"""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.schemas import SILVER
from escrutinio.sinks.versions import versions, write_version
from escrutinio.streaming.lake import DATE, Lake, dated

_FIRST = date(1970, 1, 1)


def _start(lake: Lake, day: date) -> date:
    """The first day of the period that has ``day``."""
    if lake.by_date == "year":
        return day.replace(month=1, day=1)
    return day.replace(day=1) if lake.by_date == "month" else day


def _day(number: int) -> date:
    return _FIRST + timedelta(days=number)


def compacted_before(spark: SparkSession, lake: Lake) -> date | None:
    """The day before which all dates are compacted; None if none is."""
    known = versions(spark, lake.compacted)
    return _day(known[-1]) if known else None


def _live(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(dated(SILVER)).parquet(lake.silver)


def compact(spark: SparkSession, lake: Lake, before: date) -> None:
    """Copy the votes of all periods that end before ``before``, but those compacted already, into few files."""
    before = _start(lake, before)
    since = compacted_before(spark, lake)
    if since is not None and before <= since:
        return
    closed = _live(spark, lake).filter(F.col(DATE) < F.lit(before))
    if since is not None:
        closed = closed.filter(F.col(DATE) >= F.lit(since))
    # Tasks of the advised size by date: small dates share a task, large ones are split.
    write_version(closed.hint("rebalance", DATE), lake.compacted, (before - _FIRST).days, partition_by=[DATE])


def silver(spark: SparkSession, lake: Lake, since: date | None = None, until: date | None = None) -> DataFrame:
    """The silver votes of the dates from ``since`` up to, but not with, ``until``.

    Without either also those that have no date, which are never compacted.
    """

    def asked(votes: DataFrame) -> DataFrame:
        day = F.to_date("timestamp")
        if since is not None:
            votes = votes.filter((F.col(DATE) >= F.lit(_start(lake, since))) & (day >= F.lit(since)))
        return votes if until is None else votes.filter((F.col(DATE) < F.lit(until)) & (day < F.lit(until)))

    cut = compacted_before(spark, lake)
    live = _live(spark, lake)
    if cut is None:
        return asked(live)
    live = live.filter((F.col(DATE) >= F.lit(cut)) | F.col(DATE).isNull())
    folders = [f"{lake.compacted}/version={v}" for v in versions(spark, lake.compacted)]
    # Each version has dates of its own, so its files come under the version's folder.
    old = [spark.read.schema(dated(SILVER)).parquet(folder) for folder in folders]
    found = asked(live)
    for votes in old:
        found = found.unionByName(asked(votes))
    return found
