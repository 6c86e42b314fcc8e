"""Raw vote messages to clean, counted votes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from escrutinio.functions.keys import vote_doc_id
from escrutinio.schemas import BLANK, PARTY_KEY, SILVER_COLUMNS, VOTE

# Fields of a clean message, in order.
MESSAGE_FIELDS = [
    "doc_id",
    "id",
    "political_party",
    "location",
    "timestamp",
    "province_iso_code",
    "province_name",
    "blank_vote",
    "autonomic_region_iso_code",
    "autonomic_region_name",
]
# The columns that decide the count of a vote, in the order in which copies compare.
COUNTED_COLUMNS = ["timestamp", "political_party", "province_name", "autonomic_region_name", "blank_vote"]

# Why a vote is out of time, see ``time_reason``.
REASONS = ["undated", "late", "early"]

# to_json alone would cut timestamps to milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def parse_votes(messages: DataFrame, *keep: str) -> DataFrame:
    """JSON message values to the nine vote fields; the columns ``keep`` of a message go with them.

    A message that is not one valid JSON object, or has no id or an empty one, becomes a row
    without an id whose text is kept in ``raw``. A field that cannot be read is NULL, and the
    vote is counted all the same.

    ``inline`` keeps the parse a single step: as a projection, a later filter on a field
    would be pushed below it and parse every message a second time.
    """
    # As an array, a message of several objects does not pass for its first one. The parser does
    # not look behind the end of the array: a text with a bracket of its own must also be the
    # value of a field, which no text is that closes an array early.
    objects = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), ArrayType(VOTE))
    as_field = F.json_object_keys(F.concat(F.lit('{"vote":'), F.col("value"), F.lit("}")))
    whole = F.when(F.contains("value", F.lit("]")), as_field.isNotNull()).otherwise(True)
    vote = F.transform(F.array(objects), lambda found: F.when((F.size(found) == 1) & whole, found[0]))
    has_id = F.coalesce(F.col("id") != "", F.lit(False))
    return (
        messages.select(F.col("value").cast("string").alias("value"), *(F.col(n).alias(f"_{n}") for n in keep))
        .select("value", *(f"_{n}" for n in keep), F.inline(vote))
        .select(
            *(F.when(has_id, F.col(name)).alias(name) for name in VOTE.names),
            F.when(~has_id, F.col("value")).alias("raw"),
            *(F.col(f"_{n}").alias(n) for n in keep),
        )
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be counted."""
    return parsed.filter(F.col("id").isNull())


def accepted(parsed: DataFrame) -> DataFrame:
    """Parsed votes that have an id."""
    return parsed.filter(F.col("id").isNotNull())


def dedup_votes(votes: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """One row per vote id; the earliest copy wins, whatever the partitioning or retries.

    Copies without a time come after those with one; equal times are settled by the other
    columns, in the order of ``SILVER_COLUMNS`` and then of the table.

    An aggregate rather than a window: copies collapse in the map tasks, so an id that
    holds a large share of the rows sends one row per task through the shuffle. The price
    are two sorts, as the smallest struct has no fixed width to be updated in place.
    """
    unknown = [name for name in order if name not in votes.columns]
    if unknown:
        raise ValueError(f"no such columns to order by: {unknown}")
    rest = sorted(
        (name for name in votes.columns if name != "id" and name not in order),
        key=lambda name: SILVER_COLUMNS.index(name) if name in SILVER_COLUMNS else len(SILVER_COLUMNS),
    )
    known = [F.col(name).isNull().alias(f"_no_{name}") for name in order]
    entry = F.struct(*(c for pair in zip(known, order, strict=True) for c in pair), *rest)
    kept = votes.groupBy("id").agg(F.min(entry).alias("vote"))
    return kept.select(*(F.col("id") if name == "id" else F.col("vote")[name].alias(name) for name in votes.columns))


def counted_votes(votes: DataFrame) -> DataFrame:
    """The columns that a count needs of ``dedup_votes``, and none of the others shuffled.

    They lead the order of the copies, so the winner's values are the same.
    """
    narrow = votes.select("id", *COUNTED_COLUMNS)
    return normalize_blank(dedup_votes(narrow)).select("id", *PARTY_KEY)


def dedup_stream(votes: DataFrame, salts: int = 1, within: str | None = None) -> DataFrame:
    """Streaming form of ``dedup_votes``: the first copy to arrive wins.

    A streaming dedup has no map-side step, so all copies of one id meet in one task.
    Where one id may hold a large share of the messages, ``salts`` > 1 puts a first dedup
    on (id, salt) before it, which spreads them over that many tasks and lets at most one
    copy per salt reach the exact one. It doubles the state and the shuffles.

    ``within`` (for example ``"2 days"``) forgets an id that long after its arrival; a copy
    that comes later is counted again. It goes by the time of arrival, not by the vote's
    own: no vote is ever too late to be counted. Without it the state grows for as long as
    the stream runs.
    """
    columns = votes.columns
    if within is not None:
        votes = votes.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)

    def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.dropDuplicates(keys) if within is None else df.dropDuplicatesWithinWatermark(keys)

    if salts > 1:
        # The partition index is fixed within a micro-batch, so a retried task salts alike.
        votes = dedup(votes.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))), ["id", "_salt"])
    return dedup(votes, ["id"]).select(*columns)


def _interval(within: str) -> Column:
    return F.expr(f"INTERVAL '{within}'")


def time_reason(within: str) -> Column:
    """Why a vote is out of time, from the row alone: 'undated', or 'late' or 'early' by ``within``
    or more against its arrival; NULL if it is in time.

    No watermark is asked, so micro-batches, restarts and other queries decide alike.
    """
    at, arrived = F.col("timestamp"), F.coalesce("arrived", "ingested", "timestamp")
    return (
        F.when(at.isNull(), "undated")
        .when(at <= arrived - _interval(within), "late")
        .when(at >= arrived + _interval(within), "early")
    )


def out_of_time(votes: DataFrame, within: str) -> DataFrame:
    """The votes that ``dedup_in_time`` leaves out, with the ``reason``: nothing is lost unseen."""
    return votes.withColumn("reason", time_reason(within)).filter(F.col("reason").isNotNull())


def dedup_in_time(votes: DataFrame, within: str, salts: int = 1) -> DataFrame:
    """One row per id of the votes in time, on a stream with a state bounded by event time.

    An id is forgotten ``within`` after its vote's time, by a watermark on it. All copies of a
    vote that are in time come before that, if ingestion lags by less than ``within``. The time
    under the watermark is kept between ``ingested`` less ``within`` and ``ingested``, which
    does not step back: no vote in time can fall behind the watermark, nor one that is dated
    ahead push it. So the state drops nothing by itself, and kept votes, copies and the rows of
    ``out_of_time`` are all there were.
    """
    ingested = F.coalesce("ingested", F.current_timestamp())
    earliest = ingested - _interval(within) + F.expr("INTERVAL '1 millisecond'")
    event = F.least(F.greatest("timestamp", earliest), ingested)
    columns = votes.columns
    votes = votes.filter(time_reason(within).isNull())
    if not votes.isStreaming:
        return dedup_votes(votes)
    votes = votes.withColumn("_event", event).withWatermark("_event", within)
    if salts > 1:
        salted = votes.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        votes = salted.dropDuplicatesWithinWatermark(["id", "_salt"])
    return votes.dropDuplicatesWithinWatermark(["id"]).select(*columns)


def normalized_party() -> Column:
    """Blank votes are a party of their own; a vote without a blank flag keeps its party."""
    return F.when(F.col("blank_vote"), F.lit(BLANK)).otherwise(F.col("political_party"))


def normalize_blank(votes: DataFrame) -> DataFrame:
    return votes.withColumn("political_party_norm", normalized_party())


def clean_votes(messages: DataFrame) -> DataFrame:
    """Parse, drop rejects, remove repeated ids and normalise blank votes."""
    votes = accepted(parse_votes(messages)).select(*SILVER_COLUMNS)
    return normalize_blank(dedup_votes(votes))


def votes_per_party(clean: DataFrame) -> DataFrame:
    """Votes per region, province and party; on a stream, the running count."""
    return clean.groupBy(*PARTY_KEY).agg(F.count("*").alias("votes_per_party"))


def vote_messages(clean: DataFrame) -> DataFrame:
    """Key and JSON value of each clean vote. NULL fields are left out of the JSON."""
    value = F.struct(
        *MESSAGE_FIELDS,
    )
    return clean.withColumn("doc_id", vote_doc_id()).select(
        F.col("doc_id").alias("key"), F.to_json(value, JSON_OPTIONS).alias("value")
    )
