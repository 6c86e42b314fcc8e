"""Votes through bronze, silver and gold as four streaming queries.

Each layer reads the table before it: bronze is the only reader of the message source,
clean messages and seats both follow silver and so agree on which duplicate survived.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from escrutinio.folders import make_folder
from escrutinio.functions.keys import seat_doc_id, seat_key
from escrutinio.operators.seats import allocate_seats, seat_messages, seat_tombstones
from escrutinio.operators.upsert import upsert_latest
from escrutinio.operators.votes import (
    REASONS,
    accepted,
    dedup_in_time,
    dedup_stream,
    normalize_blank,
    out_of_time,
    parse_votes,
    vote_messages,
    votes_per_party,
)
from escrutinio.schemas import (
    ARRIVAL,
    BRONZE,
    PARTY_KEY,
    SEAT_DOCUMENT,
    SEATS,
    SILVER,
    SILVER_COLUMNS,
    THRESHOLD,
    SERVED,
    VOTE_NORM,
)
from escrutinio.session import configure_state
from escrutinio.sinks.buckets import BucketTable
from escrutinio.sinks.messages import FileSink
from escrutinio.sinks.versions import (
    drop_old_versions,
    read_current,
    read_version,
    versions,
    write_version,
)

# Fixed value: how often the seats are computed again.
SEATS_INTERVAL = "1 minute"

# Buckets of the tables that the seats keep up to date, see ``sinks.buckets``. Changes are a
# province's parties at a time; a country has some 50 provinces.
PROVINCE_BUCKETS = 64
SERVED_BUCKETS = 64

DATE = "date"
_POOL = "spark.scheduler.pool"
_PARTITIONS = "spark.sql.shuffle.partitions"

# Files of a layer that one micro-batch reads at most, so that a backlog is worked off in parts.
# They are counted in full files: a micro-batch above writes one for each of its tasks, most of them
# small, and their number says nothing of the work.
MAX_FILES = 1000
FILE_BYTES = 256 << 20

_COUNTS = StructType(
    [*(StructField(n, StringType(), True) for n in PARTY_KEY), StructField("votes_per_party", LongType(), True)]
)


@dataclass(frozen=True)
class Lake:
    """Folders of the lake. A lake and its checkpoints belong together: versions of the
    gold tables are numbered by micro-batch."""

    base: str
    checkpoints: str
    #: "day", "month" or "year": bronze and silver in a folder per period of the votes' dates, see
    #: ``streaming.by_date``. Choose it before the first start, so that a folder fills some files.
    by_date: str | None = None

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/votes"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/votes_normalized"

    @property
    def out_of_time(self) -> str:
        return f"{self.base}/silver/votes_out_of_time"

    @property
    def compacted(self) -> str:
        """Silver of closed dates in few files."""
        return f"{self.base}/silver/votes_compacted"

    @property
    def enriched(self) -> str:
        return f"{self.base}/gold/votes_enriched"

    @property
    def provinces(self) -> str:
        """Versions of the dimension of provinces."""
        return f"{self.base}/reference/provinces"

    @property
    def rebuilt(self) -> str:
        """Versions of the tables rebuilt in batch, see ``streaming.replay``."""
        return f"{self.base}/rebuilt"

    @property
    def clean(self) -> str:
        return f"{self.base}/gold/votes_clean"

    @property
    def counts(self) -> str:
        return f"{self.base}/gold/votes_per_party"

    @property
    def seats(self) -> str:
        return f"{self.base}/gold/votes_parties_provinces_seats"

    @property
    def served(self) -> str:
        return f"{self.base}/served/votes_seats_provinces"

    def bucketed(self, table: str) -> str:
        """Folder of a table kept up to date in buckets (``start_seats(changes_only=True)``)."""
        return f"{self.base}/buckets/{table}"

    @property
    def seat_messages(self) -> str:
        return f"{self.base}/messages/votes_seats_provinces"

    def checkpoint(self, layer: str) -> str:
        return f"{self.checkpoints}/{layer}"


@dataclass(frozen=True)
class Trigger:
    """When a query runs: as soon as it can, every ``interval``, or once over what is there.

    A micro-batch reads as many bytes of a layer as ``max_files`` full files have (``FILE_BYTES``
    each), and one file at the least. So the number of micro-batches follows the data, not the number of
    tasks that wrote the files.

    ``partitions`` is the number of state partitions of a query that has no checkpoint yet, the
    session's shuffle partitions by default. Each is a store of its own that a micro-batch opens and
    commits, so that for little state many of them take longer than the rows do. A checkpoint keeps its number.
    """

    interval: str | None = None
    available_now: bool = False
    max_files: int | None = None
    partitions: int | None = None

    def start(self, writer: DataStreamWriter, checkpoint: str, mode: str = "append") -> StreamingQuery:
        """Start a query named after its checkpoint, in a scheduler pool of that name.

        With ``spark.scheduler.mode=FAIR`` the pools share the cluster: a backlog in one layer
        does not keep the seats waiting.
        """
        name = checkpoint.rstrip("/").rsplit("/", 1)[-1]
        context = SparkSession.active().sparkContext
        before = context.getLocalProperty(_POOL)
        context.setLocalProperty(_POOL, name)
        try:
            return self._start(writer.queryName(f"{name}-{uuid.uuid4().hex[:8]}"), checkpoint, mode)
        finally:
            context.setLocalProperty(_POOL, before)

    def _start(self, writer: DataStreamWriter, checkpoint: str, mode: str) -> StreamingQuery:
        writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
        if self.available_now:
            writer = writer.trigger(availableNow=True)
        elif self.interval:
            writer = writer.trigger(processingTime=self.interval)
        if self.partitions is None:
            return writer.start()
        conf = SparkSession.active().conf
        before = conf.get(_PARTITIONS)
        conf.set(_PARTITIONS, str(self.partitions))
        try:
            return writer.start()  # the query has a session of its own from here on
        finally:
            conf.set(_PARTITIONS, before)


def dated(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(DATE, DateType(), True)])


def layer(spark: SparkSession, lake: Lake, path: str, schema: StructType, trigger: Trigger) -> DataFrame:
    """The stream of a layer's files; those of a lake by date, without the date."""
    make_folder(spark, path)
    reader = spark.readStream.schema(dated(schema) if lake.by_date else schema)
    if trigger.max_files is not None:
        reader = reader.option("maxBytesPerTrigger", trigger.max_files * FILE_BYTES)
    return reader.parquet(path).select(*schema.names)


def _files(rows: DataFrame, lake: Lake, path: str) -> DataStreamWriter:
    if not lake.by_date:
        return rows.writeStream.format("parquet").option("path", path)
    rows = rows.withColumn(DATE, F.to_date(F.date_trunc(lake.by_date, "timestamp")))
    return rows.writeStream.format("parquet").option("path", path).partitionBy(DATE)


def _count() -> Column:
    return F.count(F.lit(1))


def with_arrival(messages: DataFrame) -> DataFrame:
    """Add ``arrived``, the broker's time of a message if it has one, and ``ingested``, the micro-batch's."""
    now = F.current_timestamp()
    known = next((name for name in ("arrived", "timestamp") if name in messages.columns), None)
    return messages.withColumns({"arrived": F.col(known) if known else now, "ingested": now})


def start_bronze(messages: DataFrame, lake: Lake, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Append parsed messages and when they came; unreadable ones keep their text."""
    configure_state(messages.sparkSession)
    parsed = parse_votes(with_arrival(messages), *ARRIVAL)
    parsed = parsed.observe("bronze", _count().alias("read"), F.count_if(F.col("id").isNull()).alias("rejected"))
    return trigger.start(_files(parsed, lake, lake.bronze), lake.checkpoint("bronze"))


def start_silver(
    spark: SparkSession,
    lake: Lake,
    trigger: Trigger = Trigger(),
    salts: int = 1,
    within: str | None = None,
    event_time: bool = False,
) -> StreamingQuery:
    """Append each vote id once, blank votes normalised. See ``dedup_stream`` for the options.

    With ``event_time`` the votes that ``out_of_time`` names are left to ``start_out_of_time``.
    """
    configure_state(spark)
    votes = accepted(layer(spark, lake, lake.bronze, BRONZE, trigger))
    votes = votes.observe("votes", _count().alias("read"))
    if event_time:
        votes = dedup_in_time(votes, _given(within), salts)
    else:
        votes = dedup_stream(votes.select(*SILVER_COLUMNS), salts, within)
    silver = normalize_blank(votes.select(*SILVER_COLUMNS)).observe("silver", _count().alias("kept"))
    return trigger.start(_files(silver, lake, lake.silver), lake.checkpoint("silver"))


def _given(within: str | None) -> str:
    if within is None:
        raise ValueError("event time needs a delay: within")
    return within


def start_out_of_time(spark: SparkSession, lake: Lake, within: str, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Append the votes that silver leaves out by their time, each copy of them, with the reason."""
    configure_state(spark)
    votes = out_of_time(accepted(layer(spark, lake, lake.bronze, BRONZE, trigger)), within)
    reasons = [F.count_if(F.col("reason") == name).alias(name) for name in REASONS]
    votes = votes.observe("out_of_time", *reasons)
    writer = votes.writeStream.format("parquet").option("path", lake.out_of_time)
    return trigger.start(writer, lake.checkpoint("out_of_time"))


def start_clean(spark: SparkSession, lake: Lake, sink=None, trigger: Trigger = Trigger()) -> StreamingQuery:
    """Publish clean votes as key and JSON value; served insert-only."""
    configure_state(spark)
    messages = vote_messages(layer(spark, lake, lake.silver, SILVER, trigger))
    return trigger.start((sink or FileSink(lake.clean)).stream(messages), lake.checkpoint("clean"))


def start_seats(
    spark: SparkSession,
    lake: Lake,
    seats_reference: DataFrame,
    sink=None,
    trigger: Trigger = Trigger(interval=SEATS_INTERVAL),
    threshold: float = THRESHOLD,
    keep: int = 10,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    changes_only: bool = False,
) -> StreamingQuery:
    """Keep the running count of votes and publish the seats it gives at each trigger.

    With ``changes_only`` a micro-batch has the counts that changed, and only their provinces
    are allocated and rewritten (``change_publisher``); else all counts (``seat_publisher``).
    The tables of the two ways are apart; each starts from its own checkpoint.
    """
    configure_state(spark)
    counts = votes_per_party(layer(spark, lake, lake.silver, VOTE_NORM, trigger).select(*PARTY_KEY))
    sink = sink or FileSink(lake.seat_messages)
    if changes_only:
        publish = change_publisher(lake, seats_reference, sink, threshold, clock)
        return trigger.start(counts.writeStream.foreachBatch(publish), lake.checkpoint("seat_changes"), "update")
    publish = seat_publisher(lake, seats_reference, sink, threshold, keep, clock)
    return trigger.start(counts.writeStream.foreachBatch(publish), lake.checkpoint("seats"), "complete")


def seat_publisher(
    lake: Lake,
    seats_reference: DataFrame,
    sink,
    threshold: float = THRESHOLD,
    keep: int = 10,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> Callable[[DataFrame, int], None]:
    """The micro-batch callback: counts -> gold seats -> messages -> served table.

    Each step reads the table the step before has written, so the streaming state is read
    once, a lost executor costs no recomputation of it, and nothing needs to be cached.
    Every write is named by the micro-batch: a repeated batch replaces its own output.
    """
    spark = seats_reference.sparkSession

    def publish(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, lake.counts, batch_id)
        counts = read_version(spark, lake.counts, batch_id, _COUNTS)
        if counts.isEmpty():
            return
        at = F.lit(clock()).cast("timestamp")
        write_version(allocate_seats(counts, seats_reference, threshold), lake.seats, batch_id)
        seats = read_version(spark, lake.seats, batch_id, SEATS)
        previous = read_current(spark, lake.seats, SEATS, before=batch_id)
        messages = seat_messages(seats, at).unionByName(seat_tombstones(previous, seats))
        sink.write(messages, batch_id)
        served = read_current(spark, lake.served, SERVED, before=batch_id)
        changes = seat_changes(previous, seats, at, batch_id)
        write_version(upsert_latest(served, changes, "seat_key", ["sequence"], "seats"), lake.served, batch_id)
        for path in (lake.counts, lake.seats, lake.served):
            drop_old_versions(spark, path, keep)

    return publish


@dataclass(frozen=True)
class SeatTables:
    """The tables that ``change_publisher`` keeps up to date."""

    counts: BucketTable
    seats: BucketTable
    served: BucketTable
    changes: str
    work: str

    @classmethod
    def of(cls, spark: SparkSession, lake: Lake) -> "SeatTables":
        province = ("province_name",)
        return cls(
            BucketTable(spark, lake.bucketed("votes_per_party"), _COUNTS, province, PROVINCE_BUCKETS),
            BucketTable(spark, lake.bucketed("seats"), SEATS, province, PROVINCE_BUCKETS),
            BucketTable(spark, lake.bucketed("served"), SERVED, ("seat_key",), SERVED_BUCKETS),
            lake.bucketed("seat_changes"),
            lake.bucketed("work"),
        )


def change_publisher(
    lake: Lake,
    seats_reference: DataFrame,
    sink,
    threshold: float = THRESHOLD,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> Callable[[DataFrame, int], None]:
    """The callback of micro-batches that hold changed counts only (update mode).

    Counts -> changes of the seats of these provinces -> messages -> gold seats -> served table.
    Work and writes follow the change: the provinces with a changed count are allocated, and
    the buckets these provinces and their seats fall into are rewritten.

    A repeated micro-batch gives the same tables: counts are absolute, and what the batch
    changes in the seats is written once, before anything is put in place, and taken from there
    if the batch comes again.
    """
    spark = seats_reference.sparkSession
    tables = SeatTables.of(spark, lake)

    def publish(batch: DataFrame, batch_id: int) -> None:
        if batch_id not in versions(spark, tables.changes):
            counted = _written(spark, batch, f"{tables.work}/counts", batch_id)
            provinces = counted.select("province_name").distinct()
            touched = tables.counts.touched(provinces)
            if not touched:
                return
            merged = replaced_counts(tables.counts.read_buckets(touched), counted)
            tables.counts.replace(merged, touched, batch_id)
            seats = allocate_seats(tables.counts.lookup(provinces), seats_reference, threshold)
            seats = _written(spark, seats, f"{tables.work}/seats", batch_id)
            at = F.lit(clock()).cast("timestamp")
            previous = tables.seats.lookup(provinces)
            write_version(seat_changes(previous, seats, at, batch_id), tables.changes, batch_id)
        changes = read_version(spark, tables.changes, batch_id, SERVED)
        others = _without(tables.seats.read(), changes, ["province_name"])
        sink.write(seat_change_messages(changes, others), batch_id)
        seats = changes.select(*(F.col(c).alias(n) for c, n in _DOCUMENT_COLUMNS), "seats")
        touched = tables.seats.touched(seats)
        if touched:
            tables.seats.replace(replaced_provinces(tables.seats.read_buckets(touched), seats), touched, batch_id)
        tables.served.upsert(changes, ["sequence"], "seats", batch_id)
        for path in (tables.changes, f"{tables.work}/counts", f"{tables.work}/seats"):
            drop_old_versions(spark, path, 1)

    return publish


def _written(spark: SparkSession, df: DataFrame, path: str, version: int) -> DataFrame:
    write_version(df, path, version)
    return read_version(spark, path, version, df.schema)


_DOCUMENT_COLUMNS = [
    ("autonomic_region_name", "autonomic_region_name"),
    ("province_name", "province_name"),
    ("political_party", "political_party_norm"),
]


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys, NULLs among them, are not those of any other row."""
    keys_of = others.select(*(F.col(name).alias(f"_{name}") for name in keys)).distinct()
    return rows.join(keys_of, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys], "left_anti")


def replaced_counts(current: DataFrame, changed: DataFrame) -> DataFrame:
    """``current`` with the changed counts in place of their old ones."""
    return _without(current, changed, PARTY_KEY).unionByName(changed.select(*current.columns))


def replaced_provinces(current: DataFrame, changes: DataFrame) -> DataFrame:
    """``current`` with all seats of the provinces in ``changes`` in place of their old ones.

    ``changes`` has each seat count of these provinces, NULL for parties no longer reported.
    """
    return _without(current, changes, ["province_name"]).unionByName(changes.filter("seats IS NOT NULL"))


def seat_change_messages(changes: DataFrame, others: DataFrame) -> DataFrame:
    """Messages of the rows of ``seat_changes``: seats now, tombstones for keys that nobody reports any more.

    ``others`` are the seats of all other provinces, which can share a readable key.
    """
    seats = changes.filter("seats IS NOT NULL")
    parties = seats.select(*(F.col(c).alias(n) for c, n in _DOCUMENT_COLUMNS), "seats", "updated_at")
    gone = changes.filter("seats IS NULL").select(F.col("doc_id").alias("key")).distinct()
    reported = seats.select(F.col("doc_id").alias("key")).unionByName(others.select(seat_doc_id().alias("key")))
    gone = gone.join(reported, "key", "left_anti")
    return seat_messages(parties, F.col("updated_at")).unionByName(gone.select("key", F.lit(None).cast("string").alias("value")))


def seat_documents(messages: DataFrame, at) -> DataFrame:
    """Seat messages as documents; a tombstone has its key and time only."""
    value = F.from_json("value", SEAT_DOCUMENT)
    return messages.select("key", value.alias("value")).select(
        F.col("key").alias("doc_id"),
        *(F.col("value")[n].alias(n) for n in SEAT_DOCUMENT.names if n not in ("doc_id", "updated_at")),
        F.coalesce(F.col("value")["updated_at"], at).alias("updated_at"),
    )


def seat_changes(previous: DataFrame, seats: DataFrame, at, sequence: int) -> DataFrame:
    """Rows for the served table: the seats now, and NULL seats for what is no longer reported.

    Keyed by ``seat_key`` and not by the readable key, which different seats may share, and
    ordered by the micro-batch.
    """
    same = [previous[name].eqNullSafe(seats[name]) for name in PARTY_KEY]
    gone = previous.join(seats, same, "left_anti").withColumn("seats", F.lit(None).cast("bigint"))
    return seats.select(*SEATS.names).unionByName(gone.select(*SEATS.names)).select(
        seat_key(*PARTY_KEY).alias("seat_key"),
        F.lit(sequence).cast("bigint").alias("sequence"),
        seat_doc_id().alias("doc_id"),
        "province_name",
        F.col("political_party_norm").alias("political_party"),
        "autonomic_region_name",
        "seats",
        at.alias("updated_at"),
    )


def current_seats(spark: SparkSession, lake: Lake, changes_only: bool = False) -> DataFrame:
    """The gold seats of the newest complete micro-batch, of the way in which the seats are kept."""
    if changes_only:
        return SeatTables.of(spark, lake).seats.read()
    return read_current(spark, lake.seats, SEATS)


def served_seats(spark: SparkSession, lake: Lake, changes_only: bool = False) -> DataFrame:
    """The served seat documents, of the way in which the seats are kept."""
    if changes_only:
        return SeatTables.of(spark, lake).served.read().select(*SEAT_DOCUMENT.names)
    return read_current(spark, lake.served, SERVED).select(*SEAT_DOCUMENT.names)


def rejected_votes(spark: SparkSession, lake: Lake) -> DataFrame:
    """Text of the messages that could not be counted."""
    return spark.read.schema(BRONZE).parquet(lake.bronze).filter(F.col("id").isNull()).select("raw")


def run_lake(
    messages: DataFrame,
    lake: Lake,
    seats_reference: DataFrame,
    clean_sink=None,
    seats_sink=None,
    seats_trigger: Trigger = Trigger(interval=SEATS_INTERVAL),
    salts: int = 1,
    within: str | None = None,
    trigger: Trigger = Trigger(max_files=MAX_FILES),
    threshold: float = THRESHOLD,
    keep: int = 10,
    changes_only: bool = False,
    event_time: bool = False,
) -> list[StreamingQuery]:
    """Start all four queries, and one more with ``event_time``; ``await_any`` waits for them.

    ``trigger`` is that of bronze, silver and clean; its ``max_files`` bounds a micro-batch
    that reads a layer. The source of ``messages`` has its own limit, see ``sources.messages``.
    """
    spark = messages.sparkSession
    return [
        start_bronze(messages, lake, trigger),
        start_silver(spark, lake, trigger, salts, within, event_time),
        *([start_out_of_time(spark, lake, _given(within), trigger)] if event_time else []),
        start_clean(spark, lake, clean_sink, trigger),
        start_seats(spark, lake, seats_reference, seats_sink, seats_trigger, threshold, keep, changes_only=changes_only),
    ]


def drain(
    messages: DataFrame,
    lake: Lake,
    seats_reference: DataFrame,
    max_files: int | None = None,
    salts: int = 1,
    within: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    threshold: float = THRESHOLD,
    changes_only: bool = False,
    event_time: bool = False,
    partitions: int | None = None,
) -> None:
    """Bring all layers up to date with what the source holds now, then stop. See ``Trigger`` for ``partitions``."""
    spark = messages.sparkSession
    once = Trigger(available_now=True, max_files=max_files, partitions=partitions)
    start_bronze(messages, lake, once).awaitTermination()
    start_silver(spark, lake, once, salts, within, event_time).awaitTermination()
    if event_time:
        start_out_of_time(spark, lake, _given(within), once).awaitTermination()
    start_clean(spark, lake, None, once).awaitTermination()
    seats = start_seats(spark, lake, seats_reference, None, once, threshold, clock=clock, changes_only=changes_only)
    seats.awaitTermination()


def await_any(queries: list[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until one query ends, stop the others, and raise its failure if it failed."""
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(poll_seconds)
    finally:
        for query in queries:
            query.stop()
    failed = next((error for error in (query.exception() for query in queries) if error is not None), None)
    if failed is not None:
        raise failed
