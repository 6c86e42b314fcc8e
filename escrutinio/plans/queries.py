"""One query per operator, over the given tables."""

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.folders import folder_bytes
from escrutinio.functions.geo import parse_geo_point
from escrutinio.functions.keys import keyword, vote_doc_id
from escrutinio.functions.timestamps import parse_timestamp
from escrutinio.operators import geometry, reference, sampling, seats, votes
from escrutinio.operators.materialize import materialize
from escrutinio.operators.positions import weighted_ranges
from escrutinio.operators.upsert import upsert_latest
from escrutinio.plans import fixture
from escrutinio.schemas import PARTY_KEY, SEAT_DOCUMENT
from escrutinio.session import configure, scratch_dir
from escrutinio.sinks.buckets import BucketTable
from escrutinio.sinks.coordinates import write_coordinate_files, write_coordinates, write_named_files
from escrutinio.sinks.snapshots import write_snapshot
from escrutinio.sources import geo_files
from escrutinio.sources.messages import file_stream
from escrutinio.sources.tables import reference_from_files
from escrutinio.streaming import by_date, enrich, measures, replay
from escrutinio.streaming import lake as lakes

Query = Callable[[SparkSession, str], DataFrame]

CHUNK_SIZE = 100
TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
#: Bytes of raw messages that a state partition takes.
STATE_BYTES = 16 << 20
PUBLISHED_AT = datetime(2026, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)
VOTE_FIELDS = [
    "id",
    "blank_vote",
    "political_party",
    "province_name",
    "province_iso_code",
    "autonomic_region_name",
    "autonomic_region_iso_code",
    "location",
]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = configured
    return configured


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _time_text(name: str = "timestamp") -> Column:
    return F.date_format(name, TEXT_TIME).alias(name)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.raw_votes(spark, sf_dir).drop("o_orderkey")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.clean_votes(fixture.raw_messages(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.votes_per_party(votes.counted_votes(_raw(spark, sf_dir)))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.valid_votes(_counts(spark, sf_dir))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.join_seats(_valid(spark, sf_dir), fixture.seats_reference(spark, sf_dir))


def _reference(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    regions = reference.regions_model(fixture.comunidades(spark, sf_dir))
    return regions, reference.provinces_model(fixture.provincias(spark, sf_dir))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.build_coordinates(
        fixture.municipalities(spark, sf_dir),
        fixture.streets(spark, sf_dir),
        fixture.street_mapping(spark, sf_dir),
        _reference(spark, sf_dir)[1],
    )


# Votes


@query
def parse_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = votes.parse_votes(fixture.raw_messages(spark, sf_dir))
    return parsed.select(*VOTE_FIELDS, _time_text(), "raw")


@query
def dedup_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.dedup_votes(_raw(spark, sf_dir)).select(*VOTE_FIELDS, _time_text())


@query
def normalize_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.normalize_blank(_raw(spark, sf_dir)).select("id", "blank_vote", "political_party_norm")


@query
def clean_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir).select(*VOTE_FIELDS, _time_text(), "political_party_norm")


@query
def doc_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("id", vote_doc_id().alias("doc_id"))


@query
def votes_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_messages(_clean(spark, sf_dir))


@query
def votes_per_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


# Seats


@query
def province_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.province_totals(_counts(spark, sf_dir))


@query
def party_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.party_share(seats.province_totals(_counts(spark, sf_dir)))


@query
def threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir)


@query
def seats_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir)


@query
def dhondt_quotients(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotients = seats.dhondt_quotients(_joined(spark, sf_dir))
    return quotients.select(*PARTY_KEY, "votes_per_party", "total_seats", "divisor", "quotient")


@query
def seat_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = seats.seat_ranking(seats.dhondt_quotients(_joined(spark, sf_dir)))
    return ranked.select(*PARTY_KEY, "votes_per_party", "divisor", "quotient", "ranking")


@query
def dhondt_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.dhondt_winners(seats.seat_ranking(seats.dhondt_quotients(_joined(spark, sf_dir))))


@query
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.candidates(_valid(spark, sf_dir))


@query
def seats_with_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allocation step by step; the counts are used on both sides of its last join."""
    valid = seats.valid_votes(materialize(_counts(spark, sf_dir), "counts"))
    joined = seats.join_seats(valid, fixture.seats_reference(spark, sf_dir))
    winners = seats.dhondt_winners(seats.seat_ranking(seats.dhondt_quotients(joined)))
    return seats.seats_with_zero(seats.candidates(valid), winners)


@query
def dhondt_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.allocate_seats(_counts(spark, sf_dir), fixture.seats_reference(spark, sf_dir))


@query
def dhondt_seats_no_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.allocate_seats(_counts(spark, sf_dir), fixture.seats_reference(spark, sf_dir), threshold=0.0)


@query
def seats_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seats.seat_messages(dhondt_seats(spark, sf_dir), F.lit(PUBLISHED_AT))


# Serving


@query
def upsert_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the served table, their orders as changes; every fifth order deletes."""
    current = fixture.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        (F.col("c_custkey") % 100).alias("seats"),
        F.lit("1996-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )
    key = F.col("o_orderkey")
    changes = fixture.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"),
        F.when(key % 5 != 0, key).alias("seats"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )
    latest = upsert_latest(current, changes, "doc_id", ["updated_at"], "seats")
    return latest.select("doc_id", "seats", _time_text("updated_at"))


_QUERIES["upsert_latest"] = _QUERIES.pop("upsert_latest_query")


@query
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table kept in buckets: customers, then the orders up to a day, then those after it."""
    key = F.col("o_orderkey")
    changes = fixture.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("doc_id"),
        F.when(key % 5 != 0, key).alias("seats"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )
    first = fixture.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("doc_id"),
        (F.col("c_custkey") % 100).alias("seats"),
        F.lit("1996-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )
    served = BucketTable(spark, f"{scratch_dir(spark, 'buckets')}/served", changes.schema, ("doc_id",), buckets=16)
    before = F.col("updated_at") < F.lit("1997-06-01").cast("timestamp")
    for version, some in enumerate((first, changes.filter(before), changes.filter(~before))):
        served.upsert(some, ["updated_at"], "seats", version)
    return served.read().select("doc_id", "seats", _time_text("updated_at"))


@query
def served_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders looked up by key in a table of buckets: those of the customers of one nation."""
    orders = fixture.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    table = BucketTable(spark, f"{scratch_dir(spark, 'buckets')}/orders", orders.schema, ("o_custkey",), buckets=32)
    table.replace(orders, range(table.buckets), 0)
    nation = fixture.table(spark, sf_dir, "customer").filter("c_nationkey = 7")
    return table.lookup(nation.select(F.col("c_custkey").alias("o_custkey")))


@query
def upsert_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seats served without a threshold, then replaced by those with it: parties below it
    are deleted."""
    counts, reference_seats = materialize(_counts(spark, sf_dir), "counts"), fixture.seats_reference(spark, sf_dir)
    before = materialize(seats.allocate_seats(counts, reference_seats, threshold=0.0), "before")
    now = materialize(seats.allocate_seats(counts, reference_seats), "now")
    earlier = F.lit(datetime(2026, 1, 1, tzinfo=timezone.utc))
    later = F.lit(PUBLISHED_AT)
    served = lakes.seat_documents(seats.seat_messages(before, earlier), earlier).select(*SEAT_DOCUMENT.names)
    messages = seats.seat_messages(now, later).unionByName(seats.seat_tombstones(before, now))
    latest = upsert_latest(served, lakes.seat_documents(messages, later), "doc_id", ["updated_at"], "seats")
    return latest.withColumn("updated_at", _time_text("updated_at"))


@query
def geo_point_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = parse_geo_point(F.col("location"))
    return fixture.base_votes(spark, sf_dir).select("id", point.alias("p")).select("id", "p.lat", "p.lon")


@query
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spellings of the vote's time in turn, and text that is none of them."""
    key, at = F.col("o_orderkey"), F.col("timestamp")
    spelled = (
        F.when(key % 4 == 0, F.date_format(at, TEXT_TIME))
        .when(key % 4 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(key % 4 == 2, F.unix_millis(at).cast("string"))
        .otherwise("yesterday")
    )
    votes_at = fixture.base_votes(spark, sf_dir).select("id", spelled.alias("text"))
    return votes_at.withColumn("timestamp", parse_timestamp(F.col("text"))).select("id", "text", _time_text())


@query
def keyword_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.table(spark, sf_dir, "documents").select("doc_id", keyword(F.col("text")).alias("text_keyword"))


# Reference model


@query
def load_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference model from files, as exported from the relational source."""
    path = scratch_dir(spark, "reference")
    write_snapshot(fixture.comunidades(spark, sf_dir), f"{path}/regions")
    write_snapshot(fixture.provincias(spark, sf_dir), f"{path}/provinces")
    return reference.provinces_with_region(*reference_from_files(spark, f"{path}/regions", f"{path}/provinces"))


@query
def seats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seats reference beside the votes of each of its provinces, none among them."""
    counted = votes.counted_votes(_raw(spark, sf_dir)).groupBy("province_name").agg(F.count("*").alias("votes"))
    found = fixture.seats_reference(spark, sf_dir).join(counted, "province_name", "left")
    return found.select("province_name", "total_seats", F.coalesce("votes", F.lit(0)).cast("bigint").alias("votes"))


@query
def seats_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.seats_by_province(*_reference(spark, sf_dir))


@query
def region_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.region_seats(*_reference(spark, sf_dir))


@query
def region_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.transform("provinces", lambda p: F.concat_ws(":", p["id"], p["province_name"], p["total_seats"]))
    return reference.region_tree(*_reference(spark, sf_dir)).select(
        "region_code", "region_name", "total_seats", "chunk", F.array_join(entry, ";").alias("provinces")
    )


@query
def region_tree_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree with lists of two provinces at most."""
    tree = reference.region_tree(*_reference(spark, sf_dir), chunk_size=2)
    return tree.select("region_code", "chunk", F.array_join(F.transform("provinces", lambda p: p["id"]), ";").alias("ids"))


@query
def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = reference.province_lookup_table(*_reference(spark, sf_dir))
    found = reference.province_lookup(fixture.base_votes(spark, sf_dir).select("id", "province_name"), lookup)
    return found.select("id", "province_name", "autonomic_region_name", "autonomic_region_iso_code")


@query
def population_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, provinces = _reference(spark, sf_dir)
    return reference.population_weights(provinces).select("province_name", "population", "weight")


@query
def weight_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, provinces = _reference(spark, sf_dir)
    return reference.weight_expansion(reference.population_weights(provinces)).select("province_name", "slot")


@query
def party_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parties on the ballot with the share of the orders that draw each."""
    parties = reference.political_parties(spark)
    ids = fixture.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    drawn = (
        sampling.weighted_draw(ids, "id", parties, "name", "popularity", "party")
        .groupBy(F.col("party").alias("name"))
        .agg(F.count("*").alias("drawn"))
    )
    return parties.join(drawn, "name", "left").select(
        "name", "popularity", F.coalesce("drawn", F.lit(0)).cast("bigint").alias("drawn")
    )


# Coordinates


@query
def geometry_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities, streets and their mapping through their file readers."""
    path = scratch_dir(spark, "geometries")
    fixture.municipality_records(spark, sf_dir).write.text(f"{path}/municipalities")
    write_named_files(fixture.street_records(spark, sf_dir), f"{path}/streets", "value")
    pairs = F.collect_list(F.struct("prov_name", "file_name"))
    mapping = fixture.street_mapping(spark, sf_dir).agg(F.to_json(F.map_from_entries(pairs)).alias("value"))
    mapping.write.text(f"{path}/mapping")
    return geometry.build_coordinates(
        geo_files.municipalities(spark, f"{path}/municipalities", lines=True),
        geo_files.streets(spark, f"{path}/streets", lines=True),
        geo_files.street_mapping(spark, f"{path}/mapping"),
    )


@query
def geometry_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities out of one file that is one JSON array, which many tasks read."""
    path = scratch_dir(spark, "array")
    records = fixture.municipality_records(spark, sf_dir, "c_custkey AS k")
    first = records.agg(F.min("k")).scalar()
    ends = spark.createDataFrame([(-1, "["), (1 << 62, "]")], "k bigint, value string")
    lines = records.select("k", F.when(F.col("k") == first, F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value"))
    write_named_files(lines.unionByName(ends).withColumn("name", F.lit("array.json")), path, "k")
    return geometry.build_coordinates(geo_files.municipalities(spark, f"{path}/array.json", split=True))


@query
def coordinates_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = geometry.coordinate_chunks(_points(spark, sf_dir), CHUNK_SIZE)
    return chunks.select(
        "prov_code",
        "chunk",
        F.size("coordinates").cast("bigint").alias("n"),
        F.array_join("coordinates", ";").alias("coordinates"),
    )


@query
def coordinates_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates written as one file per province and read by the names of the files."""
    path = scratch_dir(spark, "coordinates")
    write_coordinate_files(_points(spark, sf_dir), path, CHUNK_SIZE)
    return geo_files.coordinate_files(spark, path)


@query
def coordinates_load_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the form for provinces of any size."""
    path = scratch_dir(spark, "coordinates")
    write_coordinates(_points(spark, sf_dir), path, CHUNK_SIZE)
    return geo_files.coordinate_folders(spark, path)


@query
def coordinate_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = "lpad(regexp_extract(province_iso_code, '[0-9]+$', 0), 2, '0') AS prov_code"
    ids = fixture.base_votes(spark, sf_dir).selectExpr("id", code)
    return sampling.coordinate_pick(ids, "id", _points(spark, sf_dir), strict=False)


@query
def weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A brand by its parts and a province by its population for each order."""
    brands = fixture.table(spark, sf_dir, "part").select("p_brand", F.lit(1).alias("parts"))
    _, provinces = _reference(spark, sf_dir)
    ids = fixture.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    drawn = sampling.weighted_draw(ids, "id", brands, "p_brand", "parts", "party")
    return sampling.weighted_draw(
        drawn, "id", reference.population_weights(provinces), "province_name", "weight", "province"
    )


@query
def bernoulli_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = fixture.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return sampling.bernoulli_flag(ids, "id", "blank_vote")


@query
def weighted_draw_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of each brand under weights from 1e-10 to 5e9; parts without a brand drop out."""
    key = F.col("p_partkey")
    weight = F.when(key % 3 == 0, F.lit(1e-10)).when(key % 3 == 1, F.lit(5e9)).otherwise(F.lit(0.25))
    brand = F.when(key % 7 != 0, F.col("p_brand"))
    parts = fixture.table(spark, sf_dir, "part").select(brand.alias("brand"), weight.alias("weight"))
    ranges = weighted_ranges(parts, [], "brand", F.col("weight"))
    text = [F.col(name).cast("decimal(37,10)").cast("string").alias(name) for name in ("lo", "hi", "total")]
    return ranges.select("brand", *text, "items")


@query
def coordinate_pick_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates drawn where every third point of a province has none; the strict form raises for none."""
    votes_at = fixture.base_votes(spark, sf_dir)
    point = F.when(F.col("o_orderkey") % 3 != 0, F.col("location"))
    points = votes_at.select(F.col("province_iso_code").alias("prov_code"), point.alias("coordinate"))
    ids = votes_at.select("id", F.col("province_iso_code").alias("prov_code"))
    return sampling.coordinate_pick(ids, "id", points)


@query
def dedup_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies with other parties, of which the first has no time: the dated one wins."""
    base = fixture.base_votes(spark, sf_dir).drop("o_orderkey")
    undated = base.withColumns({"timestamp": F.lit(None).cast("timestamp"), "political_party": F.lit("A")})
    later = base.filter("id % 2 = 0").withColumns(
        {"timestamp": F.col("timestamp") + F.expr("interval 1 second"), "political_party": F.lit("B")}
    )
    only = base.filter("id % 5 = 0").withColumns({"id": F.concat(F.lit("x"), "id"), "timestamp": F.lit(None).cast("timestamp")})
    copies = undated.unionByName(later).unionByName(base).unionByName(only)
    return votes.dedup_votes(copies).select(*VOTE_FIELDS, _time_text())


# Streams


def _stream(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, lakes.Lake, lakes.Trigger]:
    """The raw messages as files that a stream reads, and an empty lake."""
    base = scratch_dir(spark, name)
    fixture.raw_messages(spark, sf_dir).write.text(f"{base}/source")
    lake = lakes.Lake(f"{base}/lake", f"{base}/checkpoints")
    return file_stream(spark, f"{base}/source"), lake, lakes.Trigger(available_now=True)


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, lake, once = _stream(spark, sf_dir, "bronze")
    lakes.start_bronze(messages, lake, once).awaitTermination()
    return spark.read.parquet(lake.bronze).select(*VOTE_FIELDS, _time_text(), "raw")


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, lake, once = _stream(spark, sf_dir, "silver")
    lakes.start_bronze(messages, lake, once).awaitTermination()
    lakes.start_silver(spark, lake, once).awaitTermination()
    return spark.read.parquet(lake.silver).select(*VOTE_FIELDS, _time_text(), "political_party_norm")


@query
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, lake, once = _stream(spark, sf_dir, "clean")
    lakes.start_bronze(messages, lake, once).awaitTermination()
    lakes.start_silver(spark, lake, once).awaitTermination()
    lakes.start_clean(spark, lake, None, once).awaitTermination()
    return spark.read.parquet(lake.clean)


@query
def stream_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, lake, _ = _stream(spark, sf_dir, "seats")
    # The reference is read by the callback on every micro-batch: a written table.
    path = f"{lake.base}/seats_reference"
    write_snapshot(fixture.seats_reference(spark, sf_dir), path)
    lakes.drain(messages, lake, spark.read.parquet(path), clock=lambda: PUBLISHED_AT)
    return lakes.current_seats(spark, lake)


@query
def stream_seats_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seats kept by changed provinces only, over micro-batches of a few files each."""
    messages, lake, reference_seats = _split_stream(spark, sf_dir, "changes")
    _drain_changes(messages, lake, reference_seats)
    return lakes.current_seats(spark, lake, changes_only=True)


@query
def stream_served_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that these seats are served from."""
    messages, lake, reference_seats = _split_stream(spark, sf_dir, "served-changes")
    _drain_changes(messages, lake, reference_seats)
    return lakes.served_seats(spark, lake, changes_only=True).withColumn("updated_at", _time_text("updated_at"))


def _drain_changes(messages: DataFrame, lake: lakes.Lake, reference_seats: DataFrame) -> None:
    partitions = _state_partitions(messages.sparkSession, lake.base.rpartition("/")[0] + "/source")
    lakes.drain(
        messages, lake, reference_seats, max_files=8, clock=lambda: PUBLISHED_AT, changes_only=True, partitions=partitions
    )


def _state_partitions(spark: SparkSession, source: str) -> int:
    """State partitions for a source: one for each ``STATE_BYTES`` and for each core at least, the session's at most."""
    wanted = max(_files_at_once(spark), -(-folder_bytes(spark, source) // STATE_BYTES))
    return min(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _files_at_once(spark: SparkSession) -> int:
    """Files of a micro-batch of a source that has three: one for each core, so that all of them write and read."""
    return max(1, spark.sparkContext.defaultParallelism)


def _split_stream(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, lakes.Lake, DataFrame]:
    """The raw messages in files that give three micro-batches, an empty lake and the seats reference."""
    base, files = scratch_dir(spark, name), _files_at_once(spark)
    fixture.raw_messages(spark, sf_dir).repartition(3 * files).write.text(f"{base}/source")
    path = f"{base}/seats_reference"
    write_snapshot(fixture.seats_reference(spark, sf_dir), path)
    lake = lakes.Lake(f"{base}/lake", f"{base}/checkpoints")
    return file_stream(spark, f"{base}/source", files), lake, spark.read.parquet(path)


@query
def stream_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All queries of the lake at once, the seats every second and the others as soon as they can,
    until they have caught up; the seats see micro-batches without votes too."""
    messages, lake, reference_seats = _split_stream(spark, sf_dir, "together")
    every = lakes.Trigger(interval="1 second")
    running = lakes.run_lake(messages, lake, reference_seats, seats_trigger=every)
    try:
        for one in running:  # each layer after the one that it reads
            one.processAllAvailable()
    finally:
        for one in running:
            one.stop()
    lakes.await_any(running)
    return lakes.current_seats(spark, lake)


def _by_date(spark: SparkSession, sf_dir: str, name: str) -> lakes.Lake:
    """A lake by event date, its bronze and silver filled by three micro-batches."""
    messages, lake, _ = _split_stream(spark, sf_dir, name)
    lake, once = replace(lake, by_date="year"), lakes.Trigger(available_now=True)
    lakes.start_bronze(messages, lake, once).awaitTermination()
    lakes.start_silver(spark, lake, once).awaitTermination()
    return lake


@query
def stream_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of some years out of a lake by date, of which two runs have compacted the older dates."""
    lake = _by_date(spark, sf_dir, "dates")
    for day in (date(1994, 1, 1), date(1996, 7, 1)):
        by_date.compact(spark, lake, day)
    found = by_date.silver(spark, lake, date(1993, 6, 1), date(1997, 3, 1))
    return found.select(*VOTE_FIELDS, _time_text(), "political_party_norm", F.year("date").cast("bigint").alias("year"))


@query
def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes joined in the stream with a dimension whose second version comes between two runs.

    The votes of even ids are there first, when half of the provinces are not known yet.
    """
    base = scratch_dir(spark, "enriched")
    lake, once = lakes.Lake(f"{base}/lake", f"{base}/checkpoints"), lakes.Trigger(available_now=True)
    lookup = reference.province_lookup_table(*_reference(spark, sf_dir))
    half = lookup.filter(F.regexp_extract("province_name", "[0-9]+$", 0).cast("int") % 2 == 0)
    raw = votes.clean_votes(fixture.raw_messages(spark, sf_dir))
    for even, dimension in ((True, half), (False, lookup)):
        some = raw.filter((F.col("id").cast("bigint") % 2 == 0) == F.lit(even))
        some.write.mode("append").parquet(lake.silver)
        enrich.publish_provinces(dimension, lake)
        enrich.start_enriched(spark, lake, once).awaitTermination()
    found = spark.read.parquet(lake.enriched)
    return found.select("id", "province_name", "autonomic_region_name", "autonomic_region_iso_code")


@query
def stream_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the queries counted on their way over three micro-batches: a row per layer and measure."""
    messages, lake, _ = _split_stream(spark, sf_dir, "measures")
    once, found = lakes.Trigger(available_now=True), measures.measured(spark)
    try:
        lakes.start_bronze(messages, lake, once).awaitTermination()
        lakes.start_silver(spark, lake, once, within="30000 days", event_time=True).awaitTermination()
        lakes.start_out_of_time(spark, lake, "30000 days", once).awaitTermination()
        found.wait()
    finally:
        spark.streams.removeListener(found)
    rows = [(layer, name, n) for layer, counts in found.totals.items() for name, n in counts.items()]
    return spark.createDataFrame(rows, "layer string, measure string, n bigint")


@query
def stream_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seats rebuilt in batch from bronze, beside how many rows of silver, messages and seats differ from the stream's."""
    messages, lake, reference_seats = _split_stream(spark, sf_dir, "rebuilt")
    lakes.drain(messages, lake, reference_seats, clock=lambda: PUBLISHED_AT)
    replay.rebuild(spark, lake, reference_seats)
    streamed = {"silver": spark.read.parquet(lake.silver), "clean": spark.read.parquet(lake.clean), "seats": lakes.current_seats(spark, lake)}
    counts = [replay.differences(df, replay.rebuilt(spark, lake, name)).agg(F.count("*").alias(f"other_{name}")) for name, df in streamed.items()]
    found = replay.rebuilt(spark, lake, "seats")
    for count in counts:  # a row each
        found = found.withColumn(count.columns[0], count.scalar())
    return found


@query
def stream_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes that arrive 0 to 4 days after their time, some ahead of it and some without one, where
    three days are allowed: kept once, or out of time with each copy and the reason."""
    base = scratch_dir(spark, "event-time")
    number = F.get_json_object("value", "$.id").cast("bigint")
    undated = F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":null')
    at = F.to_timestamp(F.get_json_object("value", "$.timestamp"))
    arrived = F.when(number % 19 == 0, at - F.expr("interval 5 days")).otherwise(
        at + F.make_dt_interval(days=(number % 5).cast("int"))
    )
    messages = fixture.raw_messages(spark, sf_dir).select(
        F.when(number % 23 == 0, undated).otherwise(F.col("value")).alias("value"), arrived.alias("arrived")
    )
    files = _files_at_once(spark)
    messages.repartition(3 * files).write.parquet(f"{base}/source")
    source = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/source")
    lake, once = lakes.Lake(f"{base}/lake", f"{base}/checkpoints"), lakes.Trigger(available_now=True, max_files=1)
    lakes.start_bronze(source, lake, once).awaitTermination()
    lakes.start_silver(spark, lake, once, within="3 days", event_time=True).awaitTermination()
    lakes.start_out_of_time(spark, lake, "3 days", once).awaitTermination()
    kept = spark.read.parquet(lake.silver).select("id", F.lit("kept").alias("reason"))
    return kept.unionByName(spark.read.parquet(lake.out_of_time).select("id", "reason"))


@query
def stream_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, lake, _ = _stream(spark, sf_dir, "served")
    path = f"{lake.base}/seats_reference"
    write_snapshot(fixture.seats_reference(spark, sf_dir), path)
    lakes.drain(messages, lake, spark.read.parquet(path), clock=lambda: PUBLISHED_AT)
    return lakes.served_seats(spark, lake).withColumn("updated_at", _time_text("updated_at"))
