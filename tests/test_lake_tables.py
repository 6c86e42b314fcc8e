"""A lake by date with compaction, votes joined with a changing dimension, measures, pools, rebuilds."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_stream import AT, Source, lake, reference, rows, source, vote  # noqa: F401

from escrutinio.functions.keys import seat_key  # noqa: F401
from escrutinio.operators import votes as V
from escrutinio.schemas import PROVINCE_LOOKUP
from escrutinio.sinks import versions as versions_module
from escrutinio.sinks.versions import versions
from escrutinio.sources.messages import file_stream, file_table
from escrutinio.streaming import by_date, enrich, measures, replay
from escrutinio.streaming import lake as L

ONCE = L.Trigger(available_now=True, max_files=1)


def on(i, day):
    return vote(i).replace("2026-01-01", day)


def silver(spark, source, lake, **options):  # noqa: F811
    L.start_bronze(file_stream(spark, str(source.folder), 1), lake, ONCE).awaitTermination()
    L.start_silver(spark, lake, ONCE, **options).awaitTermination()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    return len(df.inputFiles())


@pytest.mark.parametrize("period", ["day", "month"])
def test_votes_by_date_before_and_after_compaction(spark, source, lake, period, monkeypatch):  # noqa: F811
    lake = replace(lake, by_date=period)  # noqa: F811
    days = ["2026-01-01", "2026-01-31", "2026-02-01", "2026-02-15", "2026-03-02"]
    for k in range(3):
        source.add(*(on(i, days[i % 5]) for i in range(k * 20, k * 20 + 25)))
    source.add(on(100, "2026-01-01").replace('"2026-01-01T00:01:40.123456"', "null"))
    silver(spark, source, lake)
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    live = by_date.silver(spark, lake)
    assert rows(live.drop("date")) == rows(clean)

    since, until = date(2026, 1, 31), date(2026, 2, 15)
    asked = by_date.silver(spark, lake, since, until)
    assert "PartitionFilters: [isnotnull(date" in plan(asked) and files_read(asked) <= files_read(live)
    wanted = rows(clean.filter((F.to_date("timestamp") >= F.lit(since)) & (F.to_date("timestamp") < F.lit(until))))
    assert rows(asked.drop("date")) == wanted

    # A run that fails half-way is not seen.
    with monkeypatch.context() as patched:
        patched.setattr(versions_module, "make_file", lambda *_: (_ for _ in ()).throw(OSError("the driver is lost")))
        with pytest.raises(OSError, match="driver is lost"):
            by_date.compact(spark, lake, date(2026, 2, 1))
    assert by_date.compacted_before(spark, lake) is None and rows(by_date.silver(spark, lake).drop("date")) == rows(clean)

    before = files_read(live.filter(F.col("date") < F.lit(date(2026, 3, 1))))
    by_date.compact(spark, lake, date(2026, 2, 1))
    by_date.compact(spark, lake, date(2026, 3, 1))
    by_date.compact(spark, lake, date(2026, 2, 10))  # nothing left to do
    assert by_date.compacted_before(spark, lake) == date(2026, 3, 1) and len(versions(spark, lake.compacted)) == 2
    assert rows(by_date.silver(spark, lake).drop("date")) == rows(clean)
    assert rows(by_date.silver(spark, lake, since, until).drop("date")) == wanted
    compacted = [f for f in by_date.silver(spark, lake).inputFiles() if "compacted" in f]
    assert 0 < len(compacted) < before

    # Votes that come later go on from there.
    source.add(*(on(i, "2026-03-03") for i in range(200, 210)), *(on(i, days[i % 5]) for i in range(10)))
    silver(spark, source, lake)
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    assert rows(by_date.silver(spark, lake).drop("date")) == rows(clean)


def test_a_lake_by_date_gives_the_same_seats(spark, source, lake, reference):  # noqa: F811
    from escrutinio.operators import seats as S

    dated = replace(lake, by_date="day")
    source.add(*(on(i, f"2026-01-{1 + i % 3:02d}") for i in range(60)), "not json")
    L.drain(file_stream(spark, str(source.folder), 1), dated, reference, clock=lambda: AT)
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    assert rows(L.current_seats(spark, dated)) == rows(S.allocate_seats(V.votes_per_party(clean), reference))
    assert rows(L.rejected_votes(spark, dated)) == [("not json",)]


def test_a_changed_dimension_takes_effect_in_a_running_query(spark, source, lake):  # noqa: F811
    first = spark.createDataFrame([("P", "R1", "ES-1")], PROVINCE_LOOKUP)
    second = spark.createDataFrame([("P", "R2", "ES-2"), ("Q", "R3", "ES-3")], PROVINCE_LOOKUP)
    source.add(*(vote(i) for i in range(20)))
    silver(spark, source, lake)
    early = spark.read.parquet(lake.silver).select("id").collect()
    enrich.publish_provinces(first, lake)
    query = enrich.start_enriched(spark, lake, L.Trigger(interval="1 second"))
    try:
        query.processAllAvailable()
        enrich.publish_provinces(second, lake)
        source.add(*(vote(i) for i in range(20, 40)))
        silver(spark, source, lake)
        query.processAllAvailable()
    finally:
        query.stop()
    found = spark.read.parquet(lake.enriched).drop("batch_id")
    ids = [r["id"] for r in early]
    stored = spark.read.parquet(lake.silver)
    batch = enrich.enriched(stored.filter(F.col("id").isin(ids)), first).unionByName(
        enrich.enriched(stored.filter(~F.col("id").isin(ids)), second)
    )
    assert rows(found.select(batch.columns)) == rows(batch) and found.count() == 40


def test_without_a_dimension_regions_are_unknown(spark, source, lake):  # noqa: F811
    source.add(*(vote(i) for i in range(5)))
    silver(spark, source, lake)
    enrich.start_enriched(spark, lake, ONCE).awaitTermination()
    assert {r["autonomic_region_name"] for r in spark.read.parquet(lake.enriched).collect()} == {None}


def test_measures_equal_the_tables(spark, source, lake):  # noqa: F811
    source.add(*(vote(i) for i in range(30)), "not json", vote(1).replace("2026-01-01", "2999-01-01"))
    source.add(*(vote(i) for i in range(20, 50)), '{"blank_vote":true}')
    found = measures.measured(spark)
    try:
        for _ in range(2):  # the second run has nothing new
            silver(spark, source, lake, within="40000 days", event_time=True)
            L.start_out_of_time(spark, lake, "40000 days", ONCE).awaitTermination()
        found.wait()
    finally:
        spark.streams.removeListener(found)
    totals = found.totals
    bronze, kept = spark.read.parquet(lake.bronze), spark.read.parquet(lake.silver).count()
    late = spark.read.parquet(lake.out_of_time).count()
    assert totals["bronze"] == {"read": bronze.count(), "rejected": bronze.filter("id IS NULL").count()} == {"read": 63, "rejected": 2}
    assert totals["silver"]["kept"] == kept == 50 and totals["out_of_time"]["early"] == late == 1
    copies = totals["votes"]["read"] - kept - late
    assert copies == 63 - 2 - 50 - 1


def test_each_query_runs_in_a_pool_of_its_name(spark, source, lake):  # noqa: F811
    pools = []

    def note(batch, batch_id):
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))

    source.add(vote(1))
    writer = file_stream(spark, str(source.folder)).writeStream.foreachBatch(note)
    query = ONCE.start(writer, lake.checkpoint("seats"))
    query.awaitTermination()
    assert pools == ["seats"] and query.name.startswith("seats-")
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_rebuild_equals_the_stream_and_shows_what_differs(spark, source, lake, reference):  # noqa: F811
    source.add(*(vote(i) for i in range(40)))
    source.add(*(vote(i) for i in range(30, 60)), "not json")
    assert rows(replay.rebuilt(spark, lake, "seats")) == []
    L.drain(file_stream(spark, str(source.folder), 1), lake, reference, clock=lambda: AT)
    assert replay.rebuild(spark, lake, reference) == 0
    streamed = {"silver": spark.read.parquet(lake.silver), "clean": spark.read.parquet(lake.clean), "seats": L.current_seats(spark, lake)}
    for name, table in streamed.items():
        assert replay.differences(table, replay.rebuilt(spark, lake, name)).isEmpty()
    doubled = streamed["seats"].unionByName(streamed["seats"].limit(1))
    assert [r["extra"] for r in replay.differences(doubled, replay.rebuilt(spark, lake, "seats")).collect()] == [1]
    less = streamed["seats"].filter("province_name = 'P'")
    assert {r["extra"] for r in replay.differences(less, replay.rebuilt(spark, lake, "seats")).collect()} == {-1}


def test_an_unfinished_rebuild_is_not_seen(spark, source, lake, reference, monkeypatch):  # noqa: F811
    source.add(*(vote(i) for i in range(30)))
    L.drain(file_stream(spark, str(source.folder), 1), lake, reference, clock=lambda: AT)
    replay.rebuild(spark, lake, reference)
    before = {name: rows(replay.rebuilt(spark, lake, name)) for name in replay.TABLES}
    source.add(*(vote(i) for i in range(30, 50)))
    L.drain(file_stream(spark, str(source.folder), 1), lake, reference, clock=lambda: AT)
    with monkeypatch.context() as patched:
        patched.setattr(replay, "allocate_seats", lambda *_: (_ for _ in ()).throw(OSError("the driver is lost")))
        with pytest.raises(OSError, match="driver is lost"):
            replay.rebuild(spark, lake, reference)
    assert {name: rows(replay.rebuilt(spark, lake, name)) for name in replay.TABLES} == before
    assert replay.rebuild(spark, lake, reference) == 1
    assert len(rows(replay.rebuilt(spark, lake, "silver"))) == 50
