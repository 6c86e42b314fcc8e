"""Streams give what the batch functions give, whatever the micro-batches."""

import json
from datetime import datetime, timezone

import pytest

from escrutinio.operators import seats as S
from escrutinio.operators import votes as V
from escrutinio.plans import queries
from escrutinio.schemas import SILVER_COLUMNS
from escrutinio.sinks.messages import FileSink
from escrutinio.sinks.versions import versions
from escrutinio.sources.messages import file_stream, file_table
from escrutinio.streaming import lake as L

AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def vote(i, party=None):
    blank = i % 10 == 0
    return json.dumps(
        {
            "id": f"v{i}",
            "blank_vote": blank,
            "political_party": None if blank else party or f"party{i % 4}",
            "province_name": "P" if i % 3 else "Q",
            "province_iso_code": "ES-P",
            "autonomic_region_name": "R",
            "autonomic_region_iso_code": "ES-R",
            "location": "40.1,-3.2",
            "timestamp": f"2026-01-01T00:{i // 60 % 60:02d}:{i % 60:02d}.123456",
        }
    )


class Source:
    """Text files in the order they are added."""

    def __init__(self, folder):
        folder.mkdir()
        self.folder = folder
        self.count = 0

    def add(self, *lines):
        staged = self.folder.parent / f"staged{self.count}"
        staged.write_text("\n".join(lines) + "\n")
        staged.rename(self.folder / f"part{self.count:03d}.txt")
        self.count += 1


@pytest.fixture
def source(tmp_path):
    return Source(tmp_path / "source")


@pytest.fixture
def lake(tmp_path):
    return L.Lake(str(tmp_path / "lake"), str(tmp_path / "checkpoints"))


@pytest.fixture
def reference(spark):
    return spark.createDataFrame([("P", 5), ("Q", 4)], "province_name string, total_seats bigint")


def drain(spark, source, lake, reference, **options):
    L.drain(file_stream(spark, str(source.folder), 1), lake, reference, clock=lambda: AT, **options)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch_seats(spark, source, reference):
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    return S.allocate_seats(V.votes_per_party(clean), reference)


def test_stream_equals_batch_and_restarts(spark, source, lake, reference):
    source.add(*(vote(i) for i in range(40)))
    source.add(*(vote(i) for i in range(30, 80)), "not json", *(vote(5) for _ in range(30)))
    drain(spark, source, lake, reference)
    assert rows(L.current_seats(spark, lake)) == rows(batch_seats(spark, source, reference))
    first = versions(spark, lake.seats)

    # A new run from the checkpoints: duplicates of earlier batches stay out.
    source.add(*(vote(i) for i in range(70, 120)), '{"blank_vote":true}')
    drain(spark, source, lake, reference)
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    silver = spark.read.parquet(lake.silver)
    assert silver.columns == [*SILVER_COLUMNS, "political_party_norm"]
    assert rows(silver) == rows(clean)
    assert rows(spark.read.parquet(lake.clean)) == rows(V.vote_messages(clean))
    assert rows(L.current_seats(spark, lake)) == rows(batch_seats(spark, source, reference))
    assert versions(spark, lake.seats)[-1] > first[-1]
    assert rows(L.rejected_votes(spark, lake)) == [("not json",), ('{"blank_vote":true}',)]

    # Nothing new: nothing changes.
    before = versions(spark, lake.seats)
    drain(spark, source, lake, reference)
    assert versions(spark, lake.seats) == before


def test_a_repeated_micro_batch_replaces_its_output(spark, source, lake, reference, tmp_path):
    counts = spark.createDataFrame(
        [("R", "P", "A", 10), ("R", "P", "B", 6)],
        "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint",
    )
    publish = L.seat_publisher(lake, reference, FileSink(lake.seat_messages), clock=lambda: AT)
    for _ in range(2):
        publish(counts, 0)
    assert rows(L.current_seats(spark, lake)) == [("R", "P", "A", 3), ("R", "P", "B", 2)]
    assert spark.read.parquet(lake.seat_messages).count() == 2
    assert {r["doc_id"]: r["seats"] for r in L.served_seats(spark, lake).collect()} == {"P_A": 3, "P_B": 2}


def test_a_party_below_the_threshold_is_deleted(spark, lake, reference):
    schema = "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint"
    publish = L.seat_publisher(lake, reference, FileSink(lake.seat_messages), keep=1, clock=lambda: AT)
    publish(spark.createDataFrame([("R", "P", "A", 10), ("R", "P", "B", 6)], schema), 0)
    publish(spark.createDataFrame([("R", "P", "A", 1000), ("R", "P", "B", 6)], schema), 1)
    sent = spark.read.parquet(f"{lake.seat_messages}/batch_id=1").collect()
    assert {r["key"]: r["value"] is None for r in sent} == {"P_A": False, "P_B": True}
    assert [r["doc_id"] for r in L.served_seats(spark, lake).collect()] == ["P_A"]
    assert versions(spark, lake.seats) == [1]


def test_an_empty_micro_batch_is_skipped(spark, lake, reference):
    empty = spark.createDataFrame(
        [],
        "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint",
    )
    L.seat_publisher(lake, reference, FileSink(lake.seat_messages))(empty, 0)
    assert versions(spark, lake.seats) == []


@pytest.mark.parametrize("options", [{"salts": 1}, {"within": "2 hours"}, {"salts": 1, "within": "2 hours"}])
def test_dedup_options(spark, source, lake, options):
    source.add(*(vote(i) for i in range(50)))
    source.add(*(vote(i) for i in range(40, 60)), *(vote(3) for _ in range(20)))
    once = L.Trigger(available_now=True, max_files=1)
    L.start_bronze(file_stream(spark, str(source.folder), 1), lake, once).awaitTermination()
    L.start_silver(spark, lake, once, **options).awaitTermination()
    ids = [r["id"] for r in spark.read.parquet(lake.silver).collect()]
    assert sorted(ids) == sorted(f"v{i}" for i in range(60))


def test_no_vote_is_too_late(spark, source, lake):
    """Bounded state: votes of long ago, or without a time, still count once."""
    old = vote(1).replace("2026-01-01", "1999-01-01")
    source.add(*(vote(i) for i in range(10, 20)))
    source.add(old, old, vote(2).replace('"2026-01-01T00:00:02.123456"', "null"), vote(12))
    for _ in range(2):
        once = L.Trigger(available_now=True, max_files=1)
        L.start_bronze(file_stream(spark, str(source.folder), 1), lake, once).awaitTermination()
        L.start_silver(spark, lake, once, within="1 hour").awaitTermination()
        source.add(old, vote(3).replace("2026-01-01", "1998-01-01"))
    ids = [r["id"] for r in spark.read.parquet(lake.silver).collect()]
    assert sorted(ids) == sorted(["v1", "v2", "v3", *(f"v{i}" for i in range(10, 20))])


def test_all_queries_run_together(spark, source, lake, reference):
    source.add(*(vote(i) for i in range(60)))
    queries = L.run_lake(
        file_stream(spark, str(source.folder)), lake, reference, seats_trigger=L.Trigger(interval="1 second")
    )
    try:
        for query in queries:
            query.processAllAvailable()
        source.add(*(vote(i) for i in range(50, 90)))
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert rows(L.current_seats(spark, lake)) == rows(batch_seats(spark, source, reference))
    L.await_any(queries)  # all stopped: returns at once


def test_a_failing_query_stops_the_others(spark, source, lake, reference):
    source.add(*(vote(i) for i in range(20)))

    class Broken(FileSink):
        def write(self, messages, batch_id):
            raise RuntimeError("sink is down")

    queries = L.run_lake(
        file_stream(spark, str(source.folder)),
        lake,
        reference,
        seats_sink=Broken(lake.seat_messages),
        seats_trigger=L.Trigger(interval="1 second"),
    )
    with pytest.raises(Exception, match="sink is down"):
        L.await_any(queries)
    assert not any(query.isActive for query in queries)


def test_served_seats_follow_the_batches_and_not_the_clock(spark, lake, tmp_path):
    """The clock steps back; provinces of two regions and names with the key's separator stay apart."""
    reference = spark.createDataFrame([("P", 5), ("P_A", 3)], "province_name string, total_seats bigint")
    clock = iter([AT, AT.replace(year=AT.year - 1)])
    publish = L.seat_publisher(lake, reference, FileSink(lake.seat_messages), clock=lambda: next(clock))
    schema = "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint"
    first = [("R", "P", "A_B", 60), ("S", "P", "A_B", 40), ("R", "P_A", "B", 50), (None, "P_A", "B", 50), ("R", "P", "C", 30)]
    publish(spark.createDataFrame(first, schema), 0)
    publish(spark.createDataFrame([(*r[:3], 1 if r[2] == "C" else r[3] + 20) for r in first], schema), 1)
    gold = {tuple(r) for r in L.current_seats(spark, lake).collect()}
    served = {
        (r.autonomic_region_name, r.province_name, r.political_party, r.seats) for r in L.served_seats(spark, lake).collect()
    }
    assert served == gold and len(served) == 4


def test_state_partitions_follow_the_source_and_not_the_session(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, purpose: f"file://{tmp_path}/{purpose}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = queries.stream_served_changes(spark, "/root/testdata/sf0.001").count()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert found
        for layer in ("silver", "seat_changes"):
            stores = [x for x in (tmp_path / "served-changes/checkpoints" / layer / "state/0").iterdir() if x.name.isdigit()]
            assert len(stores) == 8
        for size, wanted in ((1 << 40, 8), (1000, 40)):  # as many as its cores, the session's at most
            monkeypatch.setattr(queries, "STATE_BYTES", size)
            assert queries._state_partitions(spark, f"file://{tmp_path}/served-changes/source") == wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
