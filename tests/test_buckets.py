"""Tables in buckets: what a change rewrites, failures in between, lookups, and seats kept by changes."""

import pytest
from pyspark.sql import functions as F
from test_stream import AT, Source, lake, reference, rows, source, vote  # noqa: F401

from escrutinio.operators import seats as S
from escrutinio.operators import votes as V
from escrutinio.operators.upsert import upsert_latest
from escrutinio.sinks import buckets as B
from escrutinio.sinks.messages import FileSink
from escrutinio.sources.messages import file_stream, file_table
from escrutinio.streaming import lake as L

SCHEMA = "k string, n bigint, v bigint"


def table(spark, path, buckets=8):
    return B.BucketTable(spark, str(path / "t"), spark.createDataFrame([], SCHEMA).schema, ("k",), buckets)


def changes(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def files(path):
    return {str(p.relative_to(path)) for p in (path / "t").rglob("part-*.parquet")}


def test_upserts_equal_one_of_all_and_leave_other_files(spark, tmp_path):
    served = table(spark, tmp_path)
    first = changes(spark, *((f"k{i}", 0, i) for i in range(50)), (None, 0, 7))
    served.upsert(first, ["n"], "v", 0)
    before = files(tmp_path)
    second = changes(spark, ("k3", 1, 33), ("k4", 1, None), ("new", 1, 5), ("k3", 1, None), ("k3", 1, 40))
    served.upsert(second, ["n"], "v", 1)
    whole = upsert_latest(first, second, "k", ["n"], "v")
    assert rows(served.read()) == rows(whole)
    assert ("k3",) not in rows(served.read().select("k"))  # on a tie a deletion wins
    after, touched = files(tmp_path), served.touched(second)
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept <= after
    assert not (before - kept) & after


def test_a_bucket_that_loses_all_its_rows_goes(spark, tmp_path):
    served = table(spark, tmp_path)
    served.upsert(changes(spark, ("a", 0, 1), ("b", 0, 2)), ["n"], "v", 0)
    served.upsert(changes(spark, ("a", 1, None)), ["n"], "v", 1)
    assert rows(served.read()) == [("b", 0, 2)]
    served.upsert(changes(spark, ("b", 2, None)), ["n"], "v", 2)
    assert rows(served.read()) == [] and not files(tmp_path)


def test_a_change_that_failed_half_way_is_put_in_place_again(spark, tmp_path, monkeypatch):
    served = table(spark, tmp_path)
    served.upsert(changes(spark, *((f"k{i}", 0, i) for i in range(20))), ["n"], "v", 0)
    change = changes(spark, *((f"k{i}", 1, None if i % 2 else i + 100) for i in range(20)))
    with monkeypatch.context() as patched:
        patched.setattr(B, "remove_folder", lambda *_: (_ for _ in ()).throw(OSError("the driver is lost")))
        patched.setattr(B, "drop_old_versions", lambda *_: (_ for _ in ()).throw(OSError("the driver is lost")))
        with pytest.raises(OSError, match="driver is lost"):
            served.upsert(change, ["n"], "v", 1)
    # As if the commit had deleted buckets and not yet put the new ones in place.
    for folder in sorted((tmp_path / "t").glob("bucket=*"))[:3]:
        for file in folder.iterdir():
            file.unlink()
    served.upsert(change, ["n"], "v", 1)
    assert rows(served.read()) == sorted((f"k{i}", 1, i + 100) for i in range(0, 20, 2))
    served.upsert(change, ["n"], "v", 1)
    assert served.read().count() == 10


def test_lookup_reads_the_buckets_of_its_keys(spark, tmp_path):
    served = table(spark, tmp_path, 16)
    served.upsert(changes(spark, *((f"k{i}", 0, i) for i in range(200)), (None, 0, 1)), ["n"], "v", 0)
    keys = spark.createDataFrame([("k5",), ("k5",), (None,), ("unknown",)], "k string")
    found = served.lookup(keys)
    assert rows(found) == rows(served.read().filter("k = 'k5' OR k IS NULL"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan and "numPartitions" not in plan
    scanned = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert scanned <= {str(b) for b in served.touched(keys)} | scanned and len(served.touched(keys)) < 16


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    table(spark, tmp_path).upsert(changes(spark, ("a", 0, 1)), ["n"], "v", 0)
    with pytest.raises(ValueError, match="8 buckets, not 4"):
        table(spark, tmp_path, 4).read()


# Seats kept by changes


def drain(spark, source, lake, reference, files_at_once=1, **options):  # noqa: F811
    L.drain(file_stream(spark, str(source.folder), files_at_once), lake, reference, clock=lambda: AT, changes_only=True, **options)


def batch_seats(spark, source, reference):  # noqa: F811
    clean = V.clean_votes(file_table(spark, str(source.folder)))
    return S.allocate_seats(V.votes_per_party(clean), reference)


def test_changes_give_what_the_batch_gives_and_restart(spark, source, lake, reference):  # noqa: F811
    source.add(*(vote(i) for i in range(40)))
    for more in ((vote(i) for i in range(30, 80)), (vote(i, "other") for i in range(80, 90)), ()):
        source.add(*more, "not json")
        drain(spark, source, lake, reference)
        gold = rows(batch_seats(spark, source, reference))
        assert rows(L.current_seats(spark, lake, changes_only=True)) == gold
        served = L.served_seats(spark, lake, changes_only=True)
        assert rows(served.select("autonomic_region_name", "province_name", "political_party", "seats")) == gold


COUNTS = "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint"


def counts(spark, *items):
    return spark.createDataFrame(list(items), COUNTS)


def test_only_changed_provinces_are_allocated(spark, lake, monkeypatch):  # noqa: F811
    provinces = [f"P{i}" for i in range(30)]
    reference = spark.createDataFrame([(p, 5) for p in provinces], "province_name string, total_seats bigint")
    allocated, allocate = [], L.allocate_seats

    def counting(votes, *rest):
        allocated.append(sorted(r[0] for r in votes.select("province_name").distinct().collect()))
        return allocate(votes, *rest)

    monkeypatch.setattr(L, "allocate_seats", counting)
    publish = L.change_publisher(lake, reference, FileSink(lake.seat_messages), clock=lambda: AT)
    everything = [("R", p, party, n) for p in provinces for party, n in (("A", 10), ("B", 6))]
    publish(counts(spark, *everything), 0)
    tables = L.SeatTables.of(spark, lake)
    before = set(tables.seats.read().inputFiles())
    publish(counts(spark, ("R", "P3", "A", 1000)), 1)
    assert allocated == [sorted(provinces), ["P3"]]
    left = before & set(tables.seats.read().inputFiles())
    assert len(left) == len(before) - 1
    now = [x if x[1:3] != ("P3", "A") else ("R", "P3", "A", 1000) for x in everything]
    assert rows(L.current_seats(spark, lake, changes_only=True)) == rows(allocate(counts(spark, *now), reference))
    sent = spark.read.parquet(f"{lake.seat_messages}/batch_id=1").collect()
    assert {r["key"]: r["value"] is None for r in sent} == {"P3_A": False, "P3_B": True}


@pytest.mark.parametrize("step", range(6))
def test_a_repeated_micro_batch_gives_the_same(spark, lake, reference, monkeypatch, step):  # noqa: F811
    """The driver is lost at each of the writes in turn; the batch comes again."""
    publish = L.change_publisher(lake, reference, FileSink(lake.seat_messages), clock=lambda: AT)
    publish(counts(spark, ("R", "P", "A", 10), ("R", "P", "B", 6), ("R", "Q", "A", 4)), 0)
    change = counts(spark, ("R", "P", "A", 1000), (None, "Q", "C", 3))
    write, calls = B.write_version, []

    def failing(df, path, version):
        calls.append(path)
        if len(calls) == step + 1:
            raise OSError("the driver is lost")
        write(df, path, version)

    with monkeypatch.context() as patched:
        patched.setattr(B, "write_version", failing)
        patched.setattr(L, "write_version", failing)
        with pytest.raises(OSError, match="driver is lost"):
            publish(change, 1)
    for _ in range(2):
        publish(change, 1)
    gold = rows(L.current_seats(spark, lake, changes_only=True))
    every = counts(spark, ("R", "P", "A", 1000), ("R", "P", "B", 6), ("R", "Q", "A", 4), (None, "Q", "C", 3))
    assert gold == rows(S.allocate_seats(every, reference))
    sent = spark.read.parquet(f"{lake.seat_messages}/batch_id=1").collect()
    assert {r["key"]: r["value"] is None for r in sent} == {"P_A": False, "P_B": True, "Q_A": False, "Q_C": False}
    served = L.served_seats(spark, lake, changes_only=True)
    assert rows(served.select("autonomic_region_name", "province_name", "political_party", "seats")) == gold


def test_a_key_that_another_province_shares_gets_no_tombstone(spark, lake):  # noqa: F811
    reference = spark.createDataFrame([("P", 5), ("P_A", 3)], "province_name string, total_seats bigint")
    publish = L.change_publisher(lake, reference, FileSink(lake.seat_messages), clock=lambda: AT)
    publish(counts(spark, ("R", "P", "A_B", 60), ("R", "P", "C", 50), ("R", "P_A", "B", 50)), 0)
    publish(counts(spark, ("R", "P", "A_B", 1), ("R", "P", "C", 1000)), 1)
    sent = spark.read.parquet(f"{lake.seat_messages}/batch_id=1").collect()
    assert {r["key"]: r["value"] is None for r in sent} == {"P_C": False}
    assert len(rows(L.served_seats(spark, lake, changes_only=True))) == 2


def test_event_time_stream_loses_nothing(spark, source, lake):  # noqa: F811
    """Micro-batches in turn: old, future and undated votes go to the side table, all others are kept once."""
    now = [vote(i) for i in range(30)]  # dated 2026, hours or months from the clock of this test
    old = [vote(100).replace("2026-01-01", "1999-01-01"), vote(101).replace("2026-01-01", "2999-01-01")]
    undated = vote(102).replace('"2026-01-01T00:01:42.123456"', "null")
    source.add(*now[:20], *old)
    source.add(*now[10:], undated, *old)
    once = L.Trigger(available_now=True, max_files=1)
    L.start_bronze(file_stream(spark, str(source.folder), 1), lake, once).awaitTermination()
    for _ in range(2):
        L.start_silver(spark, lake, once, within="40000 days", event_time=True).awaitTermination()
        L.start_out_of_time(spark, lake, "40000 days", once).awaitTermination()
    kept = sorted(r["id"] for r in spark.read.parquet(lake.silver).collect())
    out = sorted((r["id"], r["reason"]) for r in spark.read.parquet(lake.out_of_time).collect())
    assert kept == sorted([*(f"v{i}" for i in range(30)), "v100"])
    assert out == [("v101", "early"), ("v101", "early"), ("v102", "undated")]
    read = spark.read.parquet(lake.bronze)
    copies = read.count() - len(kept) - len(out)
    assert copies == 11 and read.filter("arrived IS NULL OR ingested IS NULL").count() == 0
    with pytest.raises(ValueError, match="needs a delay"):
        L.start_silver(spark, lake, once, event_time=True)
