"""The number of micro-batches follows the bytes of a layer, not the number of its files."""

import pytest
from test_stream import batch_seats, drain, lake, reference, rows, source, vote  # noqa: F401

from escrutinio.folders import names
from escrutinio.plans import queries
from escrutinio.sources.messages import file_stream
from escrutinio.streaming import lake as L


def batches(spark, lake, layer):  # noqa: F811
    return len([name for name in names(spark, f"{lake.checkpoint(layer)}/commits") if name.isdigit()])


def fill(source):  # noqa: F811
    for k in range(3):
        source.add(*(vote(i) for i in range(k * 20, k * 20 + 30)))


def test_small_files_share_a_micro_batch(spark, source, lake, reference):  # noqa: F811
    fill(source)
    drain(spark, source, lake, reference, max_files=1, changes_only=True)
    found = {layer: batches(spark, lake, layer) for layer in ("bronze", "silver", "clean", "seat_changes")}
    assert found == {"bronze": 3, "silver": 1, "clean": 1, "seat_changes": 1}  # bronze by its source's own bound
    assert rows(L.current_seats(spark, lake, changes_only=True)) == rows(batch_seats(spark, source, reference))


@pytest.mark.parametrize("file_bytes", [None, 1])
def test_event_time_over_small_files(spark, source, lake, monkeypatch, file_bytes):  # noqa: F811
    if file_bytes:  # each file is more than full
        monkeypatch.setattr(L, "FILE_BYTES", file_bytes)
    fill(source)
    once = L.Trigger(available_now=True, max_files=1)
    L.start_bronze(file_stream(spark, str(source.folder), 1), lake, once).awaitTermination()
    L.start_silver(spark, lake, once, within="40000 days", event_time=True).awaitTermination()
    L.start_out_of_time(spark, lake, "40000 days", once).awaitTermination()
    later = [batches(spark, lake, "out_of_time"), batches(spark, lake, "silver")]
    assert later[0] == (3 if file_bytes else 1) and later[1] >= later[0]
    assert sorted(r["id"] for r in spark.read.parquet(lake.silver).collect()) == sorted(f"v{i}" for i in range(70))


def test_a_source_of_three_micro_batches_has_files_for_all_cores(spark, monkeypatch, reference):  # noqa: F811
    lines = spark.createDataFrame([(vote(i),) for i in range(300)], "value string")
    monkeypatch.setattr(queries.fixture, "raw_messages", lambda *_: lines)
    monkeypatch.setattr(queries.fixture, "seats_reference", lambda *_: reference)
    messages, lake, _ = queries._split_stream(spark, "", "three")  # noqa: F811
    written = [name for name in names(spark, lake.base.removesuffix("lake") + "source") if name.startswith("part-")]
    assert len(written) == 3 * spark.sparkContext.defaultParallelism
    L.start_bronze(messages, lake, L.Trigger(available_now=True)).awaitTermination()
    assert batches(spark, lake, "bronze") == 3
    assert sorted(r["id"] for r in spark.read.parquet(lake.bronze).collect()) == sorted(f"v{i}" for i in range(300))
