import pytest

from escrutinio import session
from escrutinio.folders import exists
from escrutinio.schemas import SEATS
from escrutinio.session import scratch_dir
from escrutinio.sinks import snapshots, versions
from escrutinio.sinks.messages import FileSink, KafkaSink
from escrutinio.sources import messages, tables


def test_kafka_options():
    assert messages.kafka_options("host:9092", "votes_raw", maxOffsetsPerTrigger="1000") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "votes_raw",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert KafkaSink("host:9092", "votes_clean").options == {
        "kafka.bootstrap.servers": "host:9092",
        "topic": "votes_clean",
    }


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t", split=("id", 1, 50, 4), user="u") == {
        "url": "jdbc:x",
        "dbtable": "t",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "50",
        "numPartitions": "4",
        "user": "u",
    }
    assert tables.jdbc_options("jdbc:x", query="select 1") == {"url": "jdbc:x", "query": "select 1"}
    for wrong in ({}, {"table": "t", "query": "q"}, {"query": "q", "split": ("id", 1, 2, 3)}):
        with pytest.raises(ValueError):
            tables.jdbc_options("jdbc:x", **wrong)


def test_file_messages(spark, tmp_path):
    pair = spark.createDataFrame([("k", "v"), ("t", None)], "key string, value string")
    sink = FileSink(str(tmp_path / "m"))
    sink.write(pair, 3)
    sink.write(pair, 3)
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert sorted(map(tuple, rows)) == [("k", "v", 3), ("t", None, 3)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\ntwo\n")
    assert messages.file_table(spark, str(tmp_path / "t")).count() == 2


def seats(spark, n):
    return spark.createDataFrame([("R", "P", "A", n)], SEATS)


def test_versions(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert versions.read_current(spark, path, SEATS).count() == 0
    for n in (1, 2, 10):
        versions.write_version(seats(spark, n), path, n)
    (tmp_path / "gold" / "version=11").mkdir()  # not complete
    assert versions.versions(spark, path) == [1, 2, 10]
    assert versions.read_current(spark, path, SEATS).first()["seats"] == 10
    assert versions.read_current(spark, path, SEATS, before=10).first()["seats"] == 2
    versions.drop_old_versions(spark, path, 2)
    assert versions.versions(spark, path) == [2, 10]
    with pytest.raises(ValueError):
        versions.drop_old_versions(spark, path, 0)


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(seats(spark, 1), path)
    snapshots.write_snapshot(seats(spark, 2), path)
    snapshots.append(seats(spark, 3), path)
    assert sorted(r["seats"] for r in spark.read.parquet(path).collect()) == [2, 3]


def test_an_incomplete_version_is_not_read(spark, tmp_path):
    frame, path = spark.range(3), str(tmp_path / "t")
    versions.write_version(frame, path, 1)
    frame.write.parquet(f"{path}/version=2")
    assert versions.versions(spark, path) == [1]
    with pytest.raises(ValueError, match="incomplete"):
        versions.read_version(spark, path, 2, frame.schema)


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if shared:
        assert path.startswith(shared.rstrip("/") + "/")


def test_scratch_is_removed(spark, tmp_path):
    path = scratch_dir(spark, "gone")
    spark.range(1).write.parquet(path)
    session._SCRATCH[spark.sparkContext.applicationId] = [path]
    session.remove_scratch(spark)
    assert not exists(spark, path)
