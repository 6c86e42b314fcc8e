"""Arrays read by many tasks against a JSON parser."""

import json
import random

import pytest
from test_geometry import by_province, files  # noqa: F401

from escrutinio.jobs import coordinates
from escrutinio.schemas import MUNICIPALITY
from escrutinio.sources import geo_files
from escrutinio.sources.json_arrays import array_records


def nested(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind == 0:
        return "".join(rng.choice('ab{}[],:"\\\n\té') for _ in range(rng.randrange(12)))
    if kind == 1:
        return rng.randrange(1000) / 8
    if kind in (2, 3):
        return rng.choice([None, True, "}", '"}{', "\\", '\\"}'])
    if kind == 4:
        return [nested(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice(['', '}', chr(34)])}": nested(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.fixture
def split_bytes(spark):
    def setting(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield setting
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("size", "indent"), [(97, None), (1000, 2), (1 << 20, None)])
def test_records_of_any_array(spark, tmp_path, split_bytes, size, indent):
    rng = random.Random(size)
    arrays = [[{"id": i, "v": nested(rng), "w": nested(rng)} for i in range(n)] for n in (60, 1, 0)]
    arrays.append([{}, {"id": 1}, {}, {"a": {}}])
    for k, array in enumerate(arrays):
        (tmp_path / f"{k}.json").write_text(json.dumps(array, indent=indent, ensure_ascii=k % 2 == 0) + "\n" * (k % 2))
    split_bytes(size)
    found = array_records(spark, str(tmp_path)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["file"], r["record"])):
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append(json.loads(r["value"]))
    assert got == {f"{k}.json": array for k, array in enumerate(arrays) if array}


def test_other_elements_are_no_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[null, "x{", 5, {"a": "]"}, [1], "}{", {"b": {}}, "}", 7, "}"]')
    found = array_records(spark, str(tmp_path)).orderBy("record").collect()
    assert [json.loads(r["value"]) for r in found] == [{"a": "]"}, {"b": {}}]


def plain(row):
    """A municipality with its numbers parsed, which as text can be spelled in several ways."""
    shape = row["geo_shape"] and row["geo_shape"]["geometry"]
    parsed = shape and (shape["type"], str(json.loads(shape["coordinates"] or "null")))
    point = row["geo_point_2d"] and [float(x) for x in row["geo_point_2d"] if x is not None]
    return str((row["prov_code"], row["prov_name"], point, parsed))


def test_municipalities_of_one_array(spark, files, tmp_path, split_bytes):  # noqa: F811
    array = [json.loads(line) for line in (files / "lines.json").read_text().splitlines()] * 30
    (tmp_path / "array.json").write_text(json.dumps(array))
    path = str(tmp_path / "array.json")
    whole = geo_files.municipalities(spark, path)
    split_bytes(500)
    many = geo_files.municipalities(spark, path, split=True)
    assert many.schema == MUNICIPALITY
    assert sorted(map(plain, many.collect())) == sorted(map(plain, whole.collect()))
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 5
    for k, options in enumerate((["--split"], [])):
        coordinates.main(["--municipalities", path, *options, "--output", str(tmp_path / f"out{k}")])
    assert by_province(geo_files.coordinate_folders(spark, str(tmp_path / "out0"))) == by_province(
        geo_files.coordinate_folders(spark, str(tmp_path / "out1"))
    )
