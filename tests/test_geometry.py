import json
from collections import Counter

import pytest

from escrutinio.operators.geometry import build_coordinates, coordinate_chunks, municipality_points, street_points
from escrutinio.sinks.coordinates import write_coordinate_files, write_coordinates
from escrutinio.sources import geo_files

MUNICIPALITIES = [
    {
        "prov_code": "01",
        "prov_name": "Alfa",
        "geo_point_2d": {"lon": -0.00045, "lat": 40.5},
        "geo_shape": {"geometry": {"type": "Polygon", "coordinates": [[[1.5, 41], [2.5, 42.25], [1.5, 41]]]}},
    },
    {
        "prov_code": "01",
        "prov_name": "Alfa",
        "geo_shape": {
            "geometry": {
                "type": "MultiPolygon",
                "coordinates": [[[[0.5, 1.5], [0.25, 1.25]]], [[[3.5, 4.5]], [[5.5, 6.5], [1e-05, 7.5]]]],
            }
        },
    },
    {"prov_code": "02", "prov_name": "Beta", "geo_point_2d": {"lon": 9.5, "lat": 8.5}},
    {"prov_code": "03", "prov_name": "Gamma", "geo_shape": {"geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}},
    {"prov_code": "04", "prov_name": "Delta", "geo_point_2d": None, "geo_shape": {"geometry": None}},
]
ALFA = Counter(
    ["40.5,-0.00045", "41,1.5", "41,1.5", "42.25,2.5", "1.5,0.5", "1.25,0.25", "4.5,3.5", "6.5,5.5", "7.5,1e-05"]
)
STREETS = {
    "beta.json": {
        "type": "FeatureCollection",
        "features": [
            {"geometry": {"type": "LineString", "coordinates": [[1.5, 2.5], [3.5, 4.5]]}},
            {"geometry": {"type": "MultiLineString", "coordinates": [[[5.5, 6.5]], [[7.5, 8.5], [9.5, 10.5]]]}},
            {"geometry": {"type": "Polygon", "coordinates": [[[0.0, 0.0]]]}},
            {"geometry": {}},
        ],
    },
    "other.json": {"features": [{"geometry": {"type": "LineString", "coordinates": [[0.5, 0.5]]}}]},
    "empty.json": {"type": "FeatureCollection"},
}
BETA_STREETS = Counter(["2.5,1.5", "4.5,3.5", "6.5,5.5", "8.5,7.5", "10.5,9.5"])


@pytest.fixture
def files(tmp_path):
    (tmp_path / "municipalities.json").write_text(json.dumps(MUNICIPALITIES, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, MUNICIPALITIES)))
    (tmp_path / "streets").mkdir()
    for name, content in STREETS.items():
        (tmp_path / "streets" / name).write_text(json.dumps(content))
    (tmp_path / "list.json").write_text(json.dumps({"Beta": "beta.json", "Gamma": "missing.json"}, indent=1))
    return tmp_path


def by_province(points):
    found = {}
    for row in points.collect():
        found.setdefault(row[0], Counter())[row[1]] += 1
    return found


@pytest.mark.parametrize("name", ["municipalities.json", "lines.json"])
def test_shapes_and_centres(spark, files, name):
    records = geo_files.municipalities(spark, str(files / name), lines=name == "lines.json")
    assert by_province(municipality_points(records)) == {"01": ALFA, "02": Counter(["8.5,9.5"])}


def test_streets(spark, files):
    points = by_province(street_points(geo_files.streets(spark, str(files / "streets"))))
    assert points == {"beta.json": BETA_STREETS, "other.json": Counter(["0.5,0.5"])}


def test_build_coordinates(spark, files):
    points = build_coordinates(
        geo_files.municipalities(spark, str(files / "municipalities.json")),
        geo_files.streets(spark, str(files / "streets")),
        geo_files.street_mapping(spark, str(files / "list.json")),
    )
    assert by_province(points) == {"01": ALFA, "02": Counter(["8.5,9.5"]) + BETA_STREETS}


def test_chunks_are_whole_and_bounded(spark):
    rows = [("hot", "9.0,9.0")] * 500 + [("hot", f"1.0,{i}.5") for i in range(120)] + [("cold", "1.0,2.0")]
    points = spark.createDataFrame(rows, "prov_code string, coordinate string")
    chunks = coordinate_chunks(points, 50).collect()
    assert max(len(r["coordinates"]) for r in chunks) == 50
    assert {r["chunk"] for r in chunks if r["prov_code"] == "hot"} == set(range(13))
    assert Counter((r["prov_code"], c) for r in chunks for c in r["coordinates"]) == Counter(rows)


def test_write_and_load(spark, tmp_path):
    rows = [("01", "1.0,2.0")] * 3 + [("02", "3.0,4.0")]
    write_coordinates(spark.createDataFrame(rows, "prov_code string, coordinate string"), str(tmp_path / "out"), 2)
    lines = [json.loads(s) for f in (tmp_path / "out" / "prov_code=01").glob("*.json") for s in f.read_text().split("\n") if s]
    assert sorted(len(line["coordinates"]) for line in lines) == [1, 2]
    assert by_province(geo_files.coordinate_folders(spark, str(tmp_path / "out"))) == {
        "01": Counter({"1.0,2.0": 3}),
        "02": Counter(["3.0,4.0"]),
    }


def test_coordinate_files_by_name(spark, tmp_path):
    (tmp_path / "07.json").write_text(json.dumps({"coordinates": ["1.0,2.0", "1.0,2.0"]}, indent=2))
    (tmp_path / "08.json").write_text(json.dumps({"coordinates": []}))
    (tmp_path / "09.json").write_text(json.dumps({"other": 1}))
    (tmp_path / "notes.txt").write_text("x")
    assert by_province(geo_files.coordinate_files(spark, str(tmp_path))) == {"07": Counter({"1.0,2.0": 2})}


def test_coordinate_files_are_written_again(spark, tmp_path):
    """The second run has fewer provinces; a limit of records per file does not split one."""
    path, schema = str(tmp_path / "out"), "prov_code string, coordinate string"
    rows = [("01", f"{i}.5,2.0") for i in range(9)] + [("02", "3.0,4.0")]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "1")
    try:
        write_coordinate_files(spark.createDataFrame(rows, schema), path, 2)
        assert by_province(geo_files.coordinate_files(spark, path)) == {"01": Counter(c for _, c in rows[:9]), "02": Counter(["3.0,4.0"])}
        write_coordinate_files(spark.createDataFrame(rows[:3], schema), path, 2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert by_province(geo_files.coordinate_files(spark, path)) == {"01": Counter(c for _, c in rows[:3])}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["01.json"]
