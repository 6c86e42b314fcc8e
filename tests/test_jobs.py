import json

import pytest
from test_geometry import ALFA, BETA_STREETS, by_province, files  # noqa: F401
from test_reference import PROVINCES, REGIONS

from escrutinio.jobs import coordinates, votes
from escrutinio.operators.reference import PROVINCE_COLUMNS, REGION_COLUMNS
from escrutinio.sources.geo_files import coordinate_folders
from escrutinio.streaming.lake import Lake, current_seats


def vote(i, party, province):
    return json.dumps(
        {
            "id": str(i),
            "blank_vote": False,
            "political_party": party,
            "province_name": province,
            "autonomic_region_name": "One",
            "timestamp": "2026-01-01T00:00:00",
        }
    )


def test_votes_job(spark, tmp_path):
    spark.createDataFrame(
        [(*p[:2], p[2] if p[0] != 3 else "Gamma", p[3] or "", *p[4:]) for p in PROVINCES], list(PROVINCE_COLUMNS)
    ).write.parquet(str(tmp_path / "reference" / "provinces"))
    spark.createDataFrame([(*r[:2], "", *r[3:]) for r in REGIONS], list(REGION_COLUMNS)).write.parquet(
        str(tmp_path / "reference" / "regions")
    )
    (tmp_path / "source").mkdir()
    lines = [vote(i, "A" if i % 3 else "B", "Alfa") for i in range(90)] + [vote(5, "A", "Alfa")]
    (tmp_path / "source" / "a.txt").write_text("\n".join(lines))
    lake = Lake(str(tmp_path / "lake"), str(tmp_path / "checkpoints"))
    votes.main(
        [
            "--source-dir", str(tmp_path / "source"), "--reference-dir", str(tmp_path / "reference"),
            "--lake", lake.base, "--checkpoints", lake.checkpoints, "--once",
        ]
    )
    assert sorted(map(tuple, current_seats(spark, lake).collect())) == [("One", "Alfa", "A", 2), ("One", "Alfa", "B", 1)]


def test_votes_job_arguments():
    common = ["--lake", "l", "--checkpoints", "c", "--reference-dir", "r"]
    args = votes.arguments(["--kafka", "h:1", *common, "--dedup-within", "1 day"])
    assert (args.kafka, args.dedup_within, args.seats_interval) == ("h:1", "1 day", "1 minute")
    for wrong in (["--source-dir", "s", *common, "--event-time"], common, ["--kafka", "h:1", "--source-dir", "s", *common], ["--kafka", "h:1", "--once", *common]):
        with pytest.raises(SystemExit):
            votes.arguments(wrong)


def test_coordinates_job(spark, files, tmp_path):  # noqa: F811
    coordinates.main(
        [
            "--municipalities", str(files / "lines.json"), "--lines", "--streets", str(files / "streets"),
            "--mapping", str(files / "list.json"), "--output", str(tmp_path / "out"),
        ]
    )
    found = by_province(coordinate_folders(spark, str(tmp_path / "out")))
    assert found["01"] == ALFA and set(found) == {"01", "02"} and found["02"] - BETA_STREETS == {"8.5,9.5": 1}
    with pytest.raises(SystemExit):
        coordinates.main(["--municipalities", "m", "--streets", "s", "--output", "o"])
