"""The physical plans have the shape that scales."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from escrutinio.operators import geometry, positions
from escrutinio.operators import votes as V
from escrutinio.plans import fixture

SF_DIR = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["dhondt_seats"](spark, SF_DIR))
    schemas = set(re.findall(r"ReadSchema: (\S+)", plan))
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp>" in {
        s.replace("timestamp_ntz", "timestamp") for s in schemas
    }
    assert "struct<c_custkey:bigint,c_nationkey:int>" in schemas


def test_votes_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("{}\n")
    plan = plan_of(V.clean_votes(spark.read.text(str(tmp_path))))
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    "name", ["province_totals", "threshold_filter", "seats_join", "seat_ranking", "dhondt_seats", "candidates"]
)
def test_votes_are_counted_once(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("SortAggregate(") == 2  # one dedup: before and after its shuffle


def test_a_count_shuffles_only_what_it_needs(spark):
    plan = plan_of(QUERIES["votes_per_party"](spark, SF_DIR))
    (compared,) = set(re.findall(r"partial_min\((struct\(.*?)\)", plan))
    assert "timestamp" in compared and "location" not in compared and "iso_code" not in compared


def test_points_are_flattened_and_shuffled_once(spark):
    provinces = fixture.provincias(spark, SF_DIR).selectExpr("codigo_provincia AS province_code", "nombre AS province_name")
    points = geometry.build_coordinates(
        fixture.municipalities(spark, SF_DIR), fixture.streets(spark, SF_DIR), fixture.street_mapping(spark, SF_DIR), provinces
    )
    ranges = positions.weighted_ranges(points, ["prov_code"], "coordinate", F.lit(1))
    ranges.collect()
    final = plan_of(ranges).split("Initial Plan")[0]
    dealt = [line for line in final.splitlines() if re.search(r"Exchange hashpartitioning\(prov_code#\d+, coordinate#", line)]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1


def test_files_are_matched_before_they_are_parsed(spark):
    points = geometry.build_coordinates(
        fixture.municipalities(spark, SF_DIR), fixture.streets(spark, SF_DIR), fixture.street_mapping(spark, SF_DIR)
    )
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    streets = plan[plan.index("Union") :]
    assert streets.rindex("Generate explode") < streets.index("file_name")
