import math

import pytest
from pyspark.sql import functions as F

from escrutinio.functions.draws import bernoulli, uniform
from escrutinio.functions.geo import coordinate_text, number_text, parse_geo_point
from escrutinio.functions.keys import keyword, vote_doc_id
from escrutinio.functions.timestamps import parse_timestamp


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "number", [0.0, 1.5, -3.25, 40.0, 0.001, -0.00045, 0.0001, 1e-05, -4.5e-05, 1.25e-07, 4e-12, 179.99999999, 9999.5]
)
def test_number_text_of_floats(spark, number):
    assert values(spark, [repr(number)], number_text(F.col("x"))) == [repr(number)]


def test_number_text_of_integers_and_long_forms(spark):
    assert values(spark, ["40", "-3", "40.10", "4.50E-4"], number_text(F.col("x"))) == ["40", "-3", "40.1", "0.00045"]


def test_coordinate_text_needs_both_parts(spark):
    text = coordinate_text(F.col("x"), F.lit("-3.5"))
    assert values(spark, ["40.1", None], text) == ["40.1,-3.5", None]


def test_geo_points(spark):
    texts = ["40.4,-3.7", " 40.4 , -3.7 ", "136.5,1.0", "40.4,181", "40.4", "40.4,-3.7,1", "a,b", "", None]
    points = [p and tuple(p) for p in values(spark, texts, parse_geo_point(F.col("x")))]
    assert points == [(40.4, -3.7), (40.4, -3.7)] + [None] * 7


def test_timestamps(spark):
    texts = {
        "2026-01-02 03:04:05.678901": "2026-01-02 03:04:05.678901",
        "2026-01-02T03:04:05.678901": "2026-01-02 03:04:05.678901",
        "2026-01-02T03:04:05.678+01:00": "2026-01-02 02:04:05.678",
        "2026-01-02": "2026-01-02 00:00:00",
        "2026": "2026-01-01 00:00:00",
        "1767323045678": "2026-01-02 03:04:05.678",
        "123456": "1970-01-01 00:02:03.456",
        "2026-01-02 03:04": None,
        "yesterday": None,
        "99999999999999999999": None,
    }
    got = values(spark, list(texts), parse_timestamp(F.col("x")).cast("string"))
    assert dict(zip(texts, got, strict=True)) == texts


def test_keyword_length(spark):
    assert values(spark, ["a" * 256, "a" * 257, "ñ" * 256, None], keyword(F.col("x"))) == [
        "a" * 256, None, "ñ" * 256, None,
    ]


def test_doc_id_ignores_a_missing_party(spark):
    df = spark.createDataFrame(
        [(None, "P", "R"), ("A", "P", "R")],
        "political_party string, province_name string, autonomic_region_name string",
    )
    blank, party = (r[0] for r in df.select(vote_doc_id()).collect())
    assert blank != party and len(blank) == 64


def test_uniform_is_reproducible_and_even(spark):
    ids = spark.range(20_000).repartition(5)
    drawn = ids.select("id", uniform(F.col("id"), "a").alias("u"), uniform(F.col("id"), "b").alias("v"))
    again = spark.range(20_000).select("id", uniform(F.col("id"), "a").alias("u2"))
    assert drawn.join(again, "id").filter("u <> u2").count() == 0
    row = drawn.agg(F.avg("u"), F.min("u"), F.max("u"), F.corr("u", "v"), F.count_if(F.col("u") == F.col("v"))).first()
    assert math.isclose(row[0], 0.5, abs_tol=0.01) and row[1] >= 0 and row[2] < 1
    assert abs(row[3]) < 0.03 and row[4] == 0


def test_bernoulli_share(spark):
    share = spark.range(50_000).select(F.avg(bernoulli(F.col("id"), 0.01).cast("int"))).first()[0]
    assert math.isclose(share, 0.01, abs_tol=0.003)


@pytest.mark.parametrize("text", ["12345678901234567", "9" * 18, "-" + "9" * 16])
def test_a_number_too_long_for_a_time_is_null(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t"))).first()[0] is None
