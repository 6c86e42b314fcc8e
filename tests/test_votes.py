from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from escrutinio.operators import votes as V
from escrutinio.operators.ranking import top_k_by_column
from escrutinio.schemas import VOTE

GOOD = (
    '{"id":"1","blank_vote":false,"political_party":"A","province_name":"P","province_iso_code":"ES-P",'
    '"autonomic_region_name":"R","autonomic_region_iso_code":"ES-R","location":"40.1,-3.2",'
    '"timestamp":"2026-01-02T03:04:05.678901"}'
)
BLANK = GOOD.replace('"1"', '"2"').replace("false", "true").replace('"A"', "null")


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_keeps_microseconds_in_utc(spark):
    row = V.parse_votes(messages(spark, GOOD)).withColumn("text", F.col("timestamp").cast("string")).first()
    assert (row["id"], row["blank_vote"], row["raw"]) == ("1", False, None)
    assert row["text"] == "2026-01-02 03:04:05.678901"


def test_parse_accepts_bytes(spark):
    raw = messages(spark, GOOD).select(F.col("value").cast("binary"))
    assert V.parse_votes(raw).first()["id"] == "1"


def test_malformed_messages_are_rejected_with_their_text(spark):
    bad = ["not json", '{"id":"3","blank', '{"blank_vote":true}', None]
    parsed = V.parse_votes(messages(spark, GOOD, *bad))
    assert parsed.count() == 5
    assert {r["raw"] for r in V.rejects(parsed).collect()} == set(bad)
    assert [r["id"] for r in V.accepted(parsed).collect()] == ["1"]


def test_a_field_of_the_wrong_type_is_null(spark):
    row = V.parse_votes(messages(spark, GOOD.replace("false", '"maybe"'))).first()
    assert (row["id"], row["blank_vote"], row["political_party"]) == ("1", None, "A")


def test_clean_votes(spark):
    rows = V.clean_votes(messages(spark, GOOD, GOOD, BLANK, "junk", "junk")).collect()
    assert {(r["id"], r["political_party"], r["political_party_norm"]) for r in rows} == {
        ("1", "A", "A"),
        ("2", None, "BLANK"),
    }
    assert len(rows) == 2


def test_normalize_blank_without_a_flag(spark):
    df = spark.createDataFrame([(None, "A"), (True, "A"), (False, None)], "blank_vote boolean, political_party string")
    assert [r[2] for r in V.normalize_blank(df).collect()] == ["A", "BLANK", None]


def test_dedup_keeps_the_earliest_copy_of_a_hot_id(spark):
    rows = [
        (str(i) if i % 3 else "hot", None, f"p{i}", "P", None, None, None, None, datetime(2026, 1, 1, 0, 0, i % 60, i))
        for i in range(600)
    ]
    votes = spark.createDataFrame(rows, VOTE).repartition(7)
    kept = {r["id"]: r["political_party"] for r in V.dedup_votes(votes).collect()}
    assert len(kept) == 401
    assert kept["hot"] == "p0"


def test_votes_per_party(spark):
    df = V.clean_votes(messages(spark, GOOD, BLANK, BLANK.replace('"2"', '"3"')))
    assert set(map(tuple, V.votes_per_party(df).collect())) == {("R", "P", "A", 1), ("R", "P", "BLANK", 2)}


def test_vote_messages(spark):
    rows = {r["key"]: r["value"] for r in V.vote_messages(V.clean_votes(messages(spark, GOOD, BLANK))).collect()}
    assert len(rows) == 2
    with_party = next(v for v in rows.values() if '"id":"1"' in v)
    blank = next(v for v in rows.values() if '"id":"2"' in v)
    assert '"political_party":"A"' in with_party and "political_party" not in blank
    assert '"timestamp":"2026-01-02T03:04:05.678901Z"' in with_party


def test_top_k_by_column_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i}", i, 5) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v bigint, k bigint")
    top = top_k_by_column(df, ["g"], [F.desc("v")], "k")
    hot = top.filter("g = 'hot'").orderBy("ranking").collect()
    assert [(r["v"], r["ranking"]) for r in hot] == [(899, 1), (898, 2), (896, 3), (895, 4), (893, 5)]
    assert top.count() == 305


NOT_ONE = [
    '{"id":"17"}{"id":"18"}',
    '{"id":"17"},{"id":"18"}',
    '{"id":""}',
    "[]",
    "",
    "17",
    '{"id":"18"}],[{"id":"19"}',
    '{"id":"17"}] xyz',
    '{"id":"17"}]',
    '{"id":"17"},"b":[1]',
    '{"id":"17"}}, [{"id":"18"}',
    '{"id":"17"}]}, {"vote":[{"id":"18"}',
]


@pytest.mark.parametrize("text", NOT_ONE)
def test_what_is_not_one_vote_is_rejected_whole(spark, text):
    parsed = V.parse_votes(spark.createDataFrame([(text,)], "value string"))
    assert [r["raw"] for r in V.rejects(parsed).collect()] == [text] and V.accepted(parsed).count() == 0


def test_brackets_inside_a_vote_are_no_fault(spark):
    texts = ['{"id":"1","political_party":"A]"}', ' {"id":"2","more":[1,{"x":[]}]} ', '{"id":"3","location":"[1]"}']
    found = V.parse_votes(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [(r["id"], r["raw"]) for r in found.collect()] == [("1", None), ("2", None), ("3", None)]


TIMES = [("kept", 0), ("kept", 71), ("late", 72), ("late", 500), ("kept", -71), ("early", -72), ("undated", None)]


def test_votes_out_of_time_are_named_and_none_is_lost(spark):
    arrived = datetime(2024, 5, 10, 12)
    rows = [
        (f"{reason}{i}", None if hours is None else arrived - timedelta(hours=hours), arrived, arrived + timedelta(days=copy))
        for i, (reason, hours) in enumerate(TIMES)
        for copy in range(2)
    ]
    votes = spark.createDataFrame(rows, "id string, timestamp timestamp, arrived timestamp, ingested timestamp")
    kept = sorted(r["id"] for r in V.dedup_in_time(votes, "3 days").collect())
    assert kept == sorted(f"{reason}{i}" for i, (reason, _) in enumerate(TIMES) if reason == "kept")
    out = V.out_of_time(votes, "3 days").collect()
    assert all(r["id"].startswith(r["reason"]) for r in out) and len(out) == 2 * sum(reason != "kept" for reason, _ in TIMES)


def test_a_dated_copy_wins_over_one_without_a_time(spark):
    at = datetime(2024, 5, 1)
    rows = [("1", None, "A"), ("1", at, "X"), ("2", None, "B"), ("2", None, "A")]
    copies = spark.createDataFrame(rows, "id string, timestamp timestamp, political_party string")
    assert {(r["id"], r["political_party"]) for r in V.dedup_votes(copies).collect()} == {("1", "X"), ("2", "A")}
    with pytest.raises(ValueError, match="no such columns"):
        V.dedup_votes(copies, ["arrived"])
