import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from escrutinio.operators.positions import chunked_lists, pick, weighted_ranges
from escrutinio.operators.sampling import bernoulli_flag, coordinate_pick, weighted_draw


def digest(item):
    return hashlib.md5(str(item).encode()).hexdigest()


def brute_ranges(rows):
    """(group, item, weight) rows as {(group, item): (lo, hi)}."""
    result = {}
    for group in {r[0] for r in rows}:
        totals = Counter()
        for g, item, weight in rows:
            if g == group and weight > 0:
                totals[item] += weight
        position = 0
        for item in sorted(totals, key=lambda i: (digest(i), i)):
            result[group, item] = (position, position + totals[item])
            position += totals[item]
    return result


def test_ranges_of_hot_groups_and_hot_items(spark):
    rows = [("hot", f"item{i % 400}", 1 + i % 3) for i in range(2000)]
    rows += [("hot", "copied", 1)] * 1000 + [("cold", "item1", 2), ("cold", "gone", 0), (None, "item1", 3)]
    df = spark.createDataFrame(rows, "g string, item string, w bigint")
    got = weighted_ranges(df, ["g"], "item", F.col("w")).collect()
    assert {(r["g"], r["item"]): (r["lo"], r["hi"]) for r in got} == brute_ranges(rows)
    hot = next(r for r in got if r["g"] == "hot")
    assert (hot["items"], hot["total"]) == (401, sum(r[2] for r in rows if r[0] == "hot"))


def test_ranges_without_groups(spark):
    rows = [("", f"item{i}", i) for i in range(50)]
    df = spark.createDataFrame([r[1:] for r in rows], "item string, w bigint")
    got = weighted_ranges(df, [], "item", F.col("w")).collect()
    assert {("", r["item"]): (r["lo"], r["hi"]) for r in got} == brute_ranges(rows)


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_pick_equals_brute_force(spark, threshold):
    """With and without broadcast joins."""
    rows = [("a", f"item{i}", 1 if i else 5000) for i in range(300)] + [("b", "only", 1)]
    weights = spark.createDataFrame(rows, "g string, item string, w bigint")
    expected = brute_ranges(rows)
    totals = {g: max(hi for (group, _), (_, hi) in expected.items() if group == g) for g in "ab"}
    numbers = [(g, n / 500) for g in ("a", "b", "missing", None) for n in range(500)]
    df = spark.createDataFrame(numbers, "g string, u double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = pick(df, F.col("u"), weighted_ranges(weights, ["g"], "item", F.col("w")), ["g"], "item", "out").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == len(numbers)
    for row in got:
        if row["g"] in ("a", "b"):
            lo, hi = expected[row["g"], row["out"]]
            assert lo <= row["u"] * totals[row["g"]] < hi
        else:
            assert row["out"] is None


def test_fractional_ranges_meet(spark):
    weights = spark.range(2000).selectExpr("concat('n', id) AS item", "1.0D / (id + 3) AS w")
    ranges = sorted(
        (r["lo"], r["hi"], r["total"]) for r in weighted_ranges(weights, [], "item", F.col("w")).collect()
    )
    assert ranges[0][0] == 0 and ranges[-1][1] == ranges[-1][2]
    assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    drawn = weighted_draw(spark.range(20_000), "id", weights, "item", "w", "out")
    assert drawn.filter("out IS NULL").count() == 0


def test_weighted_draw_follows_the_weights(spark):
    weights = spark.createDataFrame([("A", 1.5), ("B", 3.0), ("C", 0.0), ("D", 5.5)], "name string, w double")
    drawn = weighted_draw(spark.range(20_000), "id", weights, "name", "w", "party")
    shares = {r[0]: r[1] / 20_000 for r in drawn.groupBy("party").count().collect()}
    assert set(shares) == {"A", "B", "D"}
    assert all(math.isclose(shares[k], v, abs_tol=0.015) for k, v in {"A": 0.15, "B": 0.3, "D": 0.55}.items())


def test_seed_changes_the_draw(spark):
    weights = spark.createDataFrame([("A", 1), ("B", 1)], "name string, w bigint")
    one, two = (weighted_draw(spark.range(200), "id", weights, "name", "w", "p", seed=s).collect() for s in (0, 1))
    assert sorted(one) != sorted(two)


def test_coordinate_pick(spark):
    points = spark.createDataFrame(
        [("01", "1.0,1.0")] * 3 + [("01", "2.0,2.0"), ("02", "3.0,3.0")], "prov_code string, coordinate string"
    )
    ids = spark.range(4000).withColumn("prov_code", F.when(F.col("id") % 4 == 0, "02").otherwise("01"))
    counts = Counter((r["prov_code"], r["location"]) for r in coordinate_pick(ids, "id", points).collect())
    assert counts["02", "3.0,3.0"] == 1000
    assert math.isclose(counts["01", "1.0,1.0"] / 3000, 0.75, abs_tol=0.04)


def test_coordinate_pick_of_an_unknown_province(spark):
    points = spark.createDataFrame([("01", "1.0,1.0")], "prov_code string, coordinate string")
    ids = spark.createDataFrame([(1, "01"), (2, "99")], "id bigint, prov_code string")
    lenient = coordinate_pick(ids, "id", points, strict=False)
    assert {r["id"]: r["location"] for r in lenient.collect()} == {1: "1.0,1.0", 2: None}
    with pytest.raises(Exception, match="no coordinate to draw for the province 99"):
        coordinate_pick(ids, "id", points).collect()


def test_bernoulli_flag(spark):
    flags = bernoulli_flag(spark.range(100), "id", "always", 1.0)
    assert all(r["always"] for r in flags.collect())
    assert not any(r["never"] for r in bernoulli_flag(spark.range(100), "id", "never", 0.0).collect())


def test_chunked_lists_keep_all_values_and_order(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 50) END AS g")
    lists = chunked_lists(df, ["g"], F.col("id"), "id", "ids", 50).collect()
    found = sorted(i for r in lists for i in r["ids"])
    assert found == list(range(1000))
    assert all(len(r["ids"]) <= 50 for r in lists)
    hot = sorted((r["chunk"], r["ids"]) for r in lists if r["g"] == "hot")
    assert [chunk for chunk, _ in hot] == list(range(7))
    assert [i for _, ids in hot for i in ids] == list(range(0, 1000, 3))
    assert {r["chunk"] for r in lists if r["g"] != "hot"} == {0}


def test_no_weight_is_lost_and_no_null_drawn(spark):
    items = spark.createDataFrame([("a", 1e-10), ("b", 5e9), (None, 3.0), ("c", 1.0), ("d", 0.0)], "item string, w double")
    found = {r["item"]: r for r in weighted_ranges(items, [], "item", F.col("w")).collect()}
    assert set(found) == {"a", "b", "c"} and {r["items"] for r in found.values()} == {3}
    assert sum(r["weight"] for r in found.values()) == found["a"]["total"]
    with pytest.raises(Exception, match="below 10"):
        weighted_ranges(items.withColumn("w", F.col("w") / 1e9), [], "item", F.col("w")).collect()
    points = spark.createDataFrame([("1", "x"), ("1", None), ("1", "y")], "prov_code string, coordinate string")
    drawn = coordinate_pick(spark.range(300).withColumn("prov_code", F.lit("1")), "id", points).collect()
    assert {r["location"] for r in drawn} == {"x", "y"}


def test_a_total_too_large_for_a_draw_is_an_error(spark):
    weights = spark.createDataFrame([("a", 1 << 53), ("b", 1)], "item string, w bigint")
    with pytest.raises(Exception, match="cannot be drawn from"):
        weighted_draw(spark.range(3), "id", weights, "item", "w", "out").collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("rows", "kind", "fault"),
    [
        ([("a", 1e12), ("b", 1.0)], "double", "10\\*\\*11 or more"),
        ([("a", float("inf")), ("b", 1.0)], "double", "10\\*\\*11 or more"),
        ([("a", 1e-20), ("b", 1.0)], "double", "below 10"),
        ([("a", (1 << 63) - 1), ("a", 5)], "bigint", "too large"),
        ([("a", (1 << 63) - 1), ("b", 5)], "bigint", "too large"),
    ],
)
def test_no_weight_is_lost_in_either_mode(spark, ansi, rows, kind, fault):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        weights = spark.createDataFrame(rows, f"item string, w {kind}")
        with pytest.raises(Exception, match=fault):
            weighted_ranges(weights, [], "item", F.col("w")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
