"""Hand-worked allocations, invariants, and the plain method as brute force."""

import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from escrutinio.operators import seats as S

VOTES = "autonomic_region_name string, province_name string, political_party_norm string, votes_per_party bigint"
SEATS = "province_name string, total_seats bigint"


def votes_of(spark, rows):
    return spark.createDataFrame(rows, VOTES)


def allocation(spark, rows, seats, **options):
    result = S.allocate_seats(votes_of(spark, rows), spark.createDataFrame(seats, SEATS), **options)
    return {(r[0], r[1], r[2]): r[3] for r in result.collect()}


def stepwise(spark, rows, seats, threshold=0.03):
    valid = S.valid_votes(votes_of(spark, rows), threshold)
    ranked = S.seat_ranking(S.dhondt_quotients(S.join_seats(valid, spark.createDataFrame(seats, SEATS))))
    result = S.seats_with_zero(S.candidates(valid), S.dhondt_winners(ranked))
    return {(r[0], r[1], r[2]): r[3] for r in result.collect()}


def brute_force(rows, seats, threshold):
    """One province after the other, one seat after the other, in exact arithmetic."""
    result = {}
    for province in {r[1] for r in rows}:
        inside = [r for r in rows if r[1] == province]
        total = sum(r[3] for r in inside)
        valid = [r for r in inside if r[2] not in (None, "BLANK") and total and r[3] / total >= threshold]
        won = {r[:3]: 0 for r in valid}
        available = dict(seats).get(province) if province is not None else None
        for _ in range(available or 0):
            if not valid:
                break
            best = min(
                valid,
                key=lambda r: (-Fraction(r[3], won[r[:3]] + 1), -r[3], r[2], r[0] is not None, r[0] or ""),
            )
            won[best[:3]] += 1
        result.update(won)
    return result


def one_province(*votes):
    return [("R", "P", f"party{i}", v) for i, v in enumerate(votes)]


def seats_in_order(result):
    return [result[key] for key in sorted(result, key=str)]


@pytest.mark.parametrize("allocate", [allocation, stepwise])
class TestBothMethods:
    def test_worked_example(self, spark, allocate):
        assert seats_in_order(allocate(spark, one_province(100, 80, 30, 20), [("P", 8)])) == [4, 3, 1, 0]

    def test_equal_quotients_favour_the_larger_party(self, spark, allocate):
        assert seats_in_order(allocate(spark, one_province(10, 5), [("P", 2)])) == [2, 0]

    def test_equal_parties_favour_the_lower_name(self, spark, allocate):
        assert seats_in_order(allocate(spark, one_province(7, 7), [("P", 1)])) == [1, 0]

    def test_threshold_is_inclusive(self, spark, allocate):
        rows = one_province(3, 97)
        assert seats_in_order(allocate(spark, rows, [("P", 1)])) == [0, 1]

    def test_below_the_threshold_drops_out(self, spark, allocate):
        assert set(allocate(spark, one_province(2, 98), [("P", 3)])) == {("R", "P", "party1")}

    def test_blank_votes_raise_the_threshold(self, spark, allocate):
        rows = [("R", "P", "A", 97), ("R", "P", "B", 3), ("R", "P", "BLANK", 1)]
        assert set(allocate(spark, rows, [("P", 5)])) == {("R", "P", "A")}

    def test_all_blank_gives_no_rows(self, spark, allocate):
        assert allocate(spark, [("R", "P", "BLANK", 5)], [("P", 5)]) == {}

    @pytest.mark.parametrize("seats", [[("P", 0)], [("P", None)], [("Q", 4)], [("P", -2)]])
    def test_no_seats_to_give(self, spark, allocate, seats):
        assert seats_in_order(allocate(spark, one_province(6, 4), seats)) == [0, 0]

    def test_null_region_keeps_its_seats(self, spark, allocate):
        rows = [(None, "P", "A", 6), (None, "P", "B", 4)]
        assert allocate(spark, rows, [("P", 3)]) == {(None, "P", "A"): 2, (None, "P", "B"): 1}

    def test_null_party_counts_in_the_total_only(self, spark, allocate):
        rows = [("R", "P", None, 90), ("R", "P", "A", 8), ("R", "P", "B", 2)]
        assert allocate(spark, rows, [("P", 3)]) == {("R", "P", "A"): 3}

    def test_province_of_two_regions_is_one_contest(self, spark, allocate):
        rows = [("R", "P", "A", 50), ("S", "P", "A", 50)]
        assert allocate(spark, rows, [("P", 3)]) == {("R", "P", "A"): 2, ("S", "P", "A"): 1}


# A contest: votes by region and party, and the seats; each becomes a province.
_CONTEST = st.tuples(
    st.dictionaries(
        st.tuples(st.sampled_from(["R", "S", None]), st.sampled_from(["A", "B", "C", "D", "E", "F", "BLANK", None])),
        st.integers(1, 30),
        min_size=1,
        max_size=12,
    ),
    st.integers(0, 40),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(contests=st.lists(_CONTEST, min_size=20, max_size=60), threshold=st.sampled_from([0.0, 0.03, 0.2]))
def test_same_as_brute_force(spark, contests, threshold):
    names = [f"P{i}" if i else None for i in range(len(contests))]
    rows = [(r, name, p, n) for name, (votes, _) in zip(names, contests) for (r, p), n in votes.items()]
    seats = [(name, n) for name, (_, n) in zip(names, contests) if name is not None]
    expected = brute_force(rows, seats, threshold)
    assert allocation(spark, rows, seats, threshold=threshold) == expected
    assert stepwise(spark, rows, seats, threshold) == expected


def test_many_parties_without_a_threshold(spark):
    """One province holds nearly all of 3,000 parties; all are reported, all seats given."""
    generator = random.Random(7)
    rows = [("R", "P" if i % 50 else "Q", f"party{i:04d}", generator.randint(1, 10_000)) for i in range(3000)]
    seats = [("P", 60), ("Q", 25)]
    result = allocation(spark, rows, seats, threshold=0.0)
    assert result == brute_force(rows, seats, 0.0)
    assert sum(result.values()) == 85


def test_large_numbers_do_not_overflow(spark):
    rows = one_province(4 * 10**15, 3 * 10**15, 10**15)
    result = seats_in_order(allocation(spark, rows, [("P", 800_000)]))
    assert result == [400_000, 300_000, 100_000]


def test_rows_do_not_grow_with_the_seats(spark):
    rows = one_province(50, 30, 20)
    assert sum(seats_in_order(allocation(spark, rows, [("P", 10**9)]))) == 10**9


def test_more_votes_never_cost_seats(spark):
    base = one_province(41, 33, 26)
    before = allocation(spark, base, [("P", 7)])
    more = [(*base[0][:3], 60), *base[1:]]
    assert allocation(spark, more, [("P", 7)])[base[0][:3]] >= before[base[0][:3]]


def test_order_and_partitioning_do_not_matter(spark):
    rows = [("R", f"P{i % 3}", f"party{i % 7}", 10 + i % 5) for i in range(21)]
    seats = spark.createDataFrame([(f"P{i}", 5) for i in range(3)], SEATS)
    results = set()
    for partitions in (1, 3, 8):
        shuffled = rows[partitions:] + rows[:partitions]
        df = votes_of(spark, shuffled).repartition(partitions)
        results.add(tuple(sorted(map(tuple, S.allocate_seats(df, seats).collect()))))
    assert len(results) == 1


def test_messages_and_tombstones(spark):
    columns = "autonomic_region_name string, province_name string, political_party_norm string, seats bigint"
    before = spark.createDataFrame([("R", "P", "A", 1), ("R", "P", "B", 2)], columns)
    now = spark.createDataFrame([("R", "P", "A", 0)], columns)
    at = F.lit("2026-01-02 03:04:05.678901").cast("timestamp")
    assert S.seat_messages(now, at).collect() == [
        (
            "P_A",
            '{"doc_id":"P_A","province_name":"P","political_party":"A","autonomic_region_name":"R","seats":0,'
            '"updated_at":"2026-01-02T03:04:05.678901Z"}',
        )
    ]
    assert S.seat_tombstones(before, now).collect() == [("P_B", None)]
    assert '"updated_at":"20' in S.seat_messages(now).first()["value"]
