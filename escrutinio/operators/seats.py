"""Seat allocation by the D'Hondt method.

Input of every operator is the small table of votes per region, province and party, or
something derived from it. Windows run per province, not per region and province: a
province that is listed under two regions is one contest.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from escrutinio.functions.keys import seat_doc_id
from escrutinio.operators.ranking import top_k_by_column
from escrutinio.operators.votes import JSON_OPTIONS
from escrutinio.schemas import BLANK, PARTY_KEY, THRESHOLD


def province_totals(votes: DataFrame) -> DataFrame:
    """Add the votes of the whole province to each row, blank votes included.

    An aggregate and a join instead of a window: the sum is built in the map tasks, and a
    province with very many party names is never gathered in one task.
    """
    totals = votes.groupBy(F.col("province_name").alias("_province")).agg(
        F.sum("votes_per_party").alias("total_votes_province")
    )
    return votes.join(totals, F.col("province_name").eqNullSafe(F.col("_province"))).drop("_province")


def party_share(with_totals: DataFrame) -> DataFrame:
    """Add the share of the province's votes; NULL where the province has none."""
    return with_totals.withColumn("share", F.try_divide("votes_per_party", "total_votes_province"))


def threshold_filter(with_totals: DataFrame, threshold: float = THRESHOLD, blank: str = BLANK) -> DataFrame:
    """Keep parties with at least ``threshold`` of the province; drop blank and NULL parties.

    One condition over party and total: a separate one on the party would be pushed below
    the count on this side of the join with the totals only, and the votes counted twice.
    """
    share = F.try_divide("votes_per_party", "total_votes_province")
    return with_totals.filter(F.when(F.col("political_party_norm") != blank, share) >= F.lit(float(threshold)))


def valid_votes(votes: DataFrame, threshold: float = THRESHOLD, blank: str = BLANK) -> DataFrame:
    return threshold_filter(province_totals(votes), threshold, blank)


def join_seats(valid: DataFrame, seats_reference: DataFrame) -> DataFrame:
    """Attach the seats of the province; provinces that are not in the reference drop out.

    No broadcast hint: Spark broadcasts the reference when its size allows. A plain
    equality would push "province is not NULL" below the count on one side of the join
    with the totals only, and the votes would be counted twice; hence the null-safe one.
    """
    seats = seats_reference.filter(F.col("province_name").isNotNull()).select(
        F.col("province_name").alias("_seats_province"), "total_seats"
    )
    return valid.join(seats, F.col("province_name").eqNullSafe(F.col("_seats_province"))).drop("_seats_province")


def dhondt_quotients(with_seats: DataFrame) -> DataFrame:
    """One row per party and divisor 1..total_seats; none where there are no seats.

    ``sequence(1, 0)`` would count down and divide by zero, hence the guard.
    """
    divisors = F.when(F.col("total_seats") >= 1, F.sequence(F.lit(1).cast("bigint"), F.col("total_seats")))
    return with_seats.withColumn("divisor", F.explode(divisors)).withColumn(
        "quotient", F.col("votes_per_party") / F.col("divisor")
    )


def quotient_order() -> list[Column]:
    """Highest quotient first, then the larger party; names settle what is still tied."""
    return [
        F.desc("quotient"),
        F.desc("votes_per_party"),
        F.asc("political_party_norm"),
        F.asc_nulls_first("autonomic_region_name"),
    ]


def seat_ranking(quotients: DataFrame) -> DataFrame:
    """The quotients that win a seat, ranked within the province."""
    return top_k_by_column(quotients, ["province_name"], quotient_order(), "total_seats")


def dhondt_winners(ranked: DataFrame) -> DataFrame:
    """Seats of each party that won any."""
    return ranked.groupBy(*PARTY_KEY).agg(F.count("*").alias("seats"))


def candidates(valid: DataFrame) -> DataFrame:
    """Every party over the threshold, once."""
    return valid.select(*PARTY_KEY).distinct()


def seats_with_zero(all_candidates: DataFrame, winners: DataFrame) -> DataFrame:
    """Candidates with their seats, 0 where none were won.

    The join treats NULL keys as equal; otherwise a party of an unknown region would
    lose its seats here.
    """
    c, w = all_candidates.alias("c"), winners.alias("w")
    same = [F.col(f"c.{name}").eqNullSafe(F.col(f"w.{name}")) for name in PARTY_KEY]
    return c.join(w, same, "left").select(
        *(F.col(f"c.{name}").alias(name) for name in PARTY_KEY),
        F.coalesce("w.seats", F.lit(0).cast("bigint")).alias("seats"),
    )


def allocate_seats(
    votes: DataFrame, seats_reference: DataFrame, threshold: float = THRESHOLD, blank: str = BLANK
) -> DataFrame:
    """Seats per region, province and party over the threshold.

    Same result as ranking all quotients (``dhondt_quotients`` .. ``seats_with_zero``)
    with less work and one shuffle by province. With V votes and n seats in a province, a
    quotient of at least V/n is always among the n highest, as no more than n quotients
    are that large. So each party has ``votes * n div V`` seats for certain; only the
    remaining seats, fewer than there are parties, are ranked, over as many divisors per
    party. The rows of a province do not grow with its seats.

    ``votes`` has one row per region, province and party, ``seats_reference`` one per
    province. A province without seats, or not in the reference, reports 0 for its parties.
    """
    joined = valid_votes(votes, threshold, blank).join(
        seats_reference.select("province_name", "total_seats"), "province_name", "left"
    )
    contest = joined.select(
        *PARTY_KEY,
        "votes_per_party",
        F.greatest(F.coalesce("total_seats", F.lit(0)), F.lit(0)).cast("bigint").alias("total_seats"),
    )
    contenders, others = _split_contenders(contest)
    return _share_out(contenders).unionByName(others)


def _split_contenders(contest: DataFrame, salts: int = 16) -> tuple[DataFrame, DataFrame]:
    """Parties that can win a seat, and the rest with none.

    All parties ahead of a party in its province, or in its salt of it, win at least as
    many seats as it does: their quotients beat its own, divisor by divisor. So the p-th
    party of a salt wins at most ``n div p`` seats (``_cap``), and none beyond the n-th.
    At most salts * n contenders remain, with about n * ln(n) quotients per salt.
    """
    by_votes = Window.partitionBy("province_name", "_salt").orderBy(
        F.desc("votes_per_party"), F.asc("political_party_norm"), F.asc_nulls_first("autonomic_region_name")
    )
    ranked = contest.withColumn("_salt", F.pmod(F.xxhash64(*PARTY_KEY), F.lit(salts))).withColumn(
        "_position", F.row_number().over(by_votes)
    )
    contenders = (
        ranked.filter(F.col("_position") <= F.col("total_seats"))
        .withColumn("_cap", F.expr("total_seats div _position"))
        .drop("_salt", "_position")
    )
    others = ranked.filter(F.col("_position") > F.col("total_seats")).select(
        *PARTY_KEY, F.lit(0).cast("bigint").alias("seats")
    )
    return contenders, others


def _share_out(contest: DataFrame) -> DataFrame:
    province = Window.partitionBy("province_name")
    ranking = province.orderBy(*quotient_order())
    # 18 digits each keep the product within a 38-digit decimal, where bigint could overflow.
    certain = F.expr(
        "case when _votes > 0 then (cast(votes_per_party as decimal(18,0)) * cast(total_seats as decimal(18,0)))"
        " div cast(_votes as decimal(18,0)) else 0L end"
    )
    first, last = F.col("_certain") + 1, F.least(F.col("_certain") + F.col("_open"), "_cap")
    divisors = F.when(first <= last, F.sequence(first, last))
    ranked = (
        contest.withColumn("_votes", F.sum("votes_per_party").over(province))
        .withColumn("_certain", certain)
        .withColumn("_open", F.col("total_seats") - F.sum("_certain").over(province))
        .withColumn("divisor", F.explode_outer(divisors))
        .withColumn("quotient", F.col("votes_per_party") / F.col("divisor"))
        .withColumn("ranking", F.row_number().over(ranking))
    )
    won = F.count_if(F.col("divisor").isNotNull() & (F.col("ranking") <= F.col("_open")))
    return ranked.groupBy(*PARTY_KEY).agg((F.first("_certain") + won).alias("seats"))


def seat_messages(seats: DataFrame, at: Column | None = None) -> DataFrame:
    """Key and JSON value of each seat count; ``at`` replaces the current time."""
    document = seats.select(
        seat_doc_id().alias("doc_id"),
        "province_name",
        F.col("political_party_norm").alias("political_party"),
        "autonomic_region_name",
        "seats",
        (F.current_timestamp() if at is None else at).alias("updated_at"),
    )
    return document.select(
        F.col("doc_id").alias("key"), F.to_json(F.struct(*document.columns), JSON_OPTIONS).alias("value")
    )


def seat_tombstones(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Messages with a NULL value for seat documents that are no longer reported.

    A party that fell below the threshold would otherwise keep its last count for ever.
    """
    gone = previous.select(seat_doc_id().alias("key")).join(
        current.select(seat_doc_id().alias("key")), "key", "left_anti"
    )
    return gone.distinct().select("key", F.lit(None).cast("string").alias("value"))
