"""Positions within groups of any size, and what is built on them.

A running sum over a whole group needs a window that sorts the group in one task. Here a
group is cut into 256 buckets by the first two digits of a hash; a window runs inside each
bucket, and the bucket totals, at most 256 rows per group, are summed up before it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from escrutinio.operators.joins import broadcast_if_small
from escrutinio.operators.materialize import materialize

# Of [0, total) at least this many bins, so that the lookups of one large group spread.
_MIN_BINS = 64


def _no_null(total: Column, kind: str) -> Column:
    return F.coalesce(total.try_cast(kind), F.raise_error(F.lit("a sum of weights is too large")).cast(kind))


def _whole_sum(weight: Column, kind: str) -> Column:
    """The sum of weights that are not NULL; one that does not fit is an error in both ANSI modes."""
    return _no_null(F.try_sum(weight), kind)


def weighted_ranges(df: DataFrame, groups: Sequence[str], item: str, weight: Column) -> DataFrame:
    """Distinct items of each group with their weights laid end to end as [lo, hi).

    Copies of an item add up. Items follow each other by the md5 of their text. Adds
    ``total``, the weight of the group, and ``items``, its number of items; items without
    a positive weight and NULL items drop out. Fractional weights are kept to 16 decimals and
    summed exactly, so that neighbouring ranges meet; a smaller positive weight, or one of
    10**11 or more, is an error and not lost.
    """
    fractional = isinstance(df.select(weight).schema[0].dataType, FractionalType)
    exact = "decimal(37,16)" if fractional else "bigint"
    positive = weight > 0
    weight_type = "decimal(27,16)" if fractional else "bigint"
    # Without ANSI mode a cast gives NULL where it does not fit, and a sum wraps around.
    given, weight = weight, weight.try_cast(weight_type)
    if fractional:
        too_small = F.raise_error(F.lit("a positive weight is below 10**-16")).cast(weight_type)
        too_large = F.raise_error(F.lit("a weight is 10**11 or more")).cast(weight_type)
        weight = F.when(given >= 1e11, too_large).when(positive & (weight == 0), too_small).otherwise(weight)
    digest = F.md5(F.col(item).cast("string"))
    items = (
        df.filter(positive & F.col(item).isNotNull())
        .groupBy(*groups, item)
        .agg(_whole_sum(weight, exact).alias("weight"))
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.substring("_digest", 1, 2))
    )
    # The constant stands for "no groups": the window below then sees at most 256 rows.
    whole = [*groups, F.lit(1)]
    buckets = items.groupBy(*groups, "_bucket").agg(
        _whole_sum(F.col("weight"), exact).alias("_sum"), F.count("*").alias("_count")
    )
    before = Window.partitionBy(*whole).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        *(F.col(g).alias(f"_g_{g}") for g in groups),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast(exact).alias("_offset"),
        _no_null(F.try_sum("_sum").over(Window.partitionBy(*whole)), exact).alias("total"),
        F.sum("_count").over(Window.partitionBy(*whole)).alias("items"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    # Plain equality would filter one branch by "item is not NULL" only, and the input be computed twice.
    same.append(F.col("_bucket").eqNullSafe(F.col("_b")))
    inside = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy("_digest", item)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        items.withColumn("_running", F.sum("weight").over(inside).cast(exact))
        .join(offsets, same)
        .withColumn("hi", (F.col("_offset") + F.col("_running")).cast(exact))
        .withColumn("lo", (F.col("hi") - F.col("weight")).cast(exact))
        .select(*groups, item, "weight", "lo", "hi", "total", "items")
    )


def pick(df: DataFrame, number: Column, ranges: DataFrame, groups: Sequence[str], item: str, output: str) -> DataFrame:
    """The item whose range holds ``number`` (in [0, 1)) times the group's total, as ``output``.

    The range condition becomes an equality on bins: [0, total) is cut into as many bins
    as the group has items (64 at least), a range is repeated for each bin it touches, in
    all at most twice the items plus 64 rows per group, and a row looks into the one bin
    of its number, which on average holds no more than two ranges. Rows of an unknown
    group get NULL.

    Positions are doubles: a group's total of 2**53 or more is an error, as neighbouring
    ranges could not be told apart. The binned ranges are written first, by a job that runs
    while the query is built, being used more than once. ``df`` is shuffled, by
    group and bin, only if they are too large for Spark to broadcast.
    """

    def bin_of(position: Column, total: Column, items: Column) -> Column:
        # Non-decreasing in position, so a range's bins cover all positions inside it.
        bins = F.greatest(items, F.lit(_MIN_BINS))
        return F.floor(position * bins / total).cast("bigint")

    lo, hi, total, items = (F.col(name).cast("double") for name in ("lo", "hi", "total", "items"))
    too_large = F.raise_error(F.lit("a total of 2**53 or more cannot be drawn from")).cast("double")
    total = F.when(total < 2.0**53, total).otherwise(too_large)
    binned = materialize(
        ranges.select(
            *(F.col(g).alias(f"_g_{g}") for g in groups),
            F.col(item).alias(output),
            lo.alias("_lo"),
            hi.alias("_hi"),
            total.alias("_total"),
            items.alias("_items"),
            F.explode(F.sequence(bin_of(lo, total, items), bin_of(hi, total, items))).alias("_range_bin"),
        ),
        "ranges",
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups]
    if groups:
        sizes = binned.groupBy(*(f"_g_{g}" for g in groups)).agg(
            F.max("_total").alias("_total"), F.max("_items").alias("_items")
        )
        placed = df.join(broadcast_if_small(sizes), same, "left").drop(*(f"_g_{g}" for g in groups))
    else:
        placed = df.withColumn("_total", binned.agg(F.max("_total")).scalar()).withColumn(
            "_items", binned.agg(F.max("_items")).scalar()
        )
    # Rows of an unknown group match nothing; they get a bin all the same, to be spread too.
    spread = F.floor(number * _MIN_BINS).cast("bigint")
    placed = placed.withColumn("_position", number * F.col("_total")).withColumn(
        "_bin", F.coalesce(bin_of(F.col("_position"), F.col("_total"), F.col("_items")), spread)
    )
    inside = [
        *same,
        F.col("_bin") == F.col("_range_bin"),
        F.col("_position") >= F.col("_lo"),
        F.col("_position") < F.col("_hi"),
    ]
    return placed.join(binned.drop("_total", "_items"), inside, "left").select(*df.columns, output)


def chunked_lists(
    df: DataFrame, groups: Sequence[str], value: Column, order: str, output: str, chunk_size: int
) -> DataFrame:
    """``value`` of each group in lists of at most ``chunk_size``, numbered from 0.

    The lists follow ``order`` within and across chunks. Rows are dealt by ranges of
    (groups, order) and written once, by a job that runs while the query is built; a row's
    position is its place in its range plus the rows of its group in the ranges before, so
    neither a large group nor many rows with equal ``order`` meet in one list.
    """
    if chunk_size < 1:
        raise ValueError("a chunk has one row at least")
    tie = F.xxhash64(F.col(order), value)
    dealt = df.select(*groups, F.col(order).alias("_order"), value.alias("_value"), tie.alias("_tie"))
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartitionByRange(parts, *groups, "_order", "_tie").withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "dealt")
    before = Window.partitionBy(*groups, F.lit(1)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*groups, F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = offsets.select(*(F.col(g).alias(f"_g_{g}") for g in groups), "_p", "_offset")
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups] + [F.col("_part").eqNullSafe(F.col("_p"))]
    inside = Window.partitionBy(*groups, "_part").orderBy("_order", "_tie")
    position = F.col("_offset") + F.row_number().over(inside) - 1
    entry = F.struct(F.col("_position").alias("position"), F.col("_value").alias("value"))
    return (
        dealt.join(offsets, same)
        .withColumn("_position", position)
        .withColumn("chunk", F.expr(f"_position div {chunk_size}"))
        .groupBy(*groups, "chunk")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(*groups, "chunk", F.col("_entries.value").alias(output))
    )
