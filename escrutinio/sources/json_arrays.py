"""Files that are one JSON array of objects, read by many tasks.

A file is cut at closing braces, wherever they stand, and so its parts go to as many tasks as
its bytes ask for. Which of them close a record follows from what is before them: the braces
still open, and whether a string is. Each part knows what it adds to both, whichever way it
begins; sums over the parts of a split, and then over the splits of a file, one row each, tell
for every part how it begins. The parts of a record are put together by its number, those of a
record that a split cuts like all others.

The text must be a valid array. Elements that are not objects are not records and go; a record
has to fit in a row.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from escrutinio.operators.materialize import materialize

_SPLIT = ["file", "block"]


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """The text before each closing brace, with its place in its file and what it adds.

    ``quotes`` are the quotes that open or close a string; ``open0`` and ``open1`` the opening
    braces outside strings if the part begins outside or inside of one.
    """
    text = spark.read.option("lineSep", "}").text(path)
    parts = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # ascends within a split
        "value",
    )
    pieces = F.split(F.regexp_replace("value", r"\\.", ""), '"')  # without escapes, by strings

    def opened(begins: int) -> Column:
        outside = F.filter(pieces, lambda _, i: i % 2 == begins)
        return F.aggregate(outside, F.lit(0), lambda n, p: n + F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit(""))))

    return parts.select("*", (F.size(pieces) - 1).alias("quotes"), opened(0).alias("open0"), opened(1).alias("open1"))


def _closes(begins: Column) -> Column:
    """1 if the brace behind the part is outside strings."""
    return F.when((begins + F.col("quotes")) % 2 == 0, 1).otherwise(0)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record (its number in the file) and value, the text of each object of the arrays.

    The parts are written once, by a job that runs while the query is built.
    """
    parts = materialize(_parts(spark, path), "array-parts")
    before = Window.partitionBy(*_SPLIT).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_q", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    for way in (0, 1):  # if the split begins outside or inside a string
        inside = (F.col("_q") + way) % 2
        opened = F.when(inside == 0, F.col("open0")).otherwise(F.col("open1"))
        parts = parts.withColumn(f"_close{way}", _closes(inside)).withColumn(f"_change{way}", opened - _closes(inside))
    splits = parts.groupBy(*_SPLIT).agg(
        F.sum("quotes").alias("_quotes"), *(F.sum(f"_change{way}").alias(f"_depth{way}") for way in (0, 1))
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_way", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2)
    added = F.when(F.col("_way") == 0, F.col("_depth0")).otherwise(F.col("_depth1"))
    splits = splits.withColumn("_depth", F.coalesce(F.sum(added).over(earlier), F.lit(0)))
    splits = splits.select(*(F.col(n).alias(f"_{n}") for n in _SPLIT), "_way", "_depth")
    same = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in _SPLIT]
    change, closes = (F.when(F.col("_way") == 0, F.col(f"{n}0")).otherwise(F.col(f"{n}1")) for n in ("_change", "_close"))
    so_far = Window.partitionBy(*_SPLIT).orderBy("place")
    placed = parts.join(splits, same).withColumn("_change", change).withColumn("_closes", closes)
    placed = placed.withColumn("_end", F.col("_depth") + F.sum("_change").over(so_far))
    # What is left behind the last record closes nothing: the depth would fall below the array's.
    placed = placed.filter("_end >= 0").withColumn("_ends", F.when(F.col("_end") == 0, F.col("_closes")).otherwise(0))
    placed = placed.withColumn("_number", F.coalesce(F.sum("_ends").over(before), F.lit(0)))
    counts = placed.groupBy(*_SPLIT).agg(F.sum("_ends").alias("_n"))
    counts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    counts = counts.select(*(F.col(n).alias(f"_c_{n}") for n in _SPLIT), "_first")
    numbered = placed.join(counts, [F.col(n).eqNullSafe(F.col(f"_c_{n}")) for n in _SPLIT])
    entry = F.struct("block", "place", "value")
    records = numbered.groupBy("file", (F.col("_first") + F.col("_number")).alias("record")).agg(
        F.array_sort(F.collect_list(entry)).alias("_parts"), F.max("_ends").alias("_whole")
    )
    records = records.filter("_whole = 1")  # not what stands behind the last one
    text = F.concat(F.array_join(F.col("_parts.value"), "}"), F.lit("}"))
    # In front of a record stand the bracket of the array, commas and elements that are no objects.
    return records.select("file", "record", F.regexp_replace(text, r'^(?:"(?:\\.|[^"\\])*"|[^{"])*', "").alias("value"))


def read_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects of the arrays by ``schema``, as the multi-line reader gives them.

    But for the spelling of numbers that the schema reads as text: 0.00045 comes as 4.5E-4.
    """
    return array_records(spark, path).select(F.from_json("value", schema).alias("record")).select("record.*")
