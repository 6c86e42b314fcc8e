"""Exact dedup by skew-safe combining of digest groups.

Texts are equal when they are identical after each run of white space becomes one space;
a null text counts as empty. Contents are compared in full at every stage, never by
digest alone:

1. Spark's map-side aggregate removes the copies within a task.
2. Groups of (digest, content, salt) are merged. A group of any size reaches a task as at
   most one row per map task.
3. Digests with several salt winners are combined per content; the others, nearly all,
   have but one content and are not shuffled again.

Documents then find their winner by digest and salt: each digest's winner is given to the
salts that the digest has, so that the rows of a large group meet it in ``salts`` tasks.
Contents that share a digest, should there ever be any, are told apart by a second join on
the content.

Cases: an empty table gives an empty result. Rows that repeat a doc_id and a content all
count in ``group_size``, and one of them is kept. A null doc_id wins only over other null
ids; ``keep_id`` is null then. Further columns play no part, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from escrutinio.llm.common import SPACE, quoted, written
from escrutinio.operators.joins import broadcast_if_small

SALTS = 16  # 63 at most, for each is a bit of a long


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def digest(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def _contents(docs: DataFrame, salts: int, text: str, doc_id: str) -> DataFrame:
    if not 0 < salts < 64:
        raise ValueError("from 1 to 63 salts")
    contents = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("content"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    return contents.withColumns({"text_sha256": digest(F.col("content")), "salt": salt})


def _salted(contents: DataFrame) -> DataFrame:
    return contents.groupBy("text_sha256", "content", "salt").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _combined(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("parts"),
        F.expr("bit_or(shiftleft(1L, salt))").alias("salts"),
    )


def _classes(docs: DataFrame, text: str, doc_id: str, salts: int) -> tuple[DataFrame, DataFrame]:
    """Winner and size per digest, and per content where a digest has several contents."""
    salted = written(_salted(_contents(docs, salts, text, doc_id)), "exact-salted")  # digest, content and salt are unique in it
    per_digest = written(_combined(salted, "text_sha256"), "exact-digests")
    several = broadcast_if_small(per_digest.filter("parts > 1").select("text_sha256"))
    compared = _combined(salted.join(several, "text_sha256", "left_semi"), "text_sha256", "content")
    compared = compared.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("contents"))
    classes = per_digest.join(compared, "text_sha256", "left").select(
        "text_sha256", "keep_id", "group_size", "salts", F.coalesce("contents", F.lit(1)).alias("contents")
    )
    classes = written(classes, "exact-classes")
    shared = classes.filter("contents > 1").select("text_sha256")
    by_content = _combined(salted.join(shared, "text_sha256", "left_semi"), "text_sha256", "content").drop("parts", "salts")
    return classes, by_content


def _matched(rows: DataFrame, classes: DataFrame, by_content: DataFrame, salts: int) -> DataFrame:
    """``rows`` (with text_sha256, salt and content) with keep_id and group_size of their class."""
    present = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.getbit("salts", s) == 1)
    alone = classes.filter("contents = 1").select("text_sha256", "keep_id", "group_size", F.explode(present).alias("salt"))
    found = rows.drop("content").join(alone, ["text_sha256", "salt"])
    if classes.filter("contents > 1").isEmpty():
        return found
    told = rows.join(by_content, ["text_sha256", "content"]).drop("content")
    return found.unionByName(told)


def mark(
    docs: DataFrame, salts: int = SALTS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    classes, by_content = _classes(docs, text, doc_id, salts)
    found = _matched(_contents(docs, salts, text, doc_id), classes, by_content, salts)
    copies = Window.partitionBy("text_sha256", "salt", "id_key").orderBy("keep_id")
    found = found.withColumn("id_key", _id_key(F.col("doc_id"))).withColumn("copy", F.row_number().over(copies))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, salts: int = SALTS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    kept = mark(docs, salts, text, doc_id).filter("kept")
    kept = kept.select(F.col("text_sha256").alias("_sha"), _id_key(F.col("doc_id")).alias("_key"))
    rows = docs.select(
        F.struct(*(quoted(n) for n in docs.columns)).alias("_row"),
        digest(normalised(F.col(text))).alias("_sha"),
        _id_key(F.col(doc_id)).alias("_key"),
    )
    first = Window.partitionBy("_sha", "_key").orderBy("_row")
    joined = rows.join(kept, ["_sha", "_key"]).withColumn("_copy", F.row_number().over(first))
    return joined.filter("_copy = 1").select("_row.*")
