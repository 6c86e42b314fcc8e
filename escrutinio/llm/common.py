"""Spark helpers of the operators: shipping the code, written tables, folds."""

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from escrutinio.operators.materialize import materialize

#: White space of every operator, as a character class.
SPACE = r"[\x20\x09-\x0D]"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="escrutinio-code-")  # the driver serves it until it ends
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/escrutinio", "zip", root, "escrutinio"))
        _SHIPPED.add(context.applicationId)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its plain name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below spark.checkpoint.dir and read back; see ``materialize``."""
    return materialize(df, f"llm-{purpose}")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark deletes the shuffle files of a query as the query ends, not when the driver's memory is cleaned."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffles(spark: SparkSession) -> int:
    """Number of partitions the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """The fold of the held-out rows: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
