"""Tables in hash buckets, of which a change rewrites only the buckets it touches.

The buckets are partitions of a Parquet table, overwritten one by one. What a change makes of
its buckets is first written as a version of its own beside the table, complete or not seen,
and then put in their place. After a failure in between, the same change put again finds that
version and only puts it in place; nothing is read from a half-replaced table.

The number of buckets is fixed when a table is first written and kept in its folder. A
micro-batch rewrites at most as many buckets as it has keys: with k changed keys in B buckets
B * (1 - (1 - 1/B)**k) of them on average, so choose B well above the keys that change at a
time, and so that a bucket fills a file of some 100 MB. A reader that lists the folder while
buckets are replaced can miss one of them for that moment; one that must not reads the
versions of ``sinks.versions``. The files have Bloom filters on the key.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from escrutinio.folders import exists, make_file, make_folder, names, remove_folder
from escrutinio.operators.upsert import upsert_latest
from escrutinio.sinks.versions import drop_old_versions, read_version, versions, write_version

BUCKET = "bucket"
BUCKETS = 64
#: Keys that a lookup gives to the scan itself, which compares as many with the files' Bloom filters.
FEW_KEYS = 10
_MARKER = "_buckets="
_KEPT = "_kept"


@dataclass(frozen=True)
class BucketTable:
    """A table at ``path`` with the columns of ``schema``, bucketed by the columns ``by``."""

    spark: SparkSession
    path: str
    schema: StructType
    by: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def pending(self) -> str:
        """Where the buckets of the last change are kept."""
        return f"{self.path}_pending"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(name) for name in self.by)), F.lit(self.buckets)).cast("int")

    def _check_buckets(self) -> None:
        marks = [name for name in names(self.spark, self.path) if name.startswith(_MARKER)]
        if marks and marks != [f"{_MARKER}{self.buckets}"]:
            raise ValueError(f"{self.path} was written with {marks[0].removeprefix(_MARKER)} buckets, not {self.buckets}")

    def _table(self) -> DataFrame:
        """All rows with their bucket; Spark reads only the buckets a filter names."""
        self._check_buckets()
        schema = StructType([*self.schema.fields, StructField(BUCKET, IntegerType(), True)])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._table().select(*self.schema.names)

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets of the changed rows, ``buckets`` numbers at most."""
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())

    def read_buckets(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets; the others are pruned."""
        return self._table().filter(F.col(BUCKET).isin(*buckets)).select(*self.schema.names)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows whose ``by`` columns are among the rows of ``keys``: their buckets are read and no others.

        Up to ``FEW_KEYS`` keys of one column go to the scan as a filter; row groups whose Bloom
        filter has none of them are not read. More keys are joined.
        """
        wanted = keys.select(*self.by).distinct()
        if len(self.by) == 1:
            few = [r[0] for r in wanted.limit(FEW_KEYS + 1).collect()]
            if len(few) <= FEW_KEYS:
                key, known = F.col(self.by[0]), [k for k in few if k is not None]
                same = key.isin(known) if known else F.lit(False)
                if len(known) < len(few):
                    same = same | key.isNull()
                return self.read_buckets(self.touched(wanted)).filter(same)
        found, asked = self.read_buckets(self.touched(wanted)).alias("t"), wanted.alias("k")
        same = [F.col(f"t.{name}").eqNullSafe(F.col(f"k.{name}")) for name in self.by]
        return found.join(asked, same, "left_semi")

    def replace(self, rows: DataFrame, touched: Sequence[int], version: int) -> None:
        """Put ``rows`` in place of the buckets ``touched``, which hold all of them.

        A change already kept under ``version`` is put in place again and ``rows`` not looked at.
        """
        if version not in versions(self.spark, self.pending):
            kept = rows.select(*self.schema.names, self.bucket().alias(BUCKET), F.lit(True).alias(_KEPT))
            # A row for each touched bucket, so that those which lost all their rows are known too.
            marks = self.spark.createDataFrame([(b, False) for b in touched], f"{BUCKET} int, {_KEPT} boolean")
            kept = kept.repartition(max(1, len(touched)), BUCKET)
            write_version(kept.unionByName(marks, allowMissingColumns=True), self.pending, version)
        self._put(version)

    def _put(self, version: int) -> None:
        self._check_buckets()
        make_folder(self.spark, self.path)
        make_file(self.spark, f"{self.path}/{_MARKER}{self.buckets}")
        fields = [StructField(BUCKET, IntegerType(), True), StructField(_KEPT, BooleanType(), True)]
        pending = read_version(self.spark, self.pending, version, StructType([*self.schema.fields, *fields]))
        full = pending.groupBy(BUCKET).agg(F.max(_KEPT).alias("full")).collect()
        kept = pending.filter(_KEPT).drop(_KEPT).repartition(max(1, len(full)), BUCKET)
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
        for name in self.by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(self.path)
        for row in full:  # a touched bucket each
            if not row.full:
                remove_folder(self.spark, f"{self.path}/{BUCKET}={row[BUCKET]}")
        drop_old_versions(self.spark, self.pending, 1)

    def upsert(self, changes: DataFrame, order: Sequence[str], value: str, version: int) -> None:
        """``upsert_latest`` of ``changes`` into the buckets of their keys; ``by`` is one column, the key."""
        if version in versions(self.spark, self.pending):
            self._put(version)
            return
        (key,) = self.by
        touched = self.touched(changes)
        if touched:
            merged = upsert_latest(self.read_buckets(touched), changes.select(*self.schema.names), key, order, value)
            self.replace(merged, touched, version)
