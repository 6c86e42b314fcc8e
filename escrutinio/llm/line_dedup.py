"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line with white space stripped at both ends and A-Z lowered; keys of
at least ``min_chars`` code points count. A run is a table (key, n_docs, max_doc) sorted
by key: the number of documents with that key so far and the largest doc_id among them. Each
batch of documents is merged with the runs: keys that no run holds, found by an anti-join, go
into the batch's own run as they are, keys that one holds go there on top of what it has. The
run of a batch starts at level 0; when a level has ``fanout`` runs, they are compacted into one
of the next level, so a key is rewritten once per level. Counts only grow, so of a key's rows
in several runs the largest is the newest.

After the last batch, a document loses the lines whose key the runs hold as repeated, unless it
has the largest doc_id. Keys of 1/``LARGE_SHARE`` of all lines or more, of which there can be no
more than ``LARGE_SHARE``, meet their lines by broadcast, all others by a join on the key.

Keys are 128-bit hashes, so two of 10**12 different lines meet with a chance of 10**-15.

Cases: a null or empty text is one empty line. Rows that repeat a doc_id are one document for
the count, and all of them keep the line if theirs is the largest doc_id. Rows without doc_id
count as documents of their own, and lose a repeated line if a row with an id has it. An empty
table gives an empty result. Further columns of the input play no part.
"""

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm.common import shuffles, written
from escrutinio.llm.text import blocks
from escrutinio.session import scratch_dir

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 4
#: Batches of a whole table; raise it with the input, as a batch's distinct keys are joined at once.
BATCHES = 4
LARGE_SHARE = 4096


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key hash of each line; None for lines too short to count."""
    keys = []
    for line in text.split(b"\n"):
        key = line.strip(b" \t\n\x0b\x0c\r")
        if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars):
            keys.append(None)
        else:
            keys.append(xxhash.xxh3_128_digest(key.lower()))
    return keys


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, key) for each row and distinct key of its lines; ``row`` tells rows without doc_id apart."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            keys = [sorted(set(line_keys(t, min_chars)) - {None}) for t in _texts(batch)]
            place = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name).take(pa.array(place)) for name in ("doc_id", "row")),
                    pa.array([k for ks in keys for k in ks], pa.binary()),
                ],
                names=["doc_id", "row", "key"],
            )

    return docs.select("doc_id", "text", "row").mapInArrow(rows, "doc_id bigint, row bigint, key binary")


class LineRuns:
    """Levelled runs of line keys below spark.checkpoint.dir."""

    def __init__(self, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("a level merges two runs at least")
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _add_run(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(written(_sorted(run), f"line-run-{level}"))
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._add_run(_newest(full), level + 1)

    def add(self, batch_lines: DataFrame) -> None:
        """Merge the lines (doc_id, key) of a batch of documents with the runs, as a run of their own.

        A document must not come back in a later batch: it would be counted again.
        """
        documents = F.count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull())
        own = batch_lines.groupBy("key").agg(documents.alias("n_docs"), F.max("doc_id").alias("max_doc"))
        if self.runs():
            held = _newest(self.runs()).select("key", F.col("n_docs").alias("_n"), F.col("max_doc").alias("_max"))
            seen = own.join(held, "key").select(
                "key", (F.col("n_docs") + F.col("_n")).alias("n_docs"), F.greatest("max_doc", "_max").alias("max_doc")
            )
            own = self.fresh(own).unionByName(seen)
        self._add_run(own, 0)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys that ``min_docs`` documents or more have, over all runs."""
        return _newest(self.runs()).filter(F.col("n_docs") >= min_docs)

    def fresh(self, batch_lines: DataFrame) -> DataFrame:
        """The rows of a batch whose key no run holds."""
        if not self.runs():
            return batch_lines
        return batch_lines.join(reduce(DataFrame.unionByName, self.runs()).select("key"), "key", "left_anti")


def _sorted(run: DataFrame) -> DataFrame:
    return run.repartition(shuffles(run.sparkSession), "key").sortWithinPartitions("key")


def _newest(runs: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, runs)
    return rows.groupBy("key").agg(F.max("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))


def _batches(docs: DataFrame, count: int, min_chars: int) -> tuple[DataFrame, list[DataFrame]]:
    """The lines of ``docs``, written once, and the batches of them; all rows of a doc_id are in one."""
    number = F.pmod(F.xxhash64("doc_id", "row"), F.lit(count)).cast("int")
    path = scratch_dir(docs.sparkSession, "llm-lines")
    found = lines(docs, min_chars).withColumn("batch", number)
    found.write.partitionBy("batch").parquet(path)
    table = docs.sparkSession.read.schema(found.schema).parquet(path)
    return table, [table.filter(F.col("batch") == k) for k in range(count)]


def _lost(table: DataFrame, repeated: DataFrame) -> DataFrame:
    """(doc_id, row, key) of the lines that go."""
    repeated = written(repeated, "repeated-lines")
    total = table.count()
    large = repeated.filter(F.col("n_docs") * LARGE_SHARE >= total).select("key", F.col("max_doc").alias("_max"), F.lit(True).alias("_large"))
    small = repeated.filter(F.col("n_docs") * LARGE_SHARE < total)
    tagged = table.drop("batch").join(F.broadcast(large), "key", "left")
    of_large = tagged.filter("_large").select("doc_id", "row", "key", F.col("_max").alias("max_doc"))
    of_small = tagged.filter("_large IS NULL").select("doc_id", "row", "key").join(small.select("key", "max_doc"), "key")
    held = of_large.unionByName(of_small.select(of_large.columns))
    return held.filter(~F.col("doc_id").eqNullSafe(F.col("max_doc"))).drop("max_doc")


def dedup(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """doc_id, text (lines that stay), n_lines, n_dropped and kept_sha256 of every row.

    The documents go through the runs in ``batches`` batches, as they would when they arrive
    over time.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs = docs.withColumn("row", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)))
    table, parts = _batches(docs, batches, min_chars)
    runs = LineRuns(fanout)
    for part in parts:
        runs.add(part)
    per_doc = _lost(table, runs.repeated(min_docs)).groupBy("doc_id", "row").agg(F.collect_set("key").alias("lost"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_doc_id", "row": "_row"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("row") == F.col("_row"))
    joined = docs.join(per_doc, same, "left").select("doc_id", "text", "lost")

    def rewrite(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(found):
            kept, totals, dropped, digests = [], [], [], []
            for text, gone in zip(_texts(batch), batch.column("lost").to_pylist(), strict=True):
                rest = text.split(b"\n")
                totals.append(len(rest))
                if gone:
                    gone = set(gone)
                    rest = [line for line, key in zip(rest, line_keys(text, min_chars), strict=True) if key not in gone]
                dropped.append(totals[-1] - len(rest))
                kept.append(b"\n".join(rest))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(totals, pa.int64()),
                    pa.array(dropped, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"],
            )

    return joined.mapInArrow(
        rewrite, "doc_id bigint, text string, n_lines bigint, n_dropped bigint, kept_sha256 string"
    )
