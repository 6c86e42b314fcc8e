"""Packing along a space-filling curve.

Each document's token ids are hashed into a vector, which a fixed random projection brings
to a few dimensions; the Hilbert key of that point orders the documents, so that
neighbours on the curve use similar tokens. A range sort by (key, doc_id) gives each
document its place in one long stream, and the stream is cut every ``length`` ids: each
sequence is full, and the rest at the very end becomes sequences of powers of two, so
there is no padding at all. Equal documents have equal keys; doc_id splits them.

Cases: null and empty texts are the end id alone. Rows that repeat a doc_id are packed
each; rows without one come first among equal keys. An empty table gives no piece.
Further columns play no part.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm import tokens
from escrutinio.llm.common import shuffles, written
from escrutinio.llm.text import blocks, mix

LENGTH = 2048
DIMENSIONS = 4
BITS = 12
_FEATURES = 1024

PIECE = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, sequence_length bigint"
)


def projection(vocabulary: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The point of each token: a hashed feature with a sign, times a random direction."""
    h = mix(np.arange(1, vocabulary + 1, dtype=np.uint64))
    directions = np.random.default_rng(7).standard_normal((_FEATURES, dimensions)).astype(np.float32)
    sign = np.where(h >> np.uint64(63), 1, -1).astype(np.float32)
    return directions[(h % np.uint64(_FEATURES)).astype(np.int64)] * sign[:, None]


def grid(sums: np.ndarray, counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of the mean points; the arc tangent keeps outliers inside the grid."""
    means = sums / np.maximum(counts, 1)[:, None]
    unit = np.arctan(3.0 * means) / np.pi + 0.5
    return np.clip((unit * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each cell (row of coordinates) on the Hilbert curve.

    Undoes, bit by bit from the top, the reflections and swaps of the curve's sub-cubes,
    then reads the Gray code of the remaining coordinates.
    """
    axes = [cells[:, i].astype(np.int64).copy() for i in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(len(axes)):
            upper = (axes[axis] >> level) & 1 == 1
            swapped = np.where(upper, 0, (axes[0] ^ axes[axis]) & low)
            axes[0] ^= np.where(upper, low, swapped)
            axes[axis] ^= swapped
    for axis in range(1, len(axes)):
        axes[axis] ^= axes[axis - 1]
    turned = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turned) >> level) & 1)
    return key


def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(row, doc_id, ids, n, key) of each row; ``row`` numbers the rows of the written table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.opened(path)
        points = projection(tokenizer.size)
        end = np.array([end_id], dtype=tokenizer.dtype).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in blocks(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids = [i + end for i in tokenizer.encode(texts)]
            counts = np.array([len(i) for i in ids]) // tokenizer.dtype.itemsize
            stream = np.frombuffer(b"".join(ids), dtype=tokenizer.dtype)
            sums = np.add.reduceat(points[stream], np.cumsum(counts) - counts, axis=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(batch))),
                    batch.column("doc_id"),
                    pa.array(ids, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(hilbert(grid(sums, counts))),
                ],
                names=["row", "doc_id", "ids", "n", "key"],
            )
            row += len(batch)

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(rows, "row bigint, doc_id bigint, ids binary, n bigint, key bigint")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids before each row within its partition, in the partition's order."""
    shard, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n"), pa.array(np.full(len(n), shard), pa.int64()), pa.array(ends - n)],
            names=["row", "n", "shard", "local"],
        )
        before = int(ends[-1]) if len(n) else before


def shard_bases(rows: DataFrame) -> tuple[DataFrame, int]:
    """Ids before each shard, a row per shuffle partition, and the number of all ids."""
    totals = sorted(tuple(r) for r in rows.groupBy("shard").agg(F.sum("n")).collect())
    bases, before = [], 0
    for shard, n in totals:
        bases.append((shard, before))
        before += n
    return rows.sparkSession.createDataFrame(bases, "shard bigint, base bigint"), before


def cuts(start: int, stop: int, total: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Pieces of the stream's [start, stop) as (from, to, sequence, sequence start)."""
    full = total // length * length
    at = start
    while at < stop:
        if at < full:
            sequence, first, size = at // length, at // length * length, length
        else:
            sequence, first, rest = full // length, full, total - full
            size = 1 << (rest.bit_length() - 1)
            while at >= first + size:
                first, rest, sequence = first + size, rest - size, sequence + 1
                size = 1 << (rest.bit_length() - 1)
        end = min(stop, first + size)
        yield at, end, sequence, first, size
        at = end


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids; ``ids`` are unsigned 32-bit little-endian."""
    if length < 1:
        raise ValueError("length must be positive")
    spark = docs.sparkSession
    coded = written(encoded(docs, path, end_id), "packing-ids")
    order = coded.select("key", "doc_id", "row", "n")
    order = order.repartitionByRange(shuffles(spark), "key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
    places = written(order.mapInArrow(_running, "row bigint, n bigint, shard bigint, local bigint"), "packing-order")
    bases, total = shard_bases(places)
    places = places.join(F.broadcast(bases), "shard").select("row", (F.col("base") + F.col("local")).alias("place"))
    placed = coded.select("row", "doc_id", "ids").join(places, "row").select("doc_id", "ids", "place")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = tokens.opened(path).dtype
        for batch in blocks(batches, "ids"):
            out: list[tuple] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "place")), strict=True)
            for doc_id, data, place in rows:
                ids = np.frombuffer(data, dtype=dtype).astype("<u4")
                for at, end, sequence, first, size in cuts(place, place + len(ids), total, length):
                    piece = ids[at - place : end - place].tobytes()
                    out.append((doc_id, at - place, end - at, piece, len(ids), sequence, at - first, size))
            columns = zip(*out, strict=True) if out else [[]] * 8
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length"],
            )

    return placed.mapInArrow(pieces, PIECE)
