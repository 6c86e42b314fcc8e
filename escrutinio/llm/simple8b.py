"""Token ids in Simple-8b words: a format of frames, and its writer and reader on Spark.

A 64-bit word holds a selector in its top four bits and a count of values, all of the same
width, below; the encoder takes the widest count that fits. Selector 15 is an escape: the
next word is one value of 2**60 or more as it is. Values are coded in blocks of
``BLOCK_IDS``; each starts a new word and its offset is kept, so any block decodes alone
and all decode together, selector by selector, without a loop over words.

A frame is a row of a Parquet table: shard and frame number, the ids of its shard before
it, the documents' ids and token counts, word offsets of the blocks, and the words. Frames hold
whole documents, about ``FRAME_IDS`` ids (a longer document has a frame of its own).
Shards are ranges of doc_id in ascending order.

Cases: null and empty texts are the end id alone; rows that repeat a doc_id are documents
each, in the order of their texts' hashes; rows without doc_id come first. An empty table gives no frame.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm import tokens
from escrutinio.llm.common import shuffles, written
from escrutinio.llm.curve_packing import shard_bases
from escrutinio.llm.text import blocks

BLOCK_IDS = 1024
FRAME_IDS = 1 << 20
_ESCAPE = 15

# Counts per word of the selectors 0 to 13; each value has 60 // count bits.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)

FRAME = (
    "shard bigint, frame bigint, local bigint, n bigint, doc_ids array<bigint>, doc_tokens array<bigint>,"
    " blocks binary, words binary"
)


#: Bits of each value of 16 bits, and the least value of each number of bits.
_BITS = np.repeat(np.arange(17, dtype=np.uint8), [1, *(1 << b for b in range(16))])
_LEAST = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _selectors(values: np.ndarray, block_ids: int) -> np.ndarray:
    """For each position, the selector of the word that would start there."""
    n = len(values)
    bits = _BITS[values] if values.dtype.itemsize == 2 else np.searchsorted(_LEAST, values.astype(np.uint64), side="right").astype(np.uint8)
    most = COUNTS[0]
    left = np.minimum(block_ids - np.arange(block_ids), most).astype(np.uint8)
    left = np.tile(left, -(-n // block_ids))[:n]
    rest = min(n, most)
    left[n - rest :] = np.minimum(left[n - rest :], np.arange(rest, 0, -1))

    def widest(largest: np.ndarray, shift: int) -> np.ndarray:
        """The larger of each value and the one ``shift`` further on."""
        out = largest.copy()
        np.maximum(largest[: max(n - shift, 0)], largest[shift:], out=out[: max(n - shift, 0)])
        return out

    by_span, span = {1: bits}, 1
    while span < most:
        by_span[2 * span] = widest(by_span[span], span)
        span *= 2
    # What fits in a word of some count fits in those of smaller counts as well.
    fitting = np.zeros(n, dtype=np.uint8)
    for count in COUNTS:
        span = 1 << (count.bit_length() - 1)
        top = widest(by_span[span], count - span) if count > span else by_span[span]
        fitting += (top <= 60 // count) & (left >= count)
    return np.where(fitting > 0, np.uint8(len(COUNTS)) - fitting, np.uint8(_ESCAPE))


def encode(values: np.ndarray, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Words of the values (unsigned, up to 64 bits) and the offset of each block's first word."""
    n = len(values)
    if n == 0:
        return np.zeros(0, dtype="<u8"), np.zeros(0, dtype="<u4")
    values = np.ascontiguousarray(values)
    selectors = _selectors(values, block_ids)
    steps = np.array([*COUNTS, 1, 1])[selectors]
    starts = np.zeros(n, dtype=bool)
    at, first = np.arange(0, n, block_ids), np.arange(0, n, block_ids)
    stop = np.minimum(first + block_ids, n)
    while len(at):  # all blocks in step: one word of each
        starts[at] = True
        at = at + steps[at]
        going = at < stop
        at, stop = at[going], stop[going]
    begin = np.flatnonzero(starts)
    picked = selectors[begin]
    size = 1 + (picked == _ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), dtype=np.uint64)
    for selector, count in enumerate(COUNTS):
        which = np.flatnonzero(picked == selector)
        width = 60 // count
        packed = np.full(len(which), selector << 60, dtype=np.uint64)
        for k in range(count):
            packed |= values[begin[which] + k].astype(np.uint64) << np.uint64(k * width)
        words[place[which]] = packed
    escaped = np.flatnonzero(picked == _ESCAPE)
    words[place[escaped]] = np.uint64(_ESCAPE << 60)
    words[place[escaped] + 1] = values[begin[escaped]].astype(np.uint64)
    return words.astype("<u8"), place[np.searchsorted(begin, first)].astype("<u4")


def decode(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The values of whole blocks, whose first words are at ``offsets``."""
    words = words.astype(np.uint64)
    head = np.ones(len(words), dtype=bool)
    top = (words >> np.uint64(60)).astype(np.int64)
    # A raw word may look like any selector: step over it, block by block in lockstep only
    # where escapes occur at all.
    if (top == _ESCAPE).any():
        at, stop = offsets.astype(np.int64), np.append(offsets[1:], len(words)).astype(np.int64)
        head[:] = False
        while len(at):
            head[at] = True
            at = at + 1 + (top[at] == _ESCAPE)
            going = at < stop
            at, stop = at[going], stop[going]
    place = np.flatnonzero(head)
    picked = top[place]
    counts = np.array([*COUNTS, 1, 1])[picked]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    for selector, count in enumerate(COUNTS):
        which = np.flatnonzero(picked == selector)
        width = 60 // count
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            out[ends[which] - count + k] = (words[place[which]] >> np.uint64(k * width)) & mask
    which = np.flatnonzero(picked == _ESCAPE)
    out[ends[which] - 1] = words[place[which] + 1]
    return out


def write(docs: DataFrame, path: str, end_id: int = 2, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode the texts, write the frames below spark.checkpoint.dir, and return the table."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokens.opened(path)
        end = np.array([end_id], dtype=tokenizer.dtype).tobytes()
        shard, frame, local = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        doc_ids: list[int | None] = []

        def full() -> pa.RecordBatch:
            nonlocal frame, local, ids, doc_ids
            values = np.frombuffer(b"".join(ids), dtype=tokenizer.dtype)
            words, offsets = encode(values)
            counts = [len(i) // tokenizer.dtype.itemsize for i in ids]
            row = [[shard], [frame], [local], [len(values)], [doc_ids], [counts], [offsets.tobytes()], [words.tobytes()]]
            types = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["shard", "frame", "local", "n", "doc_ids", "doc_tokens", "blocks", "words"]
            frame, local, ids, doc_ids = frame + 1, local + len(values), [], []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types, strict=True)], names=names)

        held = 0
        for batch in blocks(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                size = len(found) // tokenizer.dtype.itemsize + 1
                if ids and held + size > frame_ids:
                    yield full()
                    held = 0
                ids.append(found + end)
                doc_ids.append(doc_id)
                held += size
        if ids:
            yield full()

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = ("doc_id", F.xxhash64("text"))  # the sort keys are sampled on the driver, so no text is among them
    ordered = docs.repartitionByRange(shuffles(docs.sparkSession), *order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(frames, FRAME), "simple8b")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            values = decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["blocks"], "<u4")).astype("<u4")
            counts = np.array(row["doc_tokens"], dtype=np.int64)
            ends = np.cumsum(counts)
            data = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["base"] + row["local"] + ends - counts),
                    pa.array(counts),
                    pa.array([data[4 * a : 4 * b] for a, b in zip(ends - counts, ends, strict=True)], pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read(frames: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit little-endian)."""
    bases, _ = shard_bases(frames.select("shard", "n"))
    return frames.join(F.broadcast(bases), "shard").select("base", "local", "doc_ids", "doc_tokens", "blocks", "words").mapInArrow(
        _decoded, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )
