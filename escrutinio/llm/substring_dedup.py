"""Substring dedup by Rabin-Karp hashes of every window of ``size`` words.

Each task hashes all windows of its documents and sends the first of each hash, as packed
arrays, to the hash's bin; windows that a smaller doc_id of the same block has are known to
go and only pass through. So the copies of one passage reach a bin once per block of text,
whatever their number. A bin counts its hashes and answers every document but the first with
those that it must give up; answers are packed by shards of the documents. A second pass over the texts removes the words that such
windows, and repeats within the document, cover; overlapping windows merge into maximal
intervals.

A window is told by 64 bits and the bin by further, independent bits, so the width of the
key grows with the number of bins and thus with the corpus.

Cases: a null text has no words; a text shorter than a window keeps all. Rows that repeat a
doc_id are the same document and none is earlier than the other. Rows without doc_id come
last and are not earlier than each other. An empty table gives an empty result. Further
columns play no part.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm.common import shuffles
from escrutinio.llm.text import Words, blocks, buffers, inside, mix, windows

WINDOW = 20
#: Bins at the least, for each of the session's shuffle partitions, and text for a bin at the most.
BINS_PER_SHUFFLE = 2
BIN_BYTES = 1 << 26
_BLOCK_BYTES = 1 << 23
_LAST = (1 << 63) - 1  # the place of rows without an id

_SENT = "bin int, gone boolean, hashes binary, docs array<bigint>, counts array<int>"
_RESULT = (
    "doc_id bigint, text string, n_words bigint, n_removed bigint,"
    " removed array<struct<start: bigint, stop: bigint>>, kept_sha256 string"
)
_INTERVAL = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _starts(change: np.ndarray, n: int) -> np.ndarray:
    """Where runs start, given where neighbours differ."""
    return np.concatenate(([0], np.flatnonzero(change) + 1)) if n else np.zeros(0, dtype=np.int64)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values of 8-byte items between successive bounds."""
    if len(data) * 8 >= 1 << 31:
        raise ValueError("a group has more than 2 GB of hashes: give more bins")
    offsets = (bounds * 8).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _sent(which: np.ndarray, gone: bool, bins: np.ndarray, docs: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """The windows ``which`` (ascending) as one row per bin, in their order."""
    which = which[np.argsort(bins[which], kind="stable")]
    b, d, n = bins[which], docs[which], len(which)
    heads = _starts(b[1:] != b[:-1], n)
    runs = _starts((b[1:] != b[:-1]) | (d[1:] != d[:-1]), n)
    lists = pa.array(np.append(np.searchsorted(runs, heads), len(runs)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(b[heads].astype(np.int32)),
            pa.array(np.full(len(heads), gone)),
            _binary(hashes[which], np.append(heads, n)),
            pa.ListArray.from_arrays(lists, pa.array(d[runs], pa.int64())),
            pa.ListArray.from_arrays(lists, pa.array(np.diff(np.append(runs, n)).astype(np.int32))),
        ],
        names=["bin", "gone", "hashes", "docs", "counts"],
    )


def _windows(block: pa.RecordBatch, size: int, n_bins: int) -> Iterator[pa.RecordBatch]:
    key = block.column("doc_key").to_numpy()
    order = np.argsort(key, kind="stable")
    if (np.diff(key) < 0).any():
        block, key = block.take(pa.array(order)), key[order]
    words = Words(block.column("text"))
    hashed = words.hashes()
    places = inside(words.offsets, size)
    if not len(places):
        return
    hashes = windows(hashed, size, 0)[places]
    bins = (windows(hashed, size, 1)[places] % np.uint64(n_bins)).astype(np.int32)
    docs = np.repeat(key, np.maximum(words.counts - size + 1, 0))
    order = np.argsort(hashes, kind="stable")
    h, b, d = hashes[order], bins[order], docs[order]
    if ((h[1:] == h[:-1]) & (b[1:] != b[:-1])).any():  # equal halves of different windows
        order = np.lexsort((np.arange(len(hashes)), bins, hashes))
        h, b, d = hashes[order], bins[order], docs[order]
    change = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
    first = np.concatenate(([True], change))
    owner = d[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))]
    again = np.concatenate(([False], ~change & (d[1:] == d[:-1])))
    yield _sent(np.sort(order[first]), False, bins, docs, hashes)
    yield _sent(np.sort(order[~again & (d != owner)]), True, bins, docs, hashes)


def _hashes(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a group and how many each row has, chunk by chunk: together they may pass 2 GB."""
    parts = [buffers(chunk) for chunk in table.column("hashes").chunks]
    hashes = [data.view("<u8") for data, _ in parts]
    sizes = [np.diff(bounds) // 8 for _, bounds in parts]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none.view("<u8"), *hashes]), np.concatenate([none, *sizes])


def _answers(table: pa.Table, n_bins: int) -> pa.Table:
    """The hashes of one bin that each document loses, as a smaller doc_id has them, a row per
    shard of the documents."""
    column = lambda name: table.column(name).combine_chunks()
    hashes, sizes = _hashes(table)
    gone = np.repeat(column("gone").to_numpy(zero_copy_only=False), sizes)
    docs = np.repeat(column("docs").flatten().to_numpy(), column("counts").flatten().to_numpy())
    live, live_docs = hashes[~gone], docs[~gone]
    order = np.argsort(live, kind="stable")
    h = live[order]
    same = h[1:] == h[:-1]
    shared = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(h) else order
    shared = shared[np.lexsort((live_docs[shared], live[shared]))]
    h, d = live[shared], live_docs[shared]
    heads = _starts(h[1:] != h[:-1], len(h))
    owner = np.repeat(d[heads], np.diff(np.append(heads, len(h))))
    lost = d != owner
    docs, hashes = np.concatenate((d[lost], docs[gone])), np.concatenate((h[lost], hashes[gone]))
    shards = (mix(docs.view(np.uint64) + np.uint64(1)) % np.uint64(n_bins)).astype(np.int32)
    order = np.lexsort((docs, shards))
    sent = _sent(np.arange(len(order)), False, shards[order], docs[order], hashes[order])
    return pa.table([sent.column(n) for n in ("bin", "hashes", "docs", "counts")], names=["shard", "hashes", "docs", "counts"])


def _per_document(table: pa.Table) -> pa.Table:
    """The hashes that each document of one shard loses."""
    column = lambda name: table.column(name).combine_chunks()
    hashes, _ = _hashes(table)
    docs = np.repeat(column("docs").flatten().to_numpy(), column("counts").flatten().to_numpy())
    order = np.argsort(docs, kind="stable")
    docs, hashes = docs[order], hashes[order]
    heads = _starts(docs[1:] != docs[:-1], len(docs))
    return pa.table([pa.array(docs[heads], pa.int64()), _binary(hashes, np.append(heads, len(docs)))], names=["doc_key", "lost"])


def _covered(words: Words, lost: list[bytes], size: int) -> np.ndarray:
    """A mark for each word that a removed window covers."""
    covered = np.zeros(len(words.start) + 1, dtype=np.int32)
    places = inside(words.offsets, size)
    if not len(places):
        return covered[:-1] > 0
    rows = np.repeat(np.arange(len(lost), dtype=np.uint64), np.maximum(words.counts - size + 1, 0))
    salt = np.uint64(0x9E3779B97F4A7C15)
    mine = mix(windows(words.hashes(), size, 0)[places] ^ mix((rows + np.uint64(1)) * salt))
    order = np.argsort(mine, kind="stable")
    repeat = np.zeros(len(mine), dtype=bool)
    repeat[order[1:]] = mine[order[1:]] == mine[order[:-1]]
    counts = np.array([len(x) // 8 for x in lost])
    told = np.frombuffer(b"".join(lost), dtype="<u8")
    if len(told):
        owners = np.repeat(np.arange(len(lost), dtype=np.uint64), counts)
        told = np.sort(mix(told ^ mix((owners + np.uint64(1)) * salt)))
        asked = np.flatnonzero(counts[rows.astype(np.int64)] > 0)
        at = np.minimum(np.searchsorted(told, mine[asked]), len(told) - 1)
        repeat[asked] |= told[at] == mine[asked]
    gone = places[repeat]
    np.add.at(covered, gone, 1)
    np.add.at(covered, gone + size, -1)
    return np.cumsum(covered[:-1]) > 0


def _rewrite(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        words = Words(block.column("text"))
        lost = [x or b"" for x in block.column("lost").to_pylist()]
        covered = _covered(words, lost, size)
        removed = np.add.reduceat(np.append(covered, False), words.offsets[:-1], dtype=np.int64) if len(block) else []
        removed = np.where(words.counts > 0, removed, 0)
        texts, intervals = [], []
        for i, text in enumerate(block.column("text").cast(pa.binary()).to_pylist()):
            parts = (text or b"").split()
            spans = []
            if removed[i]:
                mark = covered[words.offsets[i] : words.offsets[i + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate(([False], mark, [False])).astype(np.int8)))
                spans = [{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()]
                parts = [w for w, m in zip(parts, mark.tolist(), strict=True) if not m]
            texts.append(b" ".join(parts))
            intervals.append(spans)
        yield pa.RecordBatch.from_arrays(
            [
                block.column("doc_id"),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(words.counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(intervals, _INTERVAL),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
            ],
            names=["doc_id", "text", "n_words", "n_removed", "removed", "kept_sha256"],
        )


def dedup(docs: DataFrame, size: int = WINDOW, bins: int | None = None) -> DataFrame:
    """doc_id, text (words that stay), n_words, n_removed, removed intervals and kept_sha256 of every row.

    A bin is one group in a task, about 8 bytes for each of its windows. ``bins`` follows the
    bytes of the texts, ``BIN_BYTES`` for a bin, so a bin does not grow with the corpus.
    """
    if size < 1:
        raise ValueError("a window has one word at least")
    size_of = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_bins = bins or max(BINS_PER_SHUFFLE * shuffles(docs.sparkSession), -(-size_of // BIN_BYTES))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs = docs.withColumn("doc_key", F.coalesce("doc_id", F.lit(_LAST)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=_BLOCK_BYTES):
            yield from _windows(block, size, n_bins)

    sent = docs.select("doc_key", "text").mapInArrow(hashed, _SENT)
    answers = sent.groupBy("bin").applyInArrow(
        lambda table: _answers(table, n_bins), "shard int, hashes binary, docs array<bigint>, counts array<int>"
    )
    answers = answers.groupBy("shard").applyInArrow(_per_document, "doc_key bigint, lost binary")
    told = docs.join(answers, "doc_key", "left").select("doc_id", "text", "lost")
    return told.mapInArrow(lambda batches: _rewrite(batches, size), _RESULT)
