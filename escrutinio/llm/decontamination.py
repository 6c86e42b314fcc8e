"""Benchmark decontamination by greedy string tiling.

Words are compared lowered and without punctuation at their ends. A document and a test item
that share ``TILE`` words in a row (joined by the hashes of these seeds) are a candidate
pair, if the shared seeds could cover enough of the item at all. The pair is then tiled: of
the matching word runs that no tile covers yet the longest is marked, again and again, down
to ``TILE`` words. Runs are found by Karp-Rabin hashes, first of the whole item's length and
then of halving lengths. A document is contaminated when tiles cover ``COVERAGE`` of an item's words; the order of the tiles plays no part, so
a passage whose sentences were reordered is found.

The items are compared in blocks of bounded size, each sent to the tasks; a larger
benchmark makes more passes over the documents, one written before the next block is read,
so that the driver holds one block at a time. Documents are never shuffled.

Cases: null and empty texts match nothing. Items shorter than a tile match where a document
holds all their words in a row. Rows that repeat an item or a document are compared each; rows
without doc_id or item_id too, and have null there. Empty tables give an empty
result. Further columns play no part.
"""

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from escrutinio.llm.common import quoted, written
from escrutinio.llm.text import blocks, inside, windows
from escrutinio.llm.toxicity import word_hashes
from escrutinio.operators.joins import broadcast_if_small

TILE = 5
COVERAGE = 0.6
BLOCK_BYTES = 1 << 24  # of the items' texts

_FOUND = [
    StructField("item_id", LongType()),
    StructField("item_words", LongType()),
    StructField("covered_words", LongType()),
    StructField("coverage", DoubleType()),
]


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Starts of runs of ``length`` words without a mark."""
    sums = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(sums[length:] == sums[:-length])


def _runs(left: np.ndarray, right: np.ndarray, free: tuple[np.ndarray, np.ndarray], length: int) -> list[tuple[int, int, int]]:
    """Maximal equal runs of at least ``length`` words as (length, start left, start right)."""
    a, b = free
    if not len(a) or not len(b):
        return []
    ha, hb = windows(left, length)[a], windows(right, length)[b]
    order = np.argsort(ha, kind="stable")
    a, ha = a[order], ha[order]
    low, high = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    counts = high - low
    if not counts.sum():
        return []
    ends = np.cumsum(counts)
    p = a[np.arange(ends[-1]) + np.repeat(low - (ends - counts), counts)]
    t = np.repeat(b, counts)
    order = np.lexsort((t, t - p))
    p, t = p[order], t[order]
    new = np.concatenate(([True], (np.diff(t) != 1) | (np.diff(t - p) != 0)))
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(p))) + length - 1
    return list(zip(sizes.tolist(), p[heads].tolist(), t[heads].tolist(), strict=True))


def tile(left: np.ndarray, right: np.ndarray, least: int = TILE) -> list[tuple[int, int, int]]:
    """Tiles (start left, start right, length) of two arrays of word hashes, longest first."""
    marks = np.zeros(len(left), dtype=bool), np.zeros(len(right), dtype=bool)
    tiles = []
    length = min(len(left), len(right))
    while length >= least:
        found = _runs(left, right, (_free(marks[0], length), _free(marks[1], length)), length)
        heap = [(-n, t, p) for n, p, t in found]
        heapq.heapify(heap)
        while heap:
            n, t, p = heapq.heappop(heap)
            taken = marks[0][p : p - n] | marks[1][t : t - n]
            if not taken.any():
                marks[0][p : p - n] = marks[1][t : t - n] = True
                tiles.append((p, t, -n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
            for start, stop in edges.reshape(-1, 2).tolist():
                if stop - start >= length:  # shorter rests are found again further down
                    heapq.heappush(heap, (start - stop, t + start, p + start))
        length = max(length // 2, least) if length > least else 0
    return tiles


class _Items:
    """The test items of one block: word hashes, and their seeds in order of the hash."""

    def __init__(self, rows: list, least: int):
        self.ids = [r.item_id for r in rows]
        self.words, self.offsets = word_hashes(pa.array([r.text for r in rows], pa.string()))
        places = inside(self.offsets, least)
        seeds = windows(self.words, least)[places]
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.places = seeds[order], places[order]
        self.items = np.searchsorted(self.offsets, self.places, "right") - 1
        counts = np.diff(self.offsets)
        self.short = {}  # by length: hashes of the items shorter than a tile, and the items
        for size in np.unique(counts[(counts > 0) & (counts < least)]).tolist():
            some = np.flatnonzero(counts == size)
            hashes = windows(self.words, size)[self.offsets[some]]
            order = np.argsort(hashes, kind="stable")
            self.short[size] = hashes[order], some[order]
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.seeds >> np.uint64(44)).astype(np.int64)] = True

    def of(self, item: int) -> np.ndarray:
        return self.words[self.offsets[item] : self.offsets[item + 1]]


def _candidates(items: _Items, seeds: np.ndarray, rows: np.ndarray, least: int, share: float) -> list[tuple[int, int]]:
    """Pairs (row, item) whose shared seeds could cover ``share`` of the item."""
    asked = np.flatnonzero(items.sieve[(seeds >> np.uint64(44)).astype(np.int64)])
    low, high = np.searchsorted(items.seeds, seeds[asked], "left"), np.searchsorted(items.seeds, seeds[asked], "right")
    counts = high - low
    if not counts.sum():
        return []
    ends = np.cumsum(counts)
    at = np.arange(ends[-1]) + np.repeat(low - (ends - counts), counts)
    hits = np.unique(np.stack((np.repeat(rows[asked], counts), items.items[at], items.places[at]), axis=1), axis=0)
    heads = np.flatnonzero(np.concatenate(([True], (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 0))))
    pairs = []
    for start, stop in zip(heads, np.append(heads[1:], len(hits)), strict=True):
        row, item = hits[start, :2].tolist()
        covered = np.minimum(np.diff(np.append(hits[start:stop, 2], hits[stop - 1, 2] + least)), least).sum()
        if covered >= share * len(items.of(item)):
            pairs.append((row, item))
    return pairs


def _verbatim(items: _Items, hashed: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, item, words) of the short items that a row holds."""
    found = []
    for size, (hashes, which) in items.short.items():
        places = inside(offsets, size)
        mine = windows(hashed, size)[places]
        rows = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - size + 1, 0))
        low, high = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
        for at in np.flatnonzero(high > low).tolist():
            found += [(int(rows[at]), int(item), size) for item in which[low[at] : high[at]]]
    return sorted(set(found))


def _tiled(docs: DataFrame, items: _Items, least: int, share: float) -> DataFrame:
    """``docs`` are columns that name a row, and ``text``."""
    keys = [f for f in docs.schema if f.name != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            hashed, offsets = word_hashes(block.column("text"))
            places = inside(offsets, least)
            row_of = np.repeat(np.arange(len(block)), np.maximum(np.diff(offsets) - least + 1, 0))
            found = []
            for row, item in _candidates(items, windows(hashed, least)[places], row_of, least, share):
                words = items.of(item)
                covered = sum(n for _, _, n in tile(hashed[offsets[row] : offsets[row + 1]], words, least))
                if covered >= share * len(words):
                    found.append((row, items.ids[item], len(words), covered, covered / len(words)))
            found += [(row, items.ids[item], n, n, 1.0) for row, item, n in _verbatim(items, hashed, offsets)]
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            picked = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(key.name).take(picked) for key in keys),
                    *(pa.array(c, pa.int64()) for c in columns[1:4]),
                    pa.array(columns[4], pa.float64()),
                ],
                names=[*(key.name for key in keys), "item_id", "item_words", "covered_words", "coverage"],
            )

    return docs.mapInArrow(rows, StructType([*keys, *_FOUND]))


def matches(
    docs: DataFrame, benchmark: DataFrame, least: int = TILE, share: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, item_id, item_words, covered_words, coverage of each contaminated document and item."""
    return _matches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark, least, share, block_bytes)


def _matches(docs: DataFrame, benchmark: DataFrame, least: int, share: float, block_bytes: int) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // block_bytes))
    found = []
    for part in range(parts):  # a block of the items is bounded, the number of blocks is not
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        tiled = _tiled(docs, _Items(rows, least), least, share)
        found.append(tiled if parts == 1 else written(tiled, "contamination"))
    return reduce(DataFrame.unionByName, found)


def clean(
    docs: DataFrame, benchmark: DataFrame, least: int = TILE, share: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated.

    What is contaminated is told by the text and not by its doc_id, which may be missing or repeated.
    """
    digests = [F.xxhash64("text").alias("_first"), F.xxhash64(F.lit("second"), "text").alias("_second")]
    found = _matches(docs.select(*digests, "text"), benchmark, least, share, block_bytes)
    found = written(found.select("_first", "_second").distinct(), "contaminated")
    rows = docs.select(F.struct(*(quoted(n) for n in docs.columns)).alias("_row"), *digests)
    return rows.join(broadcast_if_small(found), ["_first", "_second"], "left_anti").select("_row.*")
