"""Ranked lexical search over K2-treaps of term-document grids.

``build`` cuts the documents into ranges of bounded bytes. The postings of a range are the
points of a grid, terms by documents, each with its impact: the share of the score that the
term's occurrences in the document give, before the term's weight. The grid is halved both
ways again and again; the cells that hold points form a tree, kept as a mask of four bits per
cell and, for each cell, the largest impact in it, as its difference from that of the cell
above. All grids are one Spark table.

``search`` descends in each grid along the rows of an item's terms, all of them together. A
range of documents has one cell on each row's path; the terms' weights times these cells'
maxima bound the scores in the range. The ranges with the highest bounds are halved first, a
few at a time down to the first documents and more from step to step then, and a range whose
bound is below the k-th score found so far is dropped. A range of one document has its exact score. Each task hands on the
best of its grids for each item, and Spark ranks these. The result is exact; nothing but
bounds leaves out a document.

Scale: an index row holds the documents of ``GRID_BYTES`` of text. The items are the stated
set of queries: they are read in blocks of bounded terms, one block at a time on the driver,
and the answers of a block are written before the next one is read. A block takes two passes
over the index: one over the terms alone for their document counts, one for the search.
Terms are told by 64 bits of hash.

Cases: null and empty texts have no terms: such documents are never found, such items have no
rows. Rows that repeat a doc_id are documents of their own, rows that repeat an item_id items
of their own. Ties go to the smaller doc_id, rows without one last. Without documents or items
the result is empty. Very long texts are a grid of their own. Only the columns doc_id, item_id
and text are read.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from escrutinio.llm.common import written
from escrutinio.llm.text import Words, blocks
from escrutinio.session import scratch_dir

GRID_BYTES = 1 << 23
#: Distinct terms of the items that are searched in one pass over the index; one item at least.
BLOCK_TERMS = 1 << 18
#: Postings of the items that descend a grid side by side.
_SIDE_BY_SIDE = 1 << 20
_RANGES = 16  # halved for an item at a time until the first documents are reached, then twice as many each time
_TIES = 1 << 53  # sums of doubles are exact below
_SALTS = 64

_MEMBERS = np.zeros(256, dtype=bool)
_MEMBERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_COUNT = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)


def _terms(column: pa.Array) -> Words:
    return Words(column, lower=True, members=_MEMBERS)


def _pack(parts: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(values: np.ndarray) -> np.ndarray:
    """Like bytes of 32-bit numbers together, as they compress better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What occurrences in a document of ``n`` terms give, for the whole collection's sizes."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    m = (100 - 90 + (90 * n * documents) // max(terms, 1)).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def grow(term: np.ndarray, doc: np.ndarray, impact: np.ndarray, height: int) -> bytes:
    """The tree over the points of a grid of side 2**height, from the root down."""
    code = _spread(term) << np.uint64(1) | _spread(doc)
    order = np.argsort(code)
    code, most = code[order], impact[order].astype(np.int64)
    levels = []
    for _ in range(height):
        above = code >> np.uint64(2)
        starts = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        mask = np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), starts)
        top = np.maximum.reduceat(most, starts)
        levels.append((mask, np.repeat(top, np.diff(starts, append=len(code))) - most))
        code, most = above[starts], top
    parts = [np.array([height, most[0]], dtype="<i8")]
    for mask, less in reversed(levels):
        mask = np.concatenate((mask, np.zeros(len(mask) % 2, dtype=np.uint8)))
        parts += [mask[::2] | mask[1::2] << 4, _planes(less)]
    return _pack(parts)


class Treap:
    """A tree unpacked: all cells from the root down, each with its mask, first child and maximum."""

    def __init__(self, data: bytes):
        data = _unpack(data)
        self.height, root = (int(x) for x in np.frombuffer(data, dtype="<i8", count=2))
        at, cells = 16, 1
        most = np.array([root], dtype=np.int64)
        masks, firsts, maxima, offset = [], [], [most], 1
        for _ in range(self.height):
            packed = np.frombuffer(data, dtype=np.uint8, count=(cells + 1) // 2, offset=at)
            at += len(packed)
            mask = np.stack((packed & 15, packed >> 4), axis=1).ravel()[:cells]
            children = _COUNT[mask]
            firsts.append(offset + np.cumsum(children) - children)
            below = int(children.sum())
            less = np.frombuffer(data, dtype=np.uint8, count=4 * below, offset=at).reshape(4, below)
            at += 4 * below
            most = np.repeat(most, children) - np.ascontiguousarray(less.T).view("<u4").ravel()
            masks.append(mask)
            maxima.append(most)
            cells = below
            offset += below
        self.mask = np.concatenate(masks) if masks else np.zeros(0, dtype=np.uint8)
        self.first = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.int64)
        self.most = np.concatenate(maxima)


def _totals(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by group."""
    if len(values) and float(values.max()) * len(values) >= _TIES:
        out = np.zeros(n, dtype=np.int64)
        np.add.at(out, group, values)
        return out
    return np.bincount(group, weights=values, minlength=n).astype(np.int64)


def _rank(group: np.ndarray) -> np.ndarray:
    """Places within each run of equal numbers."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, dtype=np.int64)
    return np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))


class Best:
    """The k best documents of each item so far, by score and then doc_id (rows without one last)."""

    def __init__(self, items: int, k: int):
        self.k, self.items = k, items
        self.item = self.score = self.doc = np.zeros(0, dtype=np.int64)
        self.none = np.zeros(0, dtype=bool)
        self.floor = np.ones(items, dtype=np.int64)  # a score below is of no use

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        item, score = np.concatenate((self.item, item)), np.concatenate((self.score, score))
        doc, none = np.concatenate((self.doc, doc)), np.concatenate((self.none, none))
        order = np.lexsort((doc, none, -score, item))
        rank = _rank(item[order])
        order = order[rank < self.k]
        self.item, self.score, self.doc, self.none = item[order], score[order], doc[order], none[order]
        full = rank[rank < self.k] == self.k - 1
        self.floor[self.item[full]] = np.maximum(self.score[full], 1)


def descend(tree: Treap, item: np.ndarray, row: np.ndarray, weights: np.ndarray, found: Best, doc: np.ndarray, none: np.ndarray) -> None:
    """Put the best documents of a grid into ``found``.

    ``item``, ``row`` and ``weights`` are the terms of the items that the grid has, by item.
    A frontier of ranges has for each its item, level, first document and bound; its paths, by
    range, the row, weight and cell of each term that still has points in the range.
    """
    items, at = np.unique(item, return_inverse=True)
    of_item, level, start = items, np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
    path, cell = at, np.zeros(len(item), dtype=np.int64)
    bound = _totals(weights * tree.most[cell], path, len(items))
    several, step = _RANGES, 0
    if tree.height == 0:
        found.add(of_item, bound, doc[start], none[start])
        return
    while len(of_item):
        open_ = bound >= found.floor[of_item]
        order = np.lexsort((-bound, of_item))
        order = order[open_[order]]
        chosen = order[_rank(of_item[order]) < several]
        step += 1
        several *= 2 if step >= tree.height else 1
        split = np.zeros(len(of_item), dtype=bool)
        split[chosen] = True
        rest = open_ & ~split
        # Halve the chosen ranges: each path goes on to the cells of its row in either half.
        number = np.cumsum(split) - 1
        on = split[path]
        p, r, w, c = number[path[on]], row[on], weights[on], cell[on]
        bit = (r >> (tree.height - 1 - level[split][p])) & 1
        mask, first = tree.mask[c].astype(np.int64), tree.first[c]
        halves = []
        for side in (0, 1):
            child = 2 * bit + side
            has = (mask >> child & 1).astype(bool)
            halves.append((2 * p[has] + side, r[has], w[has], (first + _COUNT[mask & ((1 << child) - 1)])[has]))
        p, r, w, c = (np.concatenate(x) for x in zip(*halves, strict=True))
        n = 2 * int(split.sum())
        new_bound = _totals(w * tree.most[c], p, n)
        new_item, new_level = np.repeat(of_item[split], 2), np.repeat(level[split], 2) + 1
        new_start = np.repeat(start[split], 2) + np.where(np.arange(n) % 2, 1 << (tree.height - new_level), 0)
        single = (new_level == tree.height) & (new_bound > 0)
        found.add(new_item[single], new_bound[single], doc[new_start[single]], none[new_start[single]])
        new = (new_level < tree.height) & (new_bound >= found.floor[new_item])
        keep = np.concatenate((rest, new))
        renamed = np.cumsum(keep) - 1
        old, young = rest[path], new[p]
        path = renamed[np.concatenate((path[old], p[young] + len(rest)))]
        row, weights, cell = (np.concatenate((a[old], b[young])) for a, b in ((row, r), (weights, w), (cell, c)))
        of_item, level, start, bound = (
            np.concatenate(x)[keep] for x in ((of_item, new_item), (level, new_level), (start, new_start), (bound, new_bound))
        )


@dataclass
class Index:
    """The grids (docs, terms, dfs, tree), and the documents with terms and all terms of the collection."""

    grids: DataFrame
    documents: int
    terms: int


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        counts = _terms(block.column("text")).counts
        yield pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], names=["documents", "terms"])


def build(docs: DataFrame, grid_bytes: int = GRID_BYTES) -> Index:
    """The index of all rows of ``docs``, written below the shared folder."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sizes = rows.select("text").mapInArrow(_sizes, "documents bigint, terms bigint").agg(F.sum("documents"), F.sum("terms")).first()
    n_docs, n_terms = (int(x or 0) for x in sizes)

    def grids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=grid_bytes):
            words = _terms(block.column("text"))
            if not len(words.start):
                continue
            full = np.flatnonzero(words.counts)  # documents without terms have no column
            n = words.counts[full]
            terms, row = np.unique(words.hashes(), return_inverse=True)
            code, tf = np.unique(row.astype(np.int64) * len(full) + np.repeat(np.arange(len(full)), n), return_counts=True)
            term, doc = code // len(full), code % len(full)
            height = max(len(terms) - 1, len(full) - 1).bit_length()
            tree = grow(term, doc, impacts(tf, n[doc], n_docs, n_terms), height)
            ids = block.column("doc_id").take(pa.array(full))
            dfs = np.bincount(term, minlength=len(terms))
            columns = [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([terms.astype("<u8").tobytes()], pa.binary()),
                pa.array([_pack([_planes(dfs)])], pa.binary()),
                pa.array([tree], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["docs", "terms", "dfs", "tree"])

    schema = "docs array<bigint>, terms binary, dfs binary, tree binary"
    return Index(written(rows.mapInArrow(grids, schema), "grids"), n_docs, n_terms)


def _asked(items: DataFrame) -> DataFrame:
    """item (a number of the row), item_id and terms (distinct hashes) of the items with terms."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = _terms(block.column("text"))
            hashes = words.hashes()
            lists = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("item_id"), pa.array(lists, pa.list_(pa.int64()))], names=["item_id", "terms"])

    rows = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, terms array<bigint>").filter("size(terms) > 0")
    return written(rows.withColumn("item", F.monotonically_increasing_id()), "items")


def _item_blocks(rows: Iterator[Row], limit: int) -> Iterator[list[Row]]:
    """Rows in lists of at most ``limit`` terms together, one row at least."""
    block, size = [], 0
    for row in rows:
        if block and size + len(row.terms) > limit:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row.terms)
    if block:
        yield block


def _found(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted hashes are among the sorted ``terms``, and where those are."""
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    has = terms[at] == wanted
    return has, at[has]


def _weights(index: Index, wanted: np.ndarray) -> np.ndarray:
    """The weight of each wanted term, by its documents in all grids; 0 if no document has it."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for terms, dfs in zip(batch.column("terms"), batch.column("dfs"), strict=True):
                has, at = _found(np.frombuffer(terms.as_buffer(), dtype="<u8"), wanted)
                planes = np.frombuffer(_unpack(dfs.as_py()), dtype=np.uint8).reshape(4, -1)
                total[has] += np.ascontiguousarray(planes.T).view("<u4").ravel()[at]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    found = index.grids.select("terms", "dfs").mapInArrow(counts, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(len(wanted), dtype=np.int64)
    for r in found.collect():  # a row for each term of the block at most
        out[r.term] = weight(r.n, index.documents)
    return out


def _search_block(index: Index, block: list[Row], k: int) -> DataFrame:
    """item, doc_id and score: the k best of each item in each task's grids."""
    numbers = np.array([r.item for r in block], dtype=np.int64)
    hashes = np.concatenate([np.array(r.terms, dtype=np.int64) for r in block]).view(np.uint64)
    item = np.repeat(np.arange(len(block)), [len(r.terms) for r in block])
    wanted, place = np.unique(hashes, return_inverse=True)
    weights = _weights(index, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(numbers), k)
        for batch in batches:
            for row in range(len(batch)):
                docs, terms, tree = (batch.column(name)[row] for name in ("docs", "terms", "tree"))
                has, at = _found(np.frombuffer(terms.as_buffer(), dtype="<u8"), wanted)
                local = np.full(len(wanted), -1, dtype=np.int64)
                local[has] = at
                live = np.flatnonzero((local[place] >= 0) & (weights[place] > 0))
                if not len(live):
                    continue
                treap, ids = Treap(tree.as_py()), docs.values
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                side = max(1, _SIDE_BY_SIDE // len(ids))  # paths at a time, each of which has a cell per document at most
                cuts = np.flatnonzero(np.diff(item[live], prepend=-1))
                part = np.concatenate((cuts[np.flatnonzero(np.diff(cuts // side, prepend=-1))], [len(live)]))
                for a, b in zip(part[:-1], part[1:], strict=True):
                    some = live[a:b]
                    descend(treap, item[some], local[place[some]], weights[place[some]], best, ids, none)
        docs = pa.array(best.doc, mask=best.none)
        yield pa.RecordBatch.from_arrays([pa.array(numbers[best.item]), docs, pa.array(best.score)], names=["item", "doc_id", "score"])

    return index.grids.select("docs", "terms", "tree").mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def search(index: Index, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score: the k documents of each item with the highest scores above 0."""
    spark = items.sparkSession
    asked = _asked(items)
    path = scratch_dir(spark, "llm-found")
    schema = "item bigint, doc_id bigint, score bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in _item_blocks(asked.select("item", "terms").toLocalIterator(), block_terms):
        _search_block(index, block, k).write.mode("append").parquet(path)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = spark.read.schema(schema).parquet(path).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
    for keys in (["item", "_salt"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
