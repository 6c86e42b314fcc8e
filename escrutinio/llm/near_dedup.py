"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its distinct word shingles. Equal sets form a class, represented
by its smallest doc_id. A class has a signature of ``CHUNKS * SYMBOLS`` minima, b bits of
each kept. Signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` symbols have, by
the pigeonhole principle, a chunk with at most ``ERRORS`` differing symbols; leaving out
each choice of ``ERRORS`` symbols of each chunk in turn, such a pair agrees on a key. So
every pair within that distance meets (pairs further apart that meet are judged too). Of
two sets with a similarity of 0.8, all chunks have more errors once in 40,000 times.

All pairs within a key are never made:

1. Each member of a key is checked against the key's smallest member, signatures first,
   then full shingle sets (64-bit hashes). The links give components.
2. Keys whose members are still in several components are cut into blocks. Within each pair
   of blocks the tasks compare signatures across components, a pair of documents only under the
   first key that it shares; the sets of documents that have near partners then come to that
   pair of blocks and are compared there. What leaves a task are rows of documents and links
   that join components, never the pairs. Pairs of blocks are worked on in bins; there are as
   many bins as their rows and bytes ask for, so that a bin does not grow with the corpus.

Both steps together leave no candidate pair between different components unchecked.

Cases: null texts and texts without words have an empty set and link with nothing. Fewer
words than a shingle count as one shingle. Rows that repeat a doc_id are one node. Rows
without doc_id follow a document with an equal set, and are else alone with a null
component. An empty table gives an empty result. Further columns play no part.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm.common import quoted, shuffles, written
from escrutinio.llm.components import components
from escrutinio.llm.text import Words, blocks, distinct_per_row, inside, mix, windows
from escrutinio.operators.joins import broadcast_if_small

SHINGLE = 5
THRESHOLD = 80  # per cent
CHUNKS, SYMBOLS, ERRORS = 10, 6, 1
#: Symbols two signatures may differ in before a pair is not worth a check of the sets. At a
#: similarity of 0.8 the mean is 12, and more than 28 differ less than once in a million times.
FAR = 28
_CELLS = 1 << 22  # symbols compared at once
_BLOCK_BYTES = 1 << 20  # of texts at once
#: Members of a key, and shingles of their sets, that make up a block.
BLOCK_MEMBERS = 2048
BLOCK_SHINGLES = 1 << 23
#: Rows of members, and bytes of sets and partners, that a bin of units has on average.
BIN_MEMBERS = 1 << 16
BIN_BYTES = 1 << 26

_SIZE = CHUNKS * SYMBOLS
_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, size=(2, _SIZE), dtype=np.int64).astype(np.uint64)
_XOR, _ODD = _RANDOM[0] << np.uint64(1), (_RANDOM[1] << np.uint64(1)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row and their offsets."""
    words = Words(column, lower=True)
    hashed, counts = words.hashes(), words.counts
    found = [windows(hashed, size)[inside(words.offsets, size)]]
    rows = [np.repeat(np.arange(len(column)), np.maximum(counts - size + 1, 0))]
    for few in range(1, size):
        short = np.flatnonzero(counts == few)
        if len(short):
            found.append(mix(windows(hashed, few)[words.offsets[short]] + np.uint64(few)))
            rows.append(short)
    values, rows = np.concatenate(found), np.concatenate(rows)
    if len(found) > 1:
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
    return distinct_per_row(values, rows, len(column))


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The b-bit minima (b = 16) of each non-empty set, a row each."""
    full = np.flatnonzero(np.diff(offsets))
    out = np.empty((len(full), _SIZE), dtype="<u2")
    if len(full):
        for k in range(_SIZE):
            least = np.minimum.reduceat((values ^ _XOR[k]) * _ODD[k], offsets[full])
            out[:, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """A key for each chunk and each choice of ``ERRORS`` symbols left out of it."""
    keys = []
    for chunk in range(CHUNKS):
        part = signature[:, chunk * SYMBOLS : (chunk + 1) * SYMBOLS].astype(np.uint64)
        for choice, kept in enumerate(combinations(range(SYMBOLS), SYMBOLS - ERRORS)):
            key = np.full(len(part), (chunk << 16) + choice + 1, dtype=np.uint64)
            for symbol in kept:
                key = mix(key + part[:, symbol] + np.uint64(1))
            keys.append(key)
    return np.stack(keys, axis=1)


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature (null for an empty set)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=_BLOCK_BYTES):
            values, offsets = shingle_sets(block.column("text"), size)
            counts = np.diff(offsets)
            found = iter(signatures(values, offsets))
            data = values.tobytes()
            spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            digests = [xxhash.xxh3_128_digest(data[8 * a : 8 * b]) if b > a else None for a, b in spans]
            sigs = [next(found).tobytes() if n else None for n in counts.tolist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(counts), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return docs.mapInArrow(rows, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, _SIZE)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = chunk_keys(_matrix(batch.column("signature")))
        reps = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(reps)], names=["key", "rep"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are not far apart."""
    for batch in batches:
        far = (_matrix(batch.column("sig_a")) != _matrix(batch.column("sig_b"))).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(far <= FAR))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The numbers of both sets and of what they share."""
    for block in blocks(batches, "set_b"):
        columns = (block.column("set_a").to_pylist(), block.column("set_b").to_pylist())
        counts = []
        for x, y in zip(*columns, strict=True):
            p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            counts.append((len(p), len(q), len(np.intersect1d(p, q, assume_unique=True))))
        sizes = np.array(counts, dtype=np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [block.column("a"), block.column("b"), *(pa.array(sizes[:, i]) for i in range(3))],
            names=["a", "b", "n_a", "n_b", "n_shared"],
        )


def _units(table: pa.Table) -> Iterator[tuple[int, int]]:
    """Row ranges of equal units in a table sorted by unit."""
    unit = table.column("unit").to_numpy()
    heads = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1]))) if len(unit) else []
    yield from zip(heads, np.append(heads[1:], len(unit)), strict=True)


def _open_pairs(table: pa.Table, threshold: int) -> pa.Table:
    """Of each unit (a key and a pair of its blocks): the documents with near partners in
    other components, and the partners for one of each two."""
    table = table.sort_by([("unit", "ascending"), ("rep", "ascending")]).combine_chunks()
    column = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
    key, low, high, reps, comps, place, sizes = map(column, ("key", "low", "high", "rep", "comp", "block", "n_shingles"))
    matrix = _matrix(table.column("signature").combine_chunks())
    units: list[int] = []
    members: list[int] = []
    numbers: list[int] = []
    partners: list[bytes] = []
    for start, stop in _units(table):
        left = start + np.flatnonzero(place[start:stop] == low[start])
        right = start + np.flatnonzero(place[start:stop] == high[start])
        keys = chunk_keys(matrix[start:stop]).view(np.int64)
        step = max(1, _CELLS // (_SIZE * max(len(right), 1)))
        found: dict[int, list[int]] = {}
        for at in range(0, len(left), step):
            some = left[at : at + step]
            apart = comps[some][:, None] != comps[right][None, :]
            if low[start] == high[start]:
                apart &= reps[some][:, None] < reps[right][None, :]
            smaller = np.minimum(sizes[some][:, None], sizes[right][None, :])
            apart &= 100 * smaller >= threshold * np.maximum(sizes[some][:, None], sizes[right][None, :])
            i, j = np.nonzero(apart)
            for cut in range(0, len(i), _CELLS // _SIZE):
                p, q = some[i[cut : cut + _CELLS // _SIZE]], right[j[cut : cut + _CELLS // _SIZE]]
                near = (matrix[p] != matrix[q]).sum(axis=1) <= FAR
                p, q = p[near], q[near]
                first = (keys[p - start] == keys[q - start]).argmax(axis=1)
                here = keys[p - start, first] == key[start]
                for x, y in zip(p[here].tolist(), q[here].tolist(), strict=True):
                    found.setdefault(x, []).append(y)
                    found.setdefault(y, [])
        for x, others in found.items():
            units.append(table.column("unit")[start].as_py())
            members.append(reps[x])
            numbers.append(sizes[x])
            partners.append(reps[others].astype("<i8").tobytes())
    return pa.table(
        [pa.array(units, pa.int64()), pa.array(members, pa.int64()), pa.array(numbers, pa.int64()), pa.array(partners, pa.binary())],
        names=["unit", "rep", "n_shingles", "partners"],
    )


def _joined(table: pa.Table, threshold: int) -> pa.Table:
    """Links between the documents of each unit that full sets confirm, as many as join them."""
    table = table.sort_by("unit").combine_chunks()
    reps = table.column("rep").to_numpy()
    sets, partners = table.column("set").combine_chunks(), table.column("partners").combine_chunks()
    links: list[tuple[int, int]] = []
    for start, stop in _units(table):
        place = {rep: i for i, rep in enumerate(reps[start:stop].tolist())}
        values = [np.frombuffer(x.as_py(), "<u8") for x in sets[start:stop]]
        root = list(range(stop - start))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in range(stop - start):
            others = [place[r] for r in np.frombuffer(partners[start + i].as_py(), "<i8").tolist() if r in place]
            others = [j for j in others if find(j) != find(i)]
            if not others:
                continue
            counts = np.array([len(values[j]) for j in others])
            every = np.concatenate([values[j] for j in others])
            own = values[i]
            at = np.minimum(np.searchsorted(own, every), len(own) - 1)
            shared = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(counts) - counts)
            enough = 100 * shared >= threshold * (len(own) + counts - shared)
            for j in np.array(others)[enough].tolist():
                if find(j) != find(i):
                    root[find(j)] = find(i)
                    links.append((reps[start + i], reps[start + j]))
    pairs = np.sort(np.array(links, dtype=np.int64).reshape(-1, 2), axis=1)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


class _Join:
    def __init__(self, docs: DataFrame, classes: DataFrame, members: DataFrame, size: int, threshold: int):
        self.members, self.threshold = members, threshold
        self.signatures = classes.select("rep", "signature", "n_shingles")
        wanted = broadcast_if_small(members.select(F.col("rep").alias("doc_id")).distinct())

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, limit=_BLOCK_BYTES):
                values, offsets = shingle_sets(block.column("text"), size)
                data, bounds = values.astype("<u8").tobytes(), (8 * offsets).tolist()
                sets = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sets, pa.binary())], names=["rep", "set"])

        sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(rows, "rep bigint, set binary")
        self.sets = written(sets, "near-sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, checked on the full sets."""
        of = lambda table, name, side: table.select(F.col("rep").alias(side), F.col(name).alias(f"{name[:3]}_{side}"))
        signed_pairs = pairs.join(of(self.signatures, "signature", "b"), "b").join(of(self.signatures, "signature", "a"), "a")
        near = written(signed_pairs.mapInArrow(_near, "a bigint, b bigint"), "near-pairs")
        with_sets = near.join(of(self.sets, "set", "b"), "b").join(of(self.sets, "set", "a"), "a")
        shared = with_sets.mapInArrow(_shared, "a bigint, b bigint, n_a bigint, n_b bigint, n_shared bigint")
        enough = F.lit(100) * F.col("n_shared") >= F.lit(self.threshold) * (F.col("n_a") + F.col("n_b") - F.col("n_shared"))
        return shared.filter(enough).select("a", "b")

    def leaders(self) -> DataFrame:
        return self.members.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()

    def rest(self, comps: DataFrame) -> DataFrame:
        """Links (a, b) between components whose members share a key."""
        threshold = self.threshold
        placed = self.members.filter("n > 2").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        placed = placed.join(self.signatures.drop("signature"), "rep")
        placed = placed.select("key", "rep", "n_shingles", F.coalesce("component", "rep").alias("comp"))
        size = F.greatest(F.count(F.lit(1)) / BLOCK_MEMBERS, F.sum("n_shingles") / BLOCK_SHINGLES)
        keys = placed.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.ceil(size).cast("int").alias("cut"), F.count(F.lit(1)).alias("n")
        )
        keys = written(keys.filter("lo < hi").select("key", "cut", "n"), "near-keys")
        dealt = keys.agg(F.sum(F.col("n") * F.col("cut"))).first()[0] or 0
        open_rows = placed.drop("n_shingles").join(keys.drop("n"), "key")
        rows = open_rows.withColumn("block", F.pmod(F.xxhash64("rep"), "cut").cast("int")).join(self.signatures, "rep")
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
        rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        rows = rows.withColumn("unit", F.xxhash64("key", "low", "high"))
        tasks = shuffles(rows.sparkSession)
        bins = lambda load, most: F.pmod(F.xxhash64("unit"), F.lit(max(4 * tasks, -(-load // most)))).alias("bin")
        rows = rows.select("unit", "key", "low", "high", "rep", "comp", "block", "signature", "n_shingles", bins(dealt, BIN_MEMBERS))
        # Dealt out by hand: small tables that take long to work on are not to be coalesced.
        near = rows.repartition(tasks, "bin").groupBy("bin").applyInArrow(
            lambda table: _open_pairs(table, threshold), "unit bigint, rep bigint, n_shingles bigint, partners binary"
        )
        near = written(near, "near-units")
        size = near.agg(F.sum(8 * F.col("n_shingles") + F.octet_length("partners"))).first()[0] or 0
        near = near.join(self.sets, "rep").select("unit", "rep", "partners", "set", bins(size, BIN_BYTES))
        return near.repartition(tasks, "bin").groupBy("bin").applyInArrow(lambda table: _joined(table, threshold), "a bigint, b bigint")


def mark(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    table = written(signed(docs, size), "near-signed")
    classes = table.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
    one = {"rep": "doc_id", "signature": "signature", "n_shingles": "n_shingles"}
    classes = written(classes.agg(*(F.min(name).alias(alias) for alias, name in one.items())), "near-classes")
    keys = classes.select("rep", "signature").mapInArrow(_keyed, "key bigint, rep bigint")
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("leader")).filter("n > 1")
    members = written(keys.join(several, "key"), "near-members")
    join = _Join(docs, classes, members, size, threshold)
    links = written(join.links(join.leaders()), "near-links")
    comps = components(links)
    more = written(join.rest(comps), "near-links")
    if not more.isEmpty():
        # The components so far are stars already, and stand for their links.
        comps = components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    found = table.join(classes.select("digest", "rep"), "digest", "left")
    found = found.join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.coalesce("component", "rep", "doc_id")
    return found.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def keep_one(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without those that are near another, smaller document."""
    dropped = written(mark(docs, size, threshold).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "near-dropped")
    return docs.join(broadcast_if_small(dropped), "doc_id", "left_anti").select(*(quoted(n) for n in docs.columns))
