"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models of words, one of toxic and one of ordinary documents, are counted in
Spark over all labelled rows outside the held-out fold, every word and bigram of them. Each
discounts its continuation counts and backs off to those of both classes together. The
occurrences of a bigram are expected in the classes as those of its first word, tilted by its
second; its discounted count in each class is mixed with ``PRIOR`` occurrences as expected.
An expression too rare to tell costs both models nearly the same; none is left out.

The counts of all bigrams and words are one Spark table of sorted, packed hashes. A block of
documents asks it for its distinct bigrams and words by ranges of the hash, gets the counts back,
and makes the ratios of them. Documents are worked off in ``SLICES`` parts, so that what they ask
and what is counted is on disk a part at a time. Where all ratios are ``HOT`` or fewer they go
to the tasks instead. Which way a ratio is found does not change it.

A document has length-normalised comparisons of the likelihoods, toxic against ordinary:
over the whole text, and over its most toxic stretches of ``SPANS`` words, which a long
text does not dilute. A logistic function of them gives the score. It is fitted on at most
``CALIBRATION`` labelled rows of one fold (remainder 3), scored by ratios of the same counts
without those rows; the scores use the counts of all.

Cases: null and empty texts have the comparison 0 and the score that goes with it. Rows
without a label, or whose labels contradict each other, teach nothing. Without labelled
rows of both classes every score is the share of toxic ones, or 0. Repeated rows are scored
each; an empty table gives an empty result. Only doc_id and text are read for a score.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from escrutinio.folders import remove_folder
from escrutinio.llm.common import held_out, shuffles_released, written
from escrutinio.llm.text import Words, blocks, mix
from escrutinio.operators.joins import broadcast_if_small
from escrutinio.session import scratch_dir

HOT = 1 << 18
SPANS = (1, 3, 12)
CALIBRATION = 20_000
DISCOUNT = 0.75
PRIOR = 8.0
CUTOFF = 0.3
_BLOCK_BYTES = 1 << 22

#: Parts of the documents and of the bigrams, of the bytes of text given at least, that are on disk at a time.
SLICES = 4
_COUNTED_SLICES = 2
_SLICE_BYTES = 1 << 24
#: Bytes of text of a block that asks at once, and labelled ones for each range of the hashes.
_ASKING_BYTES = 1 << 21
_BIN_BYTES = 1 << 24
_BINS = 24
_PACKED_ROWS = 1 << 19

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(b".,;:!?\"'()[]{}*#$%&-_/|")] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lowered words without punctuation at their ends, and the rows' offsets."""
    words = Words(column, lower=True)
    for edge, step in ((words.end, -1), (words.start, 1)):
        at = np.arange(len(edge))
        for _ in range(3):
            at = at[_PUNCTUATION[words.data[edge[at] - (step < 0)]] & (words.end[at] - words.start[at] > 1)]
            edge[at] += step
    return words.hashes(), words.offsets


def _rows_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def bigram_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two words; a word alone is its own key."""
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


def looked_up(keys: np.ndarray, ratios: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The ratios of the wanted keys, NaN where there is none; ``keys`` ascends."""
    if not len(keys):
        return np.full(len(wanted), np.nan, dtype=np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ratios[at], np.float32(np.nan))


@dataclass
class Model:
    """All log-likelihood ratios or none of them, and the logistic function on top."""

    keys: np.ndarray  # sorted hashes of bigrams and words
    ratios: np.ndarray  # NaN if only the calibration sample has the key
    unseen: float  # ratio of a word that no labelled row has
    logistic: np.ndarray

    def missing(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Keys that the model lacks, and their rows."""
        words, offsets = word_hashes(column)
        pairs, rows = bigram_keys(previous(words, offsets), words), _rows_of(offsets)
        far = ~self._has(pairs)
        lone = far & ~self._has(words)
        keys = np.concatenate((pairs[far], words[lone]))
        rows = np.concatenate((rows[far], rows[lone]))
        order = np.lexsort((keys, rows))
        keys, rows = keys[order], rows[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
        return keys[new], rows[new]

    def _has(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), dtype=bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)] == wanted

    def features(self, column: pa.Array, keys: np.ndarray, ratios: np.ndarray) -> np.ndarray:
        """The mean ratio of each text and those of its most toxic spans.

        ``keys`` and ``ratios`` are what the table has of the missing keys.
        """
        words, offsets = word_hashes(column)
        ratio = np.full(len(words), np.nan, dtype=np.float64)
        for wanted in (bigram_keys(previous(words, offsets), words), words):
            for table in ((self.keys, self.ratios), (keys, ratios)):
                open_ = np.flatnonzero(np.isnan(ratio))
                ratio[open_] = looked_up(*table, wanted[open_])
        return self.of_ratios(ratio, offsets)

    def of_ratios(self, ratio: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The same from the ratio of each word, NaN where there is none."""
        out = np.zeros((len(offsets) - 1, 1 + len(SPANS)))
        if not len(ratio):
            return out
        ratio[np.isnan(ratio)] = self.unseen
        sums = np.concatenate(([0.0], np.cumsum(ratio)))
        counts = np.diff(offsets)
        full = counts > 0
        out[full, 0] = (sums[offsets[1:]] - sums[offsets[:-1]])[full] / counts[full]
        starts, ends, length = np.arange(len(ratio)), np.repeat(offsets[1:], counts), np.repeat(counts, counts)
        for k, span in enumerate(SPANS):
            # Short of the text's end a span is cut, but still divided by its full length.
            sides = sums[np.minimum(starts + span, ends)] - sums[starts]
            out[full, k + 1] = np.maximum.reduceat(sides / np.minimum(span, length), offsets[:-1][full])
        return out


@dataclass
class Learned:
    """A model, the table of all ratios (key, ratio, base: without the calibration sample), and the counts."""

    model: Model
    table: DataFrame
    whole: bool  # the model has the whole table
    counts: "Counts"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def expanded(features: np.ndarray) -> np.ndarray:
    return np.concatenate((np.ones((len(features), 1)), features), axis=1)


def previous(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The word before each; 0 stands for the start of a text."""
    before = np.zeros_like(words)
    before[1:] = words[:-1]
    before[offsets[:-1][np.diff(offsets) > 0]] = 0
    return before


def fit_logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights by Newton's method with a small ridge."""
    x = expanded(features)
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ weights)
        gradient = x.T @ (labels - p) - 1e-2 * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _smoothed(kinds: np.ndarray, total: float, kept: float, shared: np.ndarray) -> np.ndarray:
    """Continuation probabilities of one class over those of both, from its totals."""
    return np.maximum(kinds - DISCOUNT, 0) / total + (1 - kept / total) * shared


def _backoff(continuations: np.ndarray, shared: np.ndarray) -> np.ndarray:
    return _smoothed(continuations, max(continuations.sum(), 1), np.maximum(continuations - DISCOUNT, 0).sum(), shared)


@dataclass
class Totals:
    """Words, tokens, and continuations of all words, before and after the discount, of each class."""

    words: int
    tokens: tuple[float, float]
    total: tuple[float, float]
    kept: tuple[float, float]

    def lower(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backoff probabilities of both classes (2 x n), and those they share."""
        shared = (kinds.sum(axis=0) + 0.5) / (sum(self.total) + 0.5 * (self.words + 1))
        return np.stack([_smoothed(kinds[c], max(self.total[c], 1), self.kept[c], shared) for c in (0, 1)]), shared

    def unseen(self) -> float:
        lower, _ = self.lower(np.zeros((2, 1)))
        return float(np.log(lower[1] / lower[0])[0])


def _word_ratios(totals: Totals, kinds: np.ndarray) -> np.ndarray:
    lower, _ = totals.lower(kinds)
    return np.where(kinds.sum(axis=0) > 0, np.log(lower[1] / lower[0]), np.nan)


def _bigram_ratios(totals: Totals, n: np.ndarray, kinds: np.ndarray, head: np.ndarray) -> np.ndarray:
    """``n``, the continuations ``kinds`` of the second word and the counts ``head`` of the first are 2 x bigrams."""
    lower, shared = totals.lower(kinds)
    usual = np.array(totals.tokens)[:, None] / max(sum(totals.tokens), 1)
    share = (head + PRIOR * usual) / (head.sum(axis=0) + PRIOR) * lower / shared
    expected = n.sum(axis=0) * share / np.maximum(share.sum(axis=0), 1e-12)
    own = (np.maximum(n - DISCOUNT, 0) + PRIOR) / (expected + PRIOR) * lower
    return np.where(n.sum(axis=0) > 0, np.log(own[1] / own[0]), np.nan)


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    """A table of bounded size as arrays on the driver."""
    table = df.toArrow()
    return {name: table.column(name).to_numpy().copy() for name in table.column_names}


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic (0 or 1) and fold of the labelled rows outside the held-out fold."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    known = known.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most").drop("_most")
    known = known.filter(~held_out(F.col("doc_id"))).withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    known = known.withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(broadcast_if_small(known), "doc_id")


def _range(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` equal ranges of the 64-bit numbers each key is in; a multiple of ``n`` divides these ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _ranges(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, slice]]:
    """The ranges that ascending keys are in, the keys of each and their place."""
    edges = np.searchsorted(_range(keys, n), np.arange(n + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(edges)):
        place = slice(int(edges[b]), int(edges[b + 1]))
        yield int(b), keys[place], place


def _bigrams(batches: Iterator[pa.RecordBatch], part: int = 0, parts: int = 1) -> Iterator[pa.RecordBatch]:
    """Bigrams of each class (toxic + 2 * held) within a block; those of one range of the keys."""
    for block in blocks(batches, limit=_BLOCK_BYTES):
        words, offsets = word_hashes(block.column("text"))
        before = previous(words, offsets)
        group = block.column("group").to_numpy()[_rows_of(offsets)].astype(np.uint64)
        keys = bigram_keys(before, words)
        mine = np.flatnonzero(_range(keys, parts) == part)
        before, words, group, keys = before[mine], words[mine], group[mine], (keys[mine] & ~np.uint64(3)) | group[mine]
        _, first, number = _distinct_at(keys)
        counts, order = np.bincount(number, minlength=len(first)), np.argsort(before[first])  # equal words side by side
        first, counts = first[order], counts[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array(before[first].view(np.int64)), pa.array(words[first].view(np.int64)), pa.array(group[first].astype(np.int32)), pa.array(counts)],
            names=["before", "word", "group", "n"],
        )


#: Counts of all rows, and without the calibration sample.
_SETS = ("all", "base")


def _seen(kind: str, c: int) -> Column:
    return F.col(f"n{c}") if kind == "all" else F.col(f"n{c}") - F.col(f"h{c}")


def _some(x: Column) -> Column:
    return F.sum((x > 0).cast("bigint"))


_STATS = [f"{s}_{kind}{c}" for kind in ("head", "next") for s in _SETS for c in (0, 1)]
_N = ["n0", "n1", "h0", "h1"]


def _column(block: pa.RecordBatch, name: str) -> np.ndarray:
    return block.column(block.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte, so that what they have in common goes."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unplaned(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(8, n).T).view(np.uint64).reshape(n)


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unplaned(data, n), dtype=np.uint64)


@dataclass
class Counts:
    """The counts of all bigrams and words, packed by ranges of their keys: bin, n, keys, stats.

    Bins below ``bins`` have the counts ``_N`` of bigrams, those from there on the ``_STATS`` of words.
    """

    table: DataFrame
    bins: int
    totals: dict[str, Totals]


_COUNTS = "bin int, n int, keys binary, stats binary"


def _packed(rows: DataFrame, names: list[str], bins: int, first: int, key: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """One row for each bin of ``rows``, whose keys are distinct, with the columns ``names``; packed before they are shuffled."""

    def table(parts: list[tuple[np.ndarray, np.ndarray]], ranges: int) -> pa.Table:
        keys, stats = np.concatenate([k for k, _ in parts]), np.concatenate([x for _, x in parts], axis=1)
        order = np.argsort(keys)
        keys, stats = keys[order], stats[:, order]
        found = [(b + first, k, np.ascontiguousarray(stats[:, place])) for b, k, place in _ranges(keys, ranges)]
        return pa.table({
            "bin": pa.array([b for b, _, _ in found], pa.int32()),
            "n": pa.array([len(k) for _, k, _ in found], pa.int32()),
            "keys": pa.array([pack(k) for _, k, _ in found], pa.binary()),
            "stats": pa.array([_planes(x.reshape(-1)) for _, _, x in found], pa.binary()),
        })

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for block in batches:
            if len(block):
                parts.append((key(block), np.stack([_column(block, n) for n in names]).astype(np.int64)))
                size += len(block)
            if size >= _PACKED_ROWS:
                yield from table(parts, bins).to_batches()
                parts, size = [], 0
        if parts:
            yield from table(parts, bins).to_batches()

    def one(chunks: pa.Table) -> pa.Table:
        parts = []
        for n, keys, stats in zip(*(chunks.column(name).to_pylist() for name in ("n", "keys", "stats"))):
            parts.append((unpack(keys, n), _unplaned(stats, len(names) * n).view(np.int64).reshape(len(names), n)))
        return table(parts, 1).set_column(0, "bin", chunks.column("bin").slice(0, 1))

    return rows.mapInArrow(chunks, _COUNTS).groupBy("bin").applyInArrow(one, _COUNTS)


def _pair_keys(block: pa.RecordBatch) -> np.ndarray:
    return bigram_keys(_column(block, "before").view(np.uint64), _column(block, "word").view(np.uint64))


def _bigram_counts(counted: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """before, word and the counts ``_N`` of the bigrams of one range of keys."""
    groups = [F.sum(F.when(F.col("group").isin(*of), F.col("n")).otherwise(0)).alias(name) for name, of in zip(_N, ((0, 2), (1, 3), (2,), (3,)))]
    found = counted.select("text", "group").mapInArrow(lambda batches: _bigrams(batches, part, parts), "before bigint, word bigint, group int, n bigint")
    return found.groupBy("before", "word").agg(*groups)


def _word_parts(bigrams: DataFrame) -> DataFrame:
    """word and its ``_STATS`` in these bigrams: counts as the first word, distinct ones as the second."""
    zero = F.lit(0).cast("bigint")
    x = {f"{s}{c}": _seen(s, c) for s in _SETS for c in (0, 1)}
    heads = bigrams.groupBy(F.col("before").alias("word")).agg(*(F.sum(x[k]).alias(f"{k[:-1]}_head{k[-1]}") for k in x))
    nexts = bigrams.groupBy("word").agg(*(_some(x[k]).alias(f"{k[:-1]}_next{k[-1]}") for k in x))
    filled = [df.select("word", *((F.col(n) if n in df.columns else zero).alias(n) for n in _STATS)) for df in (heads, nexts)]
    return filled[0].unionByName(filled[1])


def _text_bytes(rows: DataFrame) -> int:
    return rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0


def _slices(size: int, most: int) -> int:
    return min(most, 1 + size // _SLICE_BYTES)


def _count(counted: DataFrame) -> tuple[Counts, DataFrame, int]:
    """The packed counts of the labelled rows, the table of the words, and the number of bigrams and words."""
    spark = counted.sparkSession
    size = _text_bytes(counted)
    slices = _slices(size, _COUNTED_SLICES)
    bins = slices * max(1, -(-max(_BINS, size // _BIN_BYTES) // slices))
    packed_path, parts_path = scratch_dir(spark, "llm-toxic-counts"), scratch_dir(spark, "llm-toxic-word-parts")
    part_schema = "word bigint, " + ", ".join(f"{n} bigint" for n in _STATS)
    for part in range(slices):
        path = scratch_dir(spark, "llm-toxic-bigrams")
        _bigram_counts(counted, part, slices).write.parquet(path)
        bigrams = spark.read.schema("before bigint, word bigint, " + ", ".join(f"{n} bigint" for n in _N)).parquet(path)
        _word_parts(bigrams).write.mode("append").parquet(parts_path)
        _packed(bigrams, _N, bins, 0, _pair_keys).write.mode("append").parquet(packed_path)
        remove_folder(spark, path)
    words = spark.read.schema(part_schema).parquet(parts_path).groupBy("word").agg(*(F.sum(n).alias(n) for n in _STATS))
    words = written(words, "toxic-words")
    remove_folder(spark, parts_path)
    _packed(words, _STATS, bins, bins, lambda block: _column(block, "word").view(np.uint64)).write.mode("append").parquet(packed_path)
    packed = spark.read.schema(_COUNTS).parquet(packed_path)
    n = packed.agg(F.sum(F.col("n").cast("bigint"))).first()[0] or 0
    return Counts(packed, bins, _totals(words)), words, n


def _totals(words: DataFrame) -> dict[str, Totals]:
    kept = lambda x: F.greatest(x - DISCOUNT, F.lit(0.0))
    sums = []
    for s in _SETS:
        for c in (0, 1):
            at = F.col(f"{s}_next{c}")
            sums += [F.sum(f"{s}_head{c}").alias(f"{s}_tokens{c}"), F.sum(at).alias(f"{s}_total{c}"), F.sum(kept(at)).alias(f"{s}_kept{c}")]
        sums.append(_some(F.col(f"{s}_next0") + F.col(f"{s}_next1")).alias(f"{s}_words"))
    found = words.agg(*sums).first()
    return {
        s: Totals(found[f"{s}_words"] or 0, *(tuple(float(found[f"{s}_{k}{c}"] or 0) for c in (0, 1)) for k in ("tokens", "total", "kept"))) for s in _SETS
    }


def _ratio_table(bigrams: DataFrame, words: DataFrame, totals: dict[str, Totals]) -> DataFrame:
    """key, ratio and base of every bigram and word."""

    def packed(keys: np.ndarray, ratios: list[np.ndarray]) -> pa.RecordBatch:
        values = [pa.array(keys.view(np.int64)), *(pa.array(r.astype(np.float32)) for r in ratios)]
        return pa.RecordBatch.from_arrays(values, names=["key", "ratio", "base"])

    def both(block: pa.RecordBatch, name: str) -> np.ndarray:
        return np.stack([_column(block, f"{name}{c}") for c in (0, 1)]).astype(float)

    def lone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            yield packed(_column(block, "word").view(np.uint64), [_word_ratios(totals[s], both(block, f"{s}_next")) for s in _SETS])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            n, held = both(block, "n"), both(block, "h")
            seen = (("all", n), ("base", n - held))
            ratios = [_bigram_ratios(totals[s], x, both(block, f"{s}_next"), both(block, f"{s}_head")) for s, x in seen]
            yield packed(_pair_keys(block), ratios)

    schema = "key bigint, ratio float, base float"
    heads = words.select(F.col("word").alias("before"), *(n for n in _STATS if "head" in n))
    nexts = words.filter("all_next0 + all_next1 > 0").select("word", *(n for n in _STATS if "next" in n))
    return bigrams.join(heads, "before").join(nexts, "word").mapInArrow(pairs, schema).unionByName(nexts.mapInArrow(lone, schema))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def _distinct_at(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, a place of each, and the number of each place's key among them."""
    order = np.argsort(keys)
    ascending = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ascending[1:] != ascending[:-1]
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ascending[new], order[new], number


def _by_bin(pairs: np.ndarray, words: np.ndarray, bins: int) -> Iterator[tuple[int, np.ndarray, slice]]:
    """Bin, keys and their place among the distinct keys that a block asks for."""
    for keys, first in ((pairs, 0), (words, bins)):
        for b, some, place in _ranges(keys, bins):
            yield first + b, some, place


def _asked(column: pa.Array, bins: int) -> list[tuple[int, np.ndarray, slice]]:
    """The distinct bigrams and words of a block, and the start of a text among the words."""
    words, offsets = word_hashes(column)
    pairs = _distinct(bigram_keys(previous(words, offsets), words))
    return list(_by_bin(pairs, _distinct(np.append(words, np.uint64(0))), bins))


def _found_ratios(column: pa.Array, answers: pa.Table, bins: int, totals: Totals, base: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ratio of each word of a block after the word before it, NaN for one that was never counted, and the rows' offsets."""
    words, offsets = word_hashes(column)
    pairs, first, pair = _distinct_at(bigram_keys(previous(words, offsets), words))
    known, _, word = _distinct_at(np.append(words, np.uint64(0)))
    counts, stats = np.zeros((len(_N), len(pairs)), dtype=np.int64), np.zeros((len(_STATS), len(known)), dtype=np.int64)
    places = {b: place for b, _, place in _by_bin(pairs, known, bins)}
    for b, found, data in zip(*(answers.column(n).to_pylist() for n in ("bin", "found", "stats"))):
        out = (counts if b < bins else stats)[:, places[b]]
        at = np.flatnonzero(np.unpackbits(np.frombuffer(found, dtype=np.uint8), count=out.shape[1]))
        out[:, at] = _unplaned(data, len(out) * len(at)).view(np.int64).reshape(len(out), len(at))
    head, kinds = (stats[i : i + 4][2 * base : 2 * base + 2].astype(float) for i in (0, 4))
    n = counts[:2] - counts[2:] * base
    seen = np.flatnonzero(n[0] + n[1])
    before = previous(word[:-1], offsets)  # the start of a text, 0, is the least of the known
    of_pairs = np.full(len(pairs), np.nan, dtype=np.float32)
    of_pairs[seen] = _bigram_ratios(totals, n[:, seen].astype(float), kinds[:, word[first[seen]]], head[:, before[first[seen]]])
    ratio = of_pairs[pair].astype(float)
    open_ = np.flatnonzero(np.isnan(ratio))
    ratio[open_] = _word_ratios(totals, kinds).astype(np.float32)[word[:-1][open_]]
    return ratio, offsets


def _answered(asks: pa.Table, counts: pa.Table, bins: int) -> pa.Table:
    """What the counts of a bin have of the keys that each block asks for."""
    out = {"block": [], "bin": [], "found": [], "stats": []}
    if len(asks) and len(counts):
        b, n, have, stats = (counts.column(name)[0].as_py() for name in ("bin", "n", "keys", "stats"))
        width = len(_N) if b < bins else len(_STATS)
        have = unpack(have, n)
        stats = _unplaned(stats, width * n).reshape(width, n)
        for block, m, keys in zip(*(asks.column(name).to_pylist() for name in ("block", "n", "keys"))):
            keys = unpack(keys, m)
            at = np.minimum(np.searchsorted(have, keys), n - 1)
            found = have[at] == keys
            if found.any():
                out["block"].append(block)
                out["bin"].append(b)
                out["found"].append(np.packbits(found).tobytes())
                out["stats"].append(_planes(np.ascontiguousarray(stats[:, at[found]]).reshape(-1)))
    pa.default_memory_pool().release_unused()
    return pa.table(out, schema=pa.schema([("block", pa.int64()), ("bin", pa.int32()), ("found", pa.binary()), ("stats", pa.binary())]))


def _with_features(rows: DataFrame, learned: Learned, base: bool) -> DataFrame:
    """The features in place of the texts of ``rows``."""
    model, counts, spark = learned.model, learned.counts, rows.sparkSession
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "features array<double>"])

    def featured(block: pa.RecordBatch | pa.Table, features: np.ndarray) -> list:
        return [*(block.column(f.name) for f in others), pa.array(list(features), pa.list_(pa.float64()))]

    names = [*(f.name for f in others), "features"]
    if learned.whole:

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.float32)
            for block in blocks(batches):
                yield pa.RecordBatch.from_arrays(featured(block, model.features(block.column("text"), *none)), names=names)

        return rows.mapInArrow(alone, schema)

    bins, totals = counts.bins, counts.totals["base" if base else "all"]

    def text(block: pa.Table) -> pa.Array:
        return pa.concat_arrays(block.column("text").chunks) if len(block) else pa.array([], pa.string())

    def asks(block: pa.Table) -> pa.Table:
        found = _asked(text(block), bins)
        at = block.column("_block")[0].as_py()
        pa.default_memory_pool().release_unused()
        return pa.table({
            "bin": pa.array([b for b, _, _ in found], pa.int32()),
            "block": pa.array([at] * len(found), pa.int64()),
            "n": pa.array([len(keys) for _, keys, _ in found], pa.int32()),
            "keys": pa.array([pack(keys) for _, keys, _ in found], pa.binary()),
        })

    def features(block: pa.Table, answers: pa.Table) -> pa.Table:
        found = model.of_ratios(*_found_ratios(text(block), answers, bins, totals, base))
        pa.default_memory_pool().release_unused()
        return pa.table(featured(block, found), names=names)

    def answered(asks: pa.Table, counted: pa.Table) -> pa.Table:
        return _answered(asks, counted, bins)

    size = _text_bytes(rows)
    n, slices, path = 1 + size // _ASKING_BYTES, _slices(size, SLICES), scratch_dir(spark, "llm-toxic-features")
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64(*(f.name for f in rows.schema.fields)), F.lit(n)))
    for part in range(slices):
        some = blocked.filter(F.col("_block") % slices == part)
        asked = some.select("_block", "text").groupBy("_block").applyInArrow(asks, "bin int, block bigint, n int, keys binary")
        found = asked.groupBy("bin").cogroup(counts.table.groupBy("bin")).applyInArrow(answered, "block bigint, bin int, found binary, stats binary")
        answers = scratch_dir(spark, "llm-toxic-answers")
        found.write.parquet(answers)
        told = spark.read.schema(found.schema).parquet(answers)
        some.groupBy("_block").cogroup(told.groupBy("block")).applyInArrow(features, schema).write.mode("append").parquet(path)
        remove_folder(spark, answers)
    return spark.read.schema(schema).parquet(path)


def learn(docs: DataFrame, labels: DataFrame, hot: int = HOT) -> Learned:
    with shuffles_released(docs.sparkSession):
        return _learn(docs, labels, hot)


def _learn(docs: DataFrame, labels: DataFrame, hot: int) -> Learned:
    rows = labelled(docs, labels)
    ids = rows.filter("fold = 3").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION)
    ids = written(ids, "toxic-calibration")
    held = F.broadcast(ids.withColumn("held", F.lit(2)))
    counted = rows.join(held, "doc_id", "left").select("text", "toxic", (F.col("toxic") + F.coalesce("held", F.lit(0))).alias("group"))
    classes = {r.toxic: r.n for r in counted.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts, words, n = _count(counted)
    table, whole = _ratio_table(_bigram_counts(counted), words, counts.totals), n <= hot
    if whole:
        table = written(table, "toxic-ratios")
        top = _columns(table)
    else:
        top = {"key": np.zeros(0, dtype=np.int64), "ratio": np.zeros(0, dtype=np.float32), "base": np.zeros(0, dtype=np.float32)}
    order = np.argsort(top["key"].view(np.uint64))
    keys, ratio, of_base = top["key"].view(np.uint64)[order], top["ratio"][order], top["base"][order]
    base = Model(keys, of_base, counts.totals["base"].unseen(), np.zeros(0))
    some = written(rows.join(F.broadcast(ids), "doc_id", "left_semi").select("toxic", "text"), "toxic-calibrated")
    told = _with_features(some, Learned(base, table, whole, counts), True).limit(CALIBRATION).collect()
    truth = np.array([r.toxic for r in told], dtype=float)
    if len(set(truth)) == 2 and len(classes) == 2:
        logistic = fit_logistic(np.array([r.features for r in told]), truth)
    else:
        n = sum(classes.values())
        share = classes.get(1, 0) / n if n else 0.0
        logistic = np.array([np.log(max(share, 1e-9)) - np.log(max(1 - share, 1e-9)), *[0.0] * (1 + len(SPANS))])
    return Learned(Model(keys, ratio, counts.totals["all"].unseen(), logistic), table, whole, counts)


def score(docs: DataFrame, learned: Learned) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    logistic = learned.model.logistic

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            features = block.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(block), 1 + len(SPANS))
            scores = sigmoid(expanded(features) @ logistic)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(scores), pa.array((scores >= CUTOFF).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    with shuffles_released(docs.sparkSession):
        found = _with_features(rows_in, learned, False)
    return found.mapInArrow(rows, "doc_id bigint, held_out boolean, score double, predicted int")
