"""Alignment of two tokenizers' ids over the same bytes.

Both tokenizers cut a text into tokens, told by the bytes at which they end. The two lists of
ends are followed side by side: while tokens pair off one to one, the index into the one list
less the index into the other, the shift, stays the same. Exponential probing compares
stretches of both lists at the present shift, twice as long each time, and jumps them whole;
where a stretch differs, halving finds the first difference. There the tokens are irregular:
they are resolved one by one up to the next end that both lists share, which closes a group
and gives the new shift.

A link is a pair of tokens whose bytes overlap; a group of a and b tokens has a + b - 1 of
them. The count of an id pair is the number of documents that hold it linked. Tasks align
blocks of documents and write for each block its pairs with their documents, and the links of
its documents as indexes into these pairs. Spark sums up the counts by pair, finds the
highest of each id, and joins them back to the blocks' pairs; then each block adds up its
documents' links. A block is bounded by its bytes, so a pair that all documents hold has one
row per block, and nothing grows with the corpus.

Cases: null and empty texts, and those whose tokens do not give back space and text byte by
byte, have no tokens: zeros and ''. Very long texts are a block of their own. Rows that repeat
a doc_id are documents of their own and count each. An empty table gives an empty result.
Only doc_id and text are read. Both files must be at their paths on every executor.
"""

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm.common import shuffles, written
from escrutinio.llm.text import blocks

BLOCK_BYTES = 1 << 20
_NEAR = 8
_OPEN: dict = {}
# Fixed value: how a byte-level vocabulary of this kind parts a text before it looks for tokens.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Visible characters of Latin-1 stand for themselves, the other bytes for the letters from
    U+0100 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE given as a file of the tokenizers library.

    Where its merges are in the order of the ids they give, and it parts texts as ``_PARTS``
    does, tiktoken finds the same tokens several times as fast; else the library itself does.
    Special tokens have no meaning inside texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_of_letter()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes])
        self.ranked = self._ranked(path, letters)

    def _ranked(self, path: str, letters: dict):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        special = {t["id"] for t in parts["added_tokens"]}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
        made = ["".join(m) for m in merges]
        vocabulary = parts["model"]["vocab"]
        ordered = [vocabulary.get(t) for t in made] == list(range(256, 256 + len(made)))
        plain = parts["pre_tokenizer"] | {"trim_offsets": None} == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": None, "use_regex": True,
        }
        if not (ordered and plain and not parts["normalizer"]):
            return None
        ranks = {b: i for i, b in enumerate(self.bytes) if b and i not in special}
        return tiktoken.Encoding("ranked", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        texts = [" " + t for t in texts]
        if self.ranked is not None:
            return [self.ranked.encode_ordinary(t) for t in texts]
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts a space before each text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.bytes = [self._bytes(self.library.id_to_piece(i)) for i in range(n)]
        self.lengths = np.array([len(b) for b in self.bytes])

    @staticmethod
    def _bytes(piece: str) -> bytes:
        if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers."""

    def __init__(self, first: str, second: str):
        self.kinds = (ByteLevel(first), Pieces(second))
        self.digits = tuple(_digits(len(k.lengths)) for k in self.kinds)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers of each text; none for a text without tokens."""
        texts = [t or "" for t in texts]
        out = []
        for text, *ids in zip(texts, *(kind.encode(texts) for kind in self.kinds), strict=True):
            whole = b" " + text.encode("utf-8")
            same = text and all(b"".join(map(kind.bytes.__getitem__, of)) == whole for kind, of in zip(self.kinds, ids, strict=True))
            out.append(tuple(np.array(of if same else [], dtype=np.int64) for of in ids))
        return out


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal text of each number below ``n``, left-aligned, and its length."""
    width = len(str(n))
    text = np.char.ljust(np.arange(n).astype(f"S{width}"), width)
    return text.view(np.uint8).reshape(n, width), np.char.str_len(np.arange(n).astype(f"S{width}"))


def opened(first: str, second: str) -> Pair:
    """The worker's tokenizers, loaded once per process."""
    if (first, second) not in _OPEN:
        _OPEN[first, second] = Pair(first, second)
    return _OPEN[first, second]


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (indexes into both lists, ascending) and the ends of the groups in both lists.

    Both lists ascend strictly and have the same last end. Stretches are compared as bytes.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    raw_a, raw_b = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    n, m = len(a), len(b)
    a.append(-1)  # no end equals what stands behind the last one
    b.append(-2)
    starts, shifts, stops, irregular_a, irregular_b, closed_a, closed_b = [], [], [], [], [], [], []
    i = j = 0
    while i < n:
        if a[i] == b[j]:
            # Tokens pair off at this shift: a few one by one, then stretches of doubled length.
            at, shift = i + 1, j - i
            near, far = at + _NEAR, at + shift
            while at < near and a[at] == b[far]:
                at += 1
                far += 1
            if at == near:
                step = 2 * _NEAR
                while step:
                    low, high = 8 * at, 8 * (at + step)
                    if at + step <= n and raw_a[low:high] == raw_b[low + 8 * shift : high + 8 * shift]:
                        at += step
                        step *= 2
                    else:
                        step //= 4  # the difference is within: look nearer
                while a[at] == b[at + shift]:
                    at += 1
            starts.append(i)
            shifts.append(shift)
            stops.append(at)
            i, j = at, at + shift
        if i >= n:
            break
        # An irregular group, token by token up to the next end that both share.
        x, y = a[i], b[j]
        while True:
            irregular_a.append(i)
            irregular_b.append(j)
            if x == y:
                break
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        closed_a.append(i)
        closed_b.append(j)
    first = np.array(starts, dtype=np.int64)
    lengths = np.array(stops, dtype=np.int64) - first
    run_a = np.arange(lengths.sum()) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    run_b = run_a + np.repeat(np.array(shifts, dtype=np.int64), lengths)
    link_a = np.concatenate((run_a, np.array(irregular_a, dtype=np.int64)))
    link_b = np.concatenate((run_b, np.array(irregular_b, dtype=np.int64)))
    slot = np.full(n + m, -1)
    slot[link_a + link_b] = np.arange(len(link_a))  # each link raises the sum of the indexes
    order = slot[slot >= 0]
    end_a, end_b = _marked(n, run_a + 1, closed_a), _marked(m, run_b + 1, closed_b)
    return link_a[order], link_b[order], end_a, end_b


def _marked(n: int, *places) -> np.ndarray:
    """All the places up to n, ascending."""
    found = np.zeros(n + 1, dtype=bool)
    for at in places:
        found[at] = True
    return np.flatnonzero(found)


def _group_text(ids: tuple, ends: tuple, digits: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;...`` over all groups, and the place behind each group's text."""
    counts = [np.diff(e, prepend=0) for e in ends]
    total = len(ids[0]) + len(ids[1])
    width = max(d[0].shape[1] for d in digits) + 1
    text = np.zeros((total, width), dtype=np.uint8)
    size = np.zeros(total, dtype=np.int64)
    before = (np.concatenate(([0], ends[1][:-1])), ends[0])  # tokens of the other kind ahead
    for k, mark in ((0, ord("|")), (1, ord(";"))):
        if not len(ids[k]):
            continue
        at = np.arange(len(ids[k])) + np.repeat(before[k], counts[k])
        text[at, : digits[k][0].shape[1]] = digits[k][0][ids[k]]
        length = digits[k][1][ids[k]]
        separator = np.full(len(at), ord(","), dtype=np.uint8)
        separator[ends[k] - 1] = mark
        text[at, length] = separator
        size[at] = length + 1
    flat = text[np.arange(width) < size[:, None]]
    return flat, np.cumsum(size)[ends[0] + ends[1] - 1] if len(ends[0]) else np.zeros(0, dtype=np.int64)


def aligned_block(ids: list[tuple[np.ndarray, np.ndarray]], lengths: tuple, digits: tuple) -> dict:
    """Alignment of a block's documents: counts per document, group texts' hashes, links.

    ``link_doc``, ``link_a`` and ``link_b`` hold for each link its document and both ids.
    """
    tokens = [np.concatenate([x[k] for x in ids]) for k in (0, 1)]
    n = [np.array([len(x[k]) for x in ids], dtype=np.int64) for k in (0, 1)]
    ends = [np.cumsum(lengths[k][tokens[k]]) for k in (0, 1)]
    link_a, link_b, end_a, end_b = align(*ends)
    bounds = np.cumsum(n[0])
    groups = np.searchsorted(end_a, bounds, side="right")  # groups up to each document's end
    flat, after = _group_text(tuple(tokens), (end_a, end_b), digits)
    raw, shas, last = flat.tobytes(), [], 0
    for some, g in zip((n[0] > 0).tolist(), groups.tolist(), strict=True):
        if some:
            stop = int(after[g - 1])
            shas.append(hashlib.sha256(raw[last : stop - 1]).hexdigest())
            last = stop
        else:
            shas.append("")
    doc = np.searchsorted(bounds, link_a, side="right")
    return {
        "n_a": n[0],
        "n_b": n[1],
        "n_groups": np.diff(groups, prepend=0),
        "n_links": np.bincount(doc, minlength=len(ids)),
        "groups_sha256": shas,
        "link_doc": doc,
        "link_a": tokens[0][link_a],
        "link_b": tokens[1][link_b],
    }


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_BLOCK = pa.schema(
    [
        ("docs", pa.list_(pa.int64())),
        *((name, pa.list_(pa.int64())) for name in _COUNTS),
        ("shas", pa.list_(pa.string())),
        ("links", pa.binary()),
        ("first", pa.list_(pa.int32())),
        ("second", pa.list_(pa.int32())),
        ("held", pa.list_(pa.int32())),
    ]
)


def _packed(doc: np.ndarray, index: np.ndarray, size: int) -> tuple[bytes, np.ndarray]:
    """Each document's pairs and how often it links them, compressed; and the documents per pair."""
    code, times = np.unique(doc * size + index, return_counts=True)
    at, of = code % max(size, 1), code // max(size, 1)
    columns = (of.astype("<i4"), at.astype("<i4"), times.astype("<i4"))
    data = np.concatenate([c.view(np.uint8).reshape(-1, 4).T.ravel() for c in columns])  # like bytes together
    return zstandard.ZstdCompressor(level=1).compress(data.tobytes()), np.bincount(at, minlength=size)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    if not len(raw):
        return (np.zeros(0, dtype=np.int64),) * 3
    n = len(raw) // 12
    return tuple(np.ascontiguousarray(raw[4 * n * k : 4 * n * (k + 1)].reshape(4, n).T).view("<i4").ravel().astype(np.int64) for k in range(3))


def _blocks(docs: DataFrame, first: str, second: str, limit: int) -> DataFrame:
    """One row per block of documents: their counts, links, and the block's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = opened(first, second)
        lengths = tuple(k.lengths for k in pair.kinds)
        for block in blocks(batches, limit=limit):
            found = aligned_block(pair.encode(block.column("text").to_pylist()), lengths, pair.digits)
            keys, index = np.unique(found["link_a"] << 32 | found["link_b"], return_inverse=True)
            links, held = _packed(found["link_doc"], index, len(keys))
            row = {
                "docs": block.column("doc_id"),
                **{name: found[name] for name in _COUNTS},
                "shas": found["groups_sha256"],
                "first": (keys >> 32).astype(np.int32),
                "second": (keys & 0xFFFFFFFF).astype(np.int32),
                "held": held.astype(np.int32),
            }
            columns = []
            for field in _BLOCK:
                if field.name == "links":
                    columns.append(pa.array([links], pa.binary()))
                else:
                    values = row[field.name]
                    values = values if isinstance(values, pa.Array) else pa.array(values, field.type.value_type)
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            yield pa.RecordBatch.from_arrays(columns, schema=_BLOCK)

    kinds = ", ".join(f"{n} array<bigint>" for n in ["docs", *_COUNTS])
    schema = f"{kinds}, shas array<string>, links binary, first array<int>, second array<int>, held array<int>"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # The number of a block is fixed when the table has been written.
    return written(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "aligned")


def pair_counts(found: DataFrame) -> DataFrame:
    """first, second, docs (documents that hold the pair linked) and best (of its first id)."""
    counts = found.groupBy("first", "second").agg(F.sum("held").alias("docs"))
    counts = written(counts, "pairs")
    highest = counts.groupBy("first").agg(F.max("docs").alias("_most"))
    return counts.join(highest, "first").select("first", "second", "docs", (F.col("docs") == F.col("_most")).alias("best"))


def align_documents(docs: DataFrame, first: str, second: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    ``first`` is the path of a byte-level tokenizer, ``second`` that of a sentencepiece model.
    """
    done = _blocks(docs, first, second, block_bytes)
    pairs = done.select("block", F.posexplode(F.arrays_zip("first", "second", "held")).alias("place", "p"))
    pairs = pairs.select("block", "place", "p.first", "p.second", "p.held")
    counts = pair_counts(pairs)
    answers = pairs.drop("held").join(counts, ["first", "second"]).select(F.col("block").alias("of"), "place", "docs", "best")
    n = shuffles(docs.sparkSession)
    left = done.drop("first", "second", "held").repartition(n, "block").groupBy("block")
    right = answers.repartition(n, "of").groupBy("of")

    def total(block: pa.Table, found: pa.Table) -> pa.Table:
        doc, index, times = _unpacked(block.column("links")[0].as_buffer().to_pybytes())
        ids = block.column("docs")[0].values
        place = found.column("place").to_numpy()
        size = int(place.max()) + 1 if len(place) else 0
        count, best = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        count[place] = found.column("docs").to_numpy()
        best[place] = found.column("best").to_numpy(zero_copy_only=False)

        def per_document(values: np.ndarray) -> pa.Array:
            out = np.zeros(len(ids), dtype=np.int64)
            np.add.at(out, doc, values)
            return pa.array(out)

        columns = [ids, *(block.column(name)[0].values for name in _COUNTS)]
        columns += [per_document(times * best[index]), per_document(times * count[index]), block.column("shas")[0].values]
        return pa.Table.from_arrays(columns, names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    schema = "doc_id bigint, " + ", ".join(f"{n} bigint" for n in [*_COUNTS, "n_best", "count_sum"]) + ", groups_sha256 string"
    return left.cogroup(right).applyInArrow(total, schema)
