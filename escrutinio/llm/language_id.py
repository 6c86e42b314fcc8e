"""Language identification in two steps: the family, then the language within it.

Texts are hashed counts of byte n-grams, relative to the text's length. Linear support
vector machines decide between each two families, and then between each two languages of
the winning family; votes decide, margins break ties. They are trained on the driver by
dual coordinate descent over the features of at most ``PER_LANGUAGE`` labelled rows of each
language, the ones with the smallest hashes of their doc_id. Every text is scored whole, in the tasks.

Cases: a null text, or one without a letter, is ``und`` with score 0. Rows without lang or
doc_id teach nothing. With one learned language all texts with letters are of it; with
none, all are ``und``. Repeated rows are predicted each; an empty table gives an empty
result. Only doc_id, text and lang are read, whatever else there is.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from escrutinio.llm.common import held_out
from escrutinio.llm.text import _LOWER, blocks, buffers

PER_LANGUAGE = 500
#: Texts that every language is denied by some decision score less; see ``keep_known``.
LEAST_SCORE = 0.1
_SALTS = 64
ORDERS = (2, 3, 4)
FEATURE_BITS = 15
#: Weights looked up at once, one for each byte of the texts and pair of the model, and bytes whose
#: features are made at once. Python workers stay, several to an executor, and so does their memory.
_CELLS = 1 << 21
_FEATURE_BYTES = 1 << 18
UNDETERMINED = "und"

# Families of ISO 639-1 codes. A code that is not listed is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = regex.compile(r"\p{L}")


def family(language: str) -> str:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Hashed n-gram at each position of the bytes."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    code = np.zeros(n, dtype=np.uint64)
    for j in range(order):
        code = (code << np.uint64(8)) | data[j : n + j].astype(np.uint64)
    code = (code + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def sparse(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and relative frequencies of one text's features; each order adds up to 1."""
    data = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    indices, values = [], []
    for k, order in enumerate(ORDERS):
        found, counts = np.unique(grams(data, order), return_counts=True)
        indices.append(found + (k << FEATURE_BITS))
        values.append(counts / max(counts.sum(), 1))
    return np.concatenate(indices), np.concatenate(values).astype(np.float32)


def svm(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: float = 1.0, passes: int = 20) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with hinge loss, by dual coordinate descent."""
    weights, bias = np.zeros(size), 0.0
    share = {1: max((signs > 0).sum(), 1), -1: max((signs < 0).sum(), 1)}
    limit = np.array([cost * len(signs) / (2 * share[int(s)]) for s in signs])
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(5)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            gradient = signs[i] * (weights[index] @ value + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * signs[i]
                weights[index] += step * value
                bias += step
                alpha[i] = new
    return weights, bias


class Model:
    """Pairwise SVMs between families and between the languages of each family."""

    def __init__(self, languages: list[str], rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str]):
        """``rows`` are the features of the labelled texts."""
        self.languages = languages
        self.families = sorted({family(x) for x in languages})
        size = len(ORDERS) << FEATURE_BITS
        mean = np.zeros(size)
        for index, value in rows:
            mean[index] += value / max(len(rows), 1)
        scale = 1 / np.sqrt(mean + 1e-4)  # rare n-grams weigh as much as common ones
        rows = [(i, v * scale[i]) for i, v in rows]
        label = np.array(labels, dtype=object)
        kin = np.array([family(x) for x in labels], dtype=object)
        self.pairs: list[tuple[str, str, str]] = []  # (kind, first, second)
        weights = []
        for kind, names, of in [("family", self.families, kin)] + [
            (f, [x for x in languages if family(x) == f], label) for f in self.families
        ]:
            for a, b in combinations(names, 2):
                which = [i for i in range(len(rows)) if of[i] in (a, b)]
                signs = np.array([1 if of[i] == a else -1 for i in which])
                w, bias = svm([rows[i] for i in which], signs, size)
                self.pairs.append((kind, a, b))
                weights.append((w * scale, bias))
        self.weights = np.stack([w for w, _ in weights], axis=1).astype(np.float32) if weights else None
        self.bias = np.array([b for _, b in weights])

    @property
    def block_bytes(self) -> int:
        """Bytes of texts to score at once; the hashes of their n-grams take as much as some eight pairs."""
        return _CELLS // max(len(self.pairs), 8)

    def margins(self, column: pa.Array) -> np.ndarray:
        """The margin of each pair for each row."""
        data, offsets = buffers(column)
        data = _LOWER[data]
        margins = np.tile(self.bias, (len(column), 1))
        for k, order in enumerate(ORDERS):
            counts = np.maximum(np.diff(offsets) - order + 1, 0)
            some = np.flatnonzero(counts)
            if len(some):
                values = self.weights[grams(data, order) + (k << FEATURE_BITS)]
                values = np.concatenate((values, np.zeros((order, values.shape[1]), np.float32)))
                edges = np.stack((offsets[some], offsets[some] + counts[some]), axis=1).ravel()
                margins[some] += np.add.reduceat(values, edges, axis=0, dtype=np.float64)[::2] / counts[some, None]
        return margins

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        texts = column.to_pylist()
        known = [bool(t) and _LETTER.search(t) is not None for t in texts]
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if self.weights is None:
            names = [self.languages[0] if k else UNDETERMINED for k in known]
            return names, np.array(known, dtype=float)
        margin = self.margins(column)
        chosen, sure = self._vote("family", self.families, margin)
        names, score = [], np.zeros(len(texts))
        within = {f: [x for x in self.languages if family(x) == f] for f in self.families}
        inner = {f: self._vote(f, within[f], margin) for f in self.families}
        for i, ok in enumerate(known):
            if not ok:
                names.append(UNDETERMINED)
                continue
            f = self.families[chosen[i]]
            names.append(within[f][inner[f][0][i]])
            score[i] = sure[i] * inner[f][1][i]
        return names, score

    def determined(self, column: pa.Array) -> list[bool]:
        """Whether the language of each text is determined."""
        if not self.languages:
            return [bool(t) and _LETTER.search(t) is not None for t in column.to_pylist()]
        names, score = self.predict(column)
        return [name != UNDETERMINED and s >= LEAST_SCORE for name, s in zip(names, score.tolist(), strict=True)]

    def _vote(self, kind: str, names: list[str], margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner among ``names`` in each row, and how sure its weakest decision is."""
        n = len(margin)
        if len(names) == 1:
            return np.zeros(n, dtype=int), np.ones(n)
        votes, least = np.zeros((n, len(names))), np.full((n, len(names)), np.inf)
        for k, (of, a, b) in enumerate(self.pairs):
            if of == kind:
                value = margin[:, k]
                for name, side in ((a, value), (b, -value)):
                    j = names.index(name)
                    votes[:, j] += (side > 0) + np.tanh(side) * 1e-3
                    least[:, j] = np.minimum(least[:, j], side)
        winner = votes.argmax(axis=1)
        return winner, 1 / (1 + np.exp(-3 * np.clip(least[np.arange(n), winner], -20, 20)))


def sample(docs: DataFrame, per_language: int) -> list:
    """At most ``per_language`` labelled rows of each language, outside the held-out fold."""
    labelled = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    ids = labelled.select("lang", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).alias("_salt"))
    for keys in (["lang", "_salt"], ["lang"]):  # a language can hold most rows: first the best of each salt
        first = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= per_language)
    ids = ids.select("doc_id", "lang").collect()  # bounded by per_language and the number of languages
    if not ids:
        return []
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id bigint, lang string").distinct()
    rows = labelled.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "doc_id", "text")
    found = rows.mapInArrow(_features, "lang string, doc_id bigint, indices binary, values binary")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(len(ids)).collect()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the rows with a letter: what is collected does not grow with the texts."""
    for block in blocks(batches, limit=_FEATURE_BYTES):
        known = [bool(t) and _LETTER.search(t) is not None for t in block.column("text").to_pylist()]
        block = block.filter(pa.array(known, pa.bool_()))
        found = [sparse(t) for t in block.column("text").cast(pa.binary()).to_pylist()]
        indices = pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary())
        values = pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [block.column("lang"), block.column("doc_id"), indices, values], names=["lang", "doc_id", "indices", "values"]
        )


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    rows = sample(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang"), per_language)
    features = [(np.frombuffer(r["indices"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows]
    return Model(sorted({r.lang for r in rows}), features, [r.lang for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with doc_id, held_out, lang_pred and score of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=model.block_bytes):
            names, score = model.predict(block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows_in.mapInArrow(rows, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is determined, with their columns.

    That is texts with a letter whose score is ``LEAST_SCORE`` or more. A model that has learned
    nothing rejects no text with a letter.
    """
    at = docs.columns.index("text")
    fields = docs.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=model.block_bytes):
            yield block.filter(pa.array(model.determined(block.column(at)), pa.bool_()))

    return docs.mapInArrow(rows, fields)
