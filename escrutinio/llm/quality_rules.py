"""Quality rules of documents and of the hosts they come from.

Every document is measured once (words, symbols, repeated lines, words in repeated windows)
and held against the rules of ``RULES``. Failures of each rule are summed up by host. A host
with few documents says little about itself, so its rate is shrunk towards that of all hosts
by a beta prior fitted to the hosts: their mean, and how much more they differ than chance
would have them (Kleinman's moments, weighted by documents). A host is rejected if a shrunk
rate passes ``HOST_LIMIT``, and with it all its documents; a document that fails a rule of
``OWN_RULES`` goes whatever its host.

Scale: the measures are one pass in Arrow batches; the hosts are an aggregate with a map-side
step, the prior is one row per rule. Hosts with 1/``LARGE_SHARE`` of all documents or more, of
which there can be no more than ``LARGE_SHARE``, meet their documents by broadcast under a
key of 32 characters; only rejected hosts among the others are joined, and the documents of
large hosts are spread over all tasks of that join.

Cases: null and empty texts have no words and fail ``short``. A null or empty host has no
verdict: such documents are judged alone. Repeated rows count each. Without documents, or
with one host only, the prior has no spread to fit and rates go to the mean. An empty table
gives an empty result. Extra columns of any name stay with ``keep``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from escrutinio.llm.common import quoted, written
from escrutinio.llm.text import Words, blocks, buffers, inside, mix, windows
from escrutinio.operators.joins import broadcast_if_small

WINDOW = 8
MIN_WORDS = 20
HOST_LIMIT = 0.5
LARGE_SHARE = 4096
#: The prior's weight in documents, at least and at most: a host of a few documents is not rejected for them.
PRIOR_WEIGHT = (10.0, 10_000.0)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What fails a rule, in the measures and n_full_lines (lines with a word).
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_full_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
OWN_RULES = ["short", "repeats"]

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_SPACES = b" \t\n\v\f\r"


def host_of(url: Column) -> Column:
    """The host of a URL, or of a bare host name: lowered, without user, port and ``www.``."""
    rest = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://", "")
    name = F.regexp_replace(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\.", "")
    return F.when(name != "", name)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(words: Words) -> np.ndarray:
    """Words of each row that lie in a window found twice or more in the row."""
    counts = words.counts
    at = inside(words.offsets, WINDOW)
    row_of = np.repeat(np.arange(len(counts)), counts)
    if not len(at):
        return np.zeros(len(counts), dtype=np.int64)
    rows = row_of[at]
    keys = mix(windows(words.hashes(), WINDOW)[at] + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = order[twice]
    if len(found):  # a second hash confirms what the first one found
        second = windows(words.hashes(1), WINDOW, 1)[at[found]]
        by = np.lexsort((second, keys[found]))
        k, s = keys[found][by], second[by]
        same = (k[1:] == k[:-1]) & (s[1:] == s[:-1])
        twice = np.zeros(len(by), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = found[by[twice]]
    steps = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.add.at(steps, at[found], 1)
    np.add.at(steps, at[found] + WINDOW, -1)
    return _sums(np.cumsum(steps)[:-1] > 0, words.offsets)


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text."""
    words = Words(column)
    data, offsets = buffers(column)
    starts = np.ones(len(data) + 1, dtype=np.int64)  # where a code point starts
    starts[:-1] = (data & 0xC0) != 0x80
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(starts[:-1], out=points[1:])
    chars = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.cumsum(points[words.end] - points[words.start], out=chars[1:])
    text = data.tobytes()
    full, dup = np.zeros(len(column), dtype=np.int64), np.zeros(len(column), dtype=np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        lines = [line for line in text[a:b].split(b"\n") if line.strip(_SPACES)]
        full[i], dup[i] = len(lines), len(lines) - len(set(lines))
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": chars[words.offsets[1:]] - chars[words.offsets[:-1]],
        "n_symbols": _sums(_SYMBOL[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": _repeated(words),
        "n_full_lines": full,
    }


def _measured(docs: DataFrame, kept: list[Column]) -> DataFrame:
    """``kept`` columns, ``host`` key, the measures and a flag ``fails_<rule>`` of each rule."""
    rows = docs.select(F.struct(*kept).alias("row"), F.col("_host").alias("host"), F.col("text"))
    names = [*MEASURES, "n_full_lines"]
    schema = StructType([rows.schema["row"], rows.schema["host"], *(StructField(n, LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = measure(block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), block.column("host"), *(pa.array(found[n]) for n in names)], names=["row", "host", *names]
            )

    return rows.mapInArrow(run, schema).select("*", *(F.expr(rule).alias(f"fails_{name}") for name, rule in RULES.items()))


def _with_host(docs: DataFrame, host: Column) -> DataFrame:
    host = host.cast("string")
    return docs.withColumn("_host", F.when(host != "", F.md5(host)))


def host_rates(measured: DataFrame) -> DataFrame:
    """host, n (its documents), of (documents of all hosts), and per rule the shrunk rate."""
    fails = {name: F.sum(F.col(f"fails_{name}").cast("bigint")) for name in RULES}
    hosts = measured.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *(total.alias(f"f_{name}") for name, total in fails.items())
    )
    hosts = written(hosts, "hosts")
    n = F.col("n").cast("double")
    sums = [F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("of"), F.sum(n * n).alias("squares")]
    for name in RULES:
        f = F.col(f"f_{name}").cast("double")
        sums += [F.sum(f).alias(f"f_{name}"), F.sum(f * f / n).alias(f"q_{name}")]
    found = hosts.agg(*sums).first()
    rates = [shrunk(F.col(f"f_{r}"), F.col("n"), *prior(found, r)).alias(f"rate_{r}") for r in RULES]
    return hosts.select("host", "n", F.lit(found.of or 0).alias("of"), *rates)


def prior(sums, rule: str) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta prior of ``rule``, from sums over the hosts."""
    if not sums.hosts:
        return 0.0, PRIOR_WEIGHT[1]
    total = float(sums.of)
    mean = sums[f"f_{rule}"] / total
    chance = mean * (1 - mean)
    spread = sums[f"q_{rule}"] - total * mean * mean
    free = sums.hosts - 1
    room = chance * (total - sums.squares / total - free)
    gamma = (spread - chance * free) / room if room > 0 else 0.0
    weight = 1 / gamma - 1 if gamma > 0 else PRIOR_WEIGHT[1]
    return mean, min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])


def shrunk(failed: Column, n: Column, mean: float, weight: float) -> Column:
    return (failed + F.lit(mean * weight)) / (n + F.lit(weight))


def _judged(measured: DataFrame, limit: float) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``."""
    rates = host_rates(measured)
    worst = F.greatest(*(F.col(f"rate_{name}") for name in RULES))
    verdicts = rates.select("host", (worst > limit).alias("rejected"), (F.col("n") * LARGE_SHARE >= F.col("of")).alias("large"))
    large = verdicts.filter("large").select("host", F.col("rejected").alias("_large"))
    small = verdicts.filter("NOT large AND rejected").select(F.col("host").alias("_small"))
    rows = measured.join(F.broadcast(large), "host", "left")
    # Only hosts that are not large look for a small one; all other rows are spread.
    spread = F.concat(F.lit("spread "), F.rand(7).cast("string"))
    rows = rows.withColumn("_key", F.when(F.col("host").isNull() | F.col("_large").isNotNull(), spread).otherwise(F.col("host")))
    rows = rows.join(broadcast_if_small(small), F.col("_key") == F.col("_small"), "left")
    own = F.greatest(*(F.col(f"fails_{name}") for name in OWN_RULES))
    rejected = F.coalesce("_large", F.col("_small").isNotNull())
    return rows.withColumn("base_failed", own).withColumn("kept", ~own & ~rejected)


def judge(docs: DataFrame, host: Column | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the measures, n_full_lines, fails_<rule>, base_failed and kept of every row.

    ``host`` is the column ``source`` if not given. The measures are written once.
    """
    host = F.col("source") if host is None else host
    rows = _with_host(docs.select("doc_id", "text", host.alias("_host")), F.col("_host"))
    measured = written(_measured(rows, [F.col("doc_id").cast("bigint").alias("doc_id")]), "measures")
    flags = [f"fails_{name}" for name in RULES]
    return _judged(measured, limit).select("row.doc_id", *MEASURES, "n_full_lines", *flags, "base_failed", "kept")


def keep(docs: DataFrame, host: Column | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    host = F.col("source") if host is None else host
    rows = docs.select(F.struct(*(quoted(n) for n in docs.columns)).alias("_row"), quoted("text").alias("text"), host.alias("_host"))
    measured = written(_measured(_with_host(rows, F.col("_host")), [F.col("_row")]), "measures")
    return _judged(measured, limit).filter("kept").select("row._row.*")
