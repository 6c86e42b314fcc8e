"""Each operator against brute force, on a table with the awkward cases in it."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from escrutinio.llm import curve_packing, exact_dedup, line_dedup, near_dedup, simple8b, substring_dedup
from escrutinio.llm.common import ship

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that the operators use themselves.
SCHEMA = "doc_id bigint, text string, lang string, key string, content string, n bigint, place string"


def _words(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{rng.integers(0, 400)}" for _ in range(n)]


def _rows():
    base = _words(1, 60)
    edited = [*base[:50], "other", *base[51:]]
    passage = " ".join(_words(2, 25))
    line = "A line that is long enough to count"
    return [
        (3, " ".join(base)),
        (9, " ".join(base)),
        (5, "\t".join(base).upper()),
        (7, " ".join(edited)),
        (1, f"start {passage} end\n{line}\nshort"),
        (2, f"{passage} {passage}\n  {line.upper()}  \n\nshort"),
        (4, f"unlike {' '.join(_words(3, 30))} {passage}\n{line}\n{line}"),
        (11, None),
        (12, ""),
        (13, "\n \t\n"),
        (14, "É, été — naïve ﬁn!! <|endoftext|> it's 12.5%… ÀB c"),
        (15, " ".join(_words(4, 3000))),
        (16, "x" * 5000),
        (17, "one two"),
        (18, "One  two"),
        (17, "one two"),
        (None, "nobody's text"),
        (None, line + "\n" + passage),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "en", "k", "c", 1, None) for i, t in _rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return ship(spark).createDataFrame([], SCHEMA)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_marks(docs):
    groups = defaultdict(list)
    for i, t in _rows():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    expected = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=str)):
            first = i == keep and i not in sorted(ids, key=str)[:k]
            expected[(i, keep, len(ids), first, _sha(text))] += 1
    assert Counter(map(tuple, exact_dedup.mark(docs).collect())) == expected


@pytest.mark.parametrize("salts", [1, 63])
def test_exact_marks_with_other_salts(docs, salts):
    assert Counter(map(tuple, exact_dedup.mark(docs, salts).collect())) == Counter(map(tuple, exact_dedup.mark(docs).collect()))


def test_exact_deals_a_hot_text_by_salts(spark):
    """The rows of one text meet its winner under several keys, and one of them stays."""
    hot = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same").otherwise(F.concat(F.lit("own "), "id")).alias("text"))
    found = exact_dedup.mark(hot)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(text_sha256" in plan and "salt" in plan.split("hashpartitioning(text_sha256")[1].split(",")[1]
    same = [r for r in found.collect() if r.group_size > 1]
    assert {(r.keep_id, r.group_size) for r in same} == {(1, 666)} and [r.doc_id for r in same if r.kept] == [1]
    with pytest.raises(ValueError, match="63"):
        exact_dedup.mark(hot, salts=64)


def test_exact_keeps_whole_rows_once(docs):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(17) == 1 and 18 in ids and 9 not in ids and ids.count(None) == 2


def test_exact_tells_contents_that_share_a_digest(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "digest", lambda content: F.substring(F.sha2(content.cast("binary"), 256), 1, 1))
    few = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.mark(docs).collect()}
    monkeypatch.undo()
    assert few == {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.mark(docs).collect()}


def _lines_expected(rows, min_docs, min_chars):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            ids = holders.get(key(x), [])
            ids = [*{h for h in ids if h is not None}, *(h for h in ids if h is None)]
            last = max((h for h in ids if h is not None), default=None)
            if len(ids) < min_docs or i == last:
                kept.append(x)
        out[(i, len(lines), len(lines) - len(kept), _sha("\n".join(kept)))] += 1
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines(docs, min_docs):
    found = line_dedup.dedup(docs, min_docs=min_docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == _lines_expected(_rows(), min_docs, 20)


def test_line_runs_merge_by_level(spark):
    ship(spark)
    runs = line_dedup.LineRuns(fanout=2)
    for batch in range(5):
        rows = [(10 * batch + k, bytes([k])) for k in range(batch + 1)]
        runs.add(spark.createDataFrame(rows, "doc_id bigint, key binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    found = {r.key[0]: (r.n_docs, r.max_doc) for r in runs.repeated(2).collect()}
    assert found == {0: (5, 40), 1: (4, 41), 2: (3, 42), 3: (2, 43)}
    new = spark.createDataFrame([(99, bytes([4])), (99, bytes([7]))], "doc_id bigint, key binary")
    assert [r.key[0] for r in runs.fresh(new).collect()] == [7]


def _windows_expected(rows, size):
    seen, out = set(), Counter()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    groups = defaultdict(list)
    for r in order:
        groups[r[0]].append(r)
    for i, same in groups.items():
        news = []
        for _, t in same:
            words = WORD.findall(t or "")
            mark, own = [False] * len(words), set()
            for at in range(len(words) - size + 1):
                w = tuple(words[at : at + size])
                if w in seen or w in own:
                    mark[at : at + size] = [True] * size
                own.add(w)
            news.append(own)
            kept = " ".join(w for w, m in zip(words, mark, strict=True) if not m)
            out[(i, len(words), sum(mark), _sha(kept))] += 1
        seen.update(*news)
    return out


@pytest.mark.parametrize("size", [1, 5, 20])
def test_windows(docs, size):
    found = substring_dedup.dedup(docs, size, bins=3).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == _windows_expected(_rows(), size)


def test_intervals_are_maximal(docs):
    for row in substring_dedup.dedup(docs, 20).collect():
        assert sum(x.stop - x.start for x in row.removed) == row.n_removed
        assert all(a.stop < b.start for a, b in zip(row.removed, row.removed[1:], strict=False))


def _near_expected(rows, size, threshold):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append((i, {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= threshold * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    out = Counter()
    for i, x in sets:
        same = [find(a) for a, y in sets if a is not None and x and x == y]
        component = find(i) if i is not None else min(same, default=None)
        out[(i, len(x), component, component == i)] += 1
    return out


@pytest.mark.parametrize("size", [1, 4, 5])
def test_near(docs, size):
    assert Counter(map(tuple, near_dedup.mark(docs, size).collect())) == _near_expected(_rows(), size, 80)


def test_near_chain_and_blocks(spark, monkeypatch):
    """A chain of edits: neighbours are near, ends are not; with tiny blocks for the rest."""
    ship(spark)
    base = _words(8, 120)
    rows = []
    for k in range(12):
        base = [*base[: 9 * k], f"edit{k}", *base[9 * k + 1 :]] if k else base
        rows.append((100 - k, " ".join(base)))
    rows += [(200 + k, " ".join(_words(50 + k, 80))) for k in range(10)]
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(near_dedup, "BIN_MEMBERS", 1)
    monkeypatch.setattr(near_dedup, "BIN_BYTES", 8)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, near_dedup.mark(frame, 4).collect())) == _near_expected(rows, 4, 80)
    kept = {r.doc_id for r in near_dedup.keep_one(frame, 4).collect()}
    assert kept == {i for i, _, _, k in _near_expected(rows, 4, 80) if k}


def test_keys_meet_within_the_distance():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 16, size=near_dedup._SIZE).astype("<u2")
    most = near_dedup.CHUNKS * (near_dedup.ERRORS + 1) - 1
    for _ in range(50):
        other = one.copy()
        other[rng.choice(len(one), most, replace=False)] ^= 1
        keys = near_dedup.chunk_keys(np.stack((one, other)))
        assert np.intersect1d(keys[0], keys[1]).size


def _ids(text, end):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, end]


def test_packing(docs):
    pieces = curve_packing.pack(docs, PATH, length=64).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[(p.doc_id, p.doc_tokens)].append(p)
        sequences[p.sequence_id].append(p)
        assert p.length == len(p.ids) // 4
    expected = Counter()
    for i, t in _rows():
        expected[(i, np.array(_ids(t, 1), "<u4").tobytes())] += 1
    whole = Counter()
    for (i, n), parts in of.items():
        copies = sum(1 for p in parts if p.start == 0)
        if copies == 1:
            parts.sort(key=lambda p: p.start)
            data = b"".join(p.ids for p in parts)
            assert len(data) == 4 * n
            whole[(i, data)] += 1
        else:
            assert sum(p.length for p in parts) == copies * n
            expected = Counter({k: v for k, v in expected.items() if k[0] != i})
    assert whole == expected
    lengths = []
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
        lengths.append(sum(p.length for p in parts))
        assert lengths[-1] == parts[0].sequence_length
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths)
    assert len([n for n in lengths if n < 64]) <= 6


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_hilbert_visits_neighbours(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
    keys = curve_packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("top", [1, 2, 1 << 16, 1 << 32, (1 << 60) - 1, 1 << 60, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 7, 1024, 5000])
def test_simple8b_round_trip(top, n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, top, size=n, dtype=np.uint64, endpoint=True)
    values[rng.random(n) < 0.5] = 0
    words, offsets = simple8b.encode(values)
    assert (simple8b.decode(words, offsets) == values).all()
    for k, first in enumerate(offsets):
        stop = offsets[k + 1] if k + 1 < len(offsets) else len(words)
        block = simple8b.decode(words[first:stop], np.zeros(1, "<u4"))
        assert (block == values[k * simple8b.BLOCK_IDS : (k + 1) * simple8b.BLOCK_IDS]).all()
    if top < 4:
        assert len(words) <= n / 10 + 20 * (1 + n // simple8b.BLOCK_IDS)


@pytest.mark.parametrize("frame_ids", [1, 300, 1 << 20])
def test_simple8b_files(docs, frame_ids):
    found = simple8b.read(simple8b.write(docs, PATH, 2, frame_ids)).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, _ in _rows()), key=lambda i: (i is not None, i or 0))
    starts = np.cumsum([0, *(r.n_tokens for r in found)])
    assert [r.start for r in found] == starts[:-1].tolist()
    expected = Counter((i, zlib.crc32(np.array(_ids(t, 2), "<u4").tobytes())) for i, t in _rows())
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in found) == expected


def test_empty_tables(empty):
    assert exact_dedup.mark(empty).collect() == [] == exact_dedup.keep_first(empty).collect()
    assert line_dedup.dedup(empty).collect() == [] == substring_dedup.dedup(empty).collect()
    assert near_dedup.mark(empty).collect() == [] == near_dedup.keep_one(empty).collect()
    assert curve_packing.pack(empty, PATH).collect() == [] == simple8b.read(simple8b.write(empty, PATH)).collect()


def test_lines_in_batches_count_each_document_once(spark):
    line = "a line of more than twenty characters"
    rows = [(1, line), (1, line), (2, line), (3, "another line that is long enough")]
    rows += [(k, "a line that many documents share") for k in range(10, 60)] + [(None, "a line that many documents share")]
    docs = ship(spark).createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    expected = _lines_expected(rows, 3, 20)
    for batches, fanout in ((1, 2), (3, 2), (9, 3)):
        found = line_dedup.dedup(docs, batches=batches, fanout=fanout).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
        assert Counter(map(tuple, found.collect())) == expected
    large, line_dedup.LARGE_SHARE = line_dedup.LARGE_SHARE, 1
    try:
        found = line_dedup.dedup(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
        assert Counter(map(tuple, found.collect())) == expected
    finally:
        line_dedup.LARGE_SHARE = large


def test_runs_hold_running_counts_and_a_batch_adds_to_them(spark):
    ship(spark)
    runs = line_dedup.LineRuns(fanout=3)
    for batch in ([(1, b"a"), (2, b"a"), (1, b"b")], [(3, b"a"), (3, b"c")]):
        runs.add(spark.createDataFrame(batch, "doc_id bigint, key binary"))
    newest = {bytes(r.key): (r.n_docs, r.max_doc) for r in runs.runs()[-1].collect()}
    assert newest == {b"a": (3, 3), b"c": (1, 3)}
    asked = spark.createDataFrame([(b"a",), (b"d",)], "key binary")
    assert [bytes(r.key) for r in runs.fresh(asked).collect()] == [b"d"]


def test_names_with_dots_stay(spark):
    docs = ship(spark).createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y")], "doc_id bigint, text string, `a.b` string")
    for kept in (exact_dedup.keep_first(docs), near_dedup.keep_one(docs)):
        assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_bins_follow_the_bytes_and_too_large_a_group_is_an_error(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 30))) for i in range(40)]
    docs = ship(spark).createDataFrame(rows, "doc_id bigint, text string")
    whole = sorted(map(tuple, substring_dedup.dedup(docs).select("doc_id", "n_removed", "kept_sha256").collect()))
    monkeypatch.setattr(substring_dedup, "BIN_BYTES", 100)
    assert sorted(map(tuple, substring_dedup.dedup(docs).select("doc_id", "n_removed", "kept_sha256").collect())) == whole
    large = np.broadcast_to(np.zeros(1, dtype=np.uint64), (1 << 28,))
    with pytest.raises(ValueError, match="more bins"):
        substring_dedup._binary(large, np.array([0, 1 << 28]))
