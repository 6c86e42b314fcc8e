"""The learned operators and the pseudonyms against plain computations of my own on small tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from escrutinio.llm import language_id, near_dedup, pii, toxicity
from escrutinio.llm.common import ship

KEY = "another key"


def number(kind, turn, value):
    text = f"{KEY}|{kind}|{turn}|{value}|{KEY}"
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def feistel(kind, left, right, a, b):
    for i in range(1, pii.ROUNDS + 1):
        left = (left + number(kind, 2 * i, right) % a) % a
        right = (right + number(kind, 2 * i + 1, left) % b) % b
    return left, right


@pytest.mark.parametrize(("a", "b"), [(10, 10), (7, 12), (1000, 97), (1, 5)])
def test_numbers_are_permuted_by_a_feistel_network(spark, a, b):
    pairs = spark.range(min(a * b, 3000)).selectExpr(f"id % {a} AS l", f"id div {a} AS r")
    found = pairs.select("l", "r", pii.permuted(KEY, "k", F.col("l"), F.col("r"), a, b).alias("p")).collect()
    assert {(r.l, r.r): (r.p.l, r.p.r) for r in found} == {(r.l, r.r): feistel("k", r.l, r.r, a, b) for r in found}
    assert len({tuple(r.p) for r in found}) == len(found)


def shifted(text, pad):
    out = []
    for i, c in enumerate(text):
        by = int(pad[2 * (i % 32) : 2 * (i % 32) + 2], 16)
        for first, n in (("0", 10), ("a", 26), ("A", 26)):
            if 0 <= ord(c) - ord(first) < n:
                c = chr((ord(c) - ord(first) + by) % n + ord(first))
                break
        out.append(c)
    return "".join(out)


def test_texts_keep_their_form_under_a_feistel_network(spark):
    texts = ["", "a", "Z9", "first.last+tag", "x" * 90, "0123-ABC_def", "ü1ß"]

    def plain(text):
        half = len(text) // 2
        left, right = text[:half], text[half:]
        for i in range(1, pii.ROUNDS + 1):
            left = shifted(left, hashlib.sha256(f"{KEY}|k|{2 * i}|{right}|{KEY}".encode()).hexdigest())
            right = shifted(right, hashlib.sha256(f"{KEY}|k|{2 * i + 1}|{left}|{KEY}".encode()).hexdigest())
        return left + right

    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", pii.permuted_text(KEY, "k", F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in found} == {t: plain(t) for t in texts}


LANGUAGES = {
    "en": "the of and with that from thing other where",
    "nl": "het van een met dat uit ding ander waar",
    "de": "der und nicht mit schon auch eine strasse",
    "es": "los que para nino donde tambien manana ellos",
}


def test_margins_and_votes_of_languages(spark):
    rng = np.random.default_rng(3)
    texts = [(lang, " ".join(rng.choice(words.split(), 12))) for lang, words in LANGUAGES.items() for _ in range(12)]
    features = [language_id.sparse(t.encode()) for _, t in texts]
    model = language_id.Model(sorted(LANGUAGES), features, [lang for lang, _ in texts])
    asked = ["The strasse", "x", "", "los van der", "ab" * 4000, None, "É", *(t for _, t in texts[::5])]
    found = model.margins(pa.array(asked, pa.string()))
    for text, margins in zip(asked, found, strict=True):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        index, value = language_id.sparse(low.encode())
        plain = [sum(float(v) * float(model.weights[i, k]) for i, v in zip(index, value)) + model.bias[k] for k in range(len(model.pairs))]
        assert np.allclose(margins, plain, atol=1e-4)
    names, _ = model.predict(pa.array(asked, pa.string()))
    for text, name, margins in zip(asked, names, found, strict=True):
        if name == "und":
            continue

        def winner(kind, among):
            won = Counter()
            for (of, a, b), m in zip(model.pairs, margins, strict=True):
                if of == kind:
                    won[a if m > 0 else b] += 1
            return [x for x in among if won[x] == max(won[y] for y in among)]

        families = winner("family", model.families)
        assert language_id.family(name) in families
        within = [x for x in model.languages if language_id.family(x) == language_id.family(name)]
        assert name in winner(language_id.family(name), within)


def ratios(rows):
    """Log-likelihood ratios of words and bigrams, toxic against ordinary, from (words, toxic) rows."""
    n = [Counter(), Counter()]
    for words, toxic in rows:
        n[toxic].update(zip(["<s>", *words], words))
    heads, nexts = [Counter(), Counter()], [defaultdict(int), defaultdict(int)]
    for c in (0, 1):
        for (before, word), times in n[c].items():
            heads[c][before] += times
            nexts[c][word] += 1
    vocabulary = set(nexts[0]) | set(nexts[1])
    total = [sum(nexts[c].values()) for c in (0, 1)]
    kept = [sum(max(k - toxicity.DISCOUNT, 0) for k in nexts[c].values()) for c in (0, 1)]
    tokens = [sum(n[c].values()) for c in (0, 1)]

    def lower(word):
        shared = (nexts[0].get(word, 0) + nexts[1].get(word, 0) + 0.5) / (sum(total) + 0.5 * (len(vocabulary) + 1))
        out = []
        for c in (0, 1):
            t = max(total[c], 1)
            out.append(max(nexts[c].get(word, 0) - toxicity.DISCOUNT, 0) / t + (1 - kept[c] / t) * shared)
        return out, shared

    def of_word(word):
        own, _ = lower(word)
        return math.log(own[1] / own[0])

    def of_pair(before, word):
        own, shared = lower(word)
        head = [heads[c][before] for c in (0, 1)]
        share = [(head[c] + toxicity.PRIOR * tokens[c] / sum(tokens)) / (sum(head) + toxicity.PRIOR) * own[c] / shared for c in (0, 1)]
        times = [n[c][before, word] for c in (0, 1)]
        p = []
        for c in (0, 1):
            expected = sum(times) * share[c] / max(sum(share), 1e-12)
            p.append((max(times[c] - toxicity.DISCOUNT, 0) + toxicity.PRIOR) / (expected + toxicity.PRIOR) * own[c])
        return math.log(p[1] / p[0])

    pairs = set(n[0]) | set(n[1])
    return lambda before, word: of_pair(before, word) if (before, word) in pairs else of_word(word)


@pytest.mark.parametrize("hot", [0, 40, toxicity.HOT])
def test_likelihood_ratios_of_a_small_table(spark, hot):
    rng = np.random.default_rng(11)
    clean, bad = [f"w{i}" for i in range(30)], ["bad", "worse"]
    rows, i = [], 0
    while len(rows) < 120:
        if zlib.crc32(str(i).encode()) % 4 in (0, 1):  # no row of the calibration fold
            toxic = len(rows) % 2
            words = list(rng.choice(clean + bad * (4 * toxic), 9))
            rows.append((i, words, toxic))
        i += 1
    docs = ship(spark).createDataFrame([(i, " ".join(w)) for i, w, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, toxic int")
    learned = toxicity.learn(docs, labels, hot)
    ratio = ratios([(w, t) for _, w, t in rows])
    asked = [["bad", "w1", "unknown"], ["w3"], rows[0][1], rows[1][1] + ["worse", "worse"]]
    table = {np.uint64(r.key & (2**64 - 1)): r.ratio for r in learned.table.collect()}
    for words in asked:
        column = pa.array([" ".join(words)])
        hashes, offsets = toxicity.word_hashes(column)
        missing, _ = learned.model.missing(column)
        known = np.array(sorted(k for k in missing if k in table and not math.isnan(table[k])), dtype=np.uint64)
        values = np.array([table[k] for k in known], dtype=np.float32)
        mean = learned.model.features(column, known, values)[0, 0]
        plain = [ratio(b, w) for b, w in zip(["<s>", *words], words)]
        assert mean == pytest.approx(sum(plain) / len(plain), abs=1e-4)


def test_near_dedup_finds_every_link_of_the_given_documents(spark):
    """Recall against all pairs of documents that share a shingle."""
    docs = ship(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for r in docs.collect():
        words = (r.text or "").translate(lower).split()  # the texts hold no other white space
        sets[r.doc_id] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    shared = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    found = {r.doc_id: r.component_id for r in near_dedup.mark(docs, size=4).collect()}
    caught = sum(found[a] == found[b] for a, b in links)
    assert len(links) > 50 and caught == len(links)
