"""Alignment of two tokenizers against a plain computation over all pairs of tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from escrutinio.llm import alignment
from escrutinio.llm.common import ship

FIRST, SECOND = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    "a  b", "a  b", "a  b", "a\n b", "a \nb \n", "  x", "x  ", "x▁y", "<|endoftext|> <s> a", "①  ﬁ é",
    "it's  we'll 'x", "日本 語 テ", "　 x　 　y", None, "", " ", "\x00 \x00", "é é", "a \t b", "- - -", "1 2 3  4", "word " * 3000,
]


@pytest.fixture(scope="module")
def tools():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND), {i: t for t, i in first.get_vocab().items()}


def plain(tools, text):
    """Counts, links and hash by comparing every token with every other, or None without tokens."""
    first, second, vocabulary = tools
    if not text:
        return None
    letters = alignment.byte_of_letter()
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    bytes_a = [bytes(letters[c] for c in vocabulary[i]) for i in a]
    bytes_b = [alignment.Pieces._bytes(second.id_to_piece(i)) for i in b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    i = j = 0
    groups, links = [], []
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append((a[i:k], b[j:m]))
        for x in range(i, k):
            for y in range(j, m):
                if max(ends_a[x] - len(bytes_a[x]), ends_b[y] - len(bytes_b[y])) < min(ends_a[x], ends_b[y]):
                    links.append((a[x], b[y]))
        i, j = k, m
    text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    return len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest()


def expected(tools, texts):
    found = [plain(tools, t) for t in texts]
    docs = Counter(pair for f in found if f for pair in set(f[3]))
    highest = defaultdict(int)
    for (a, _), n in docs.items():
        highest[a] = max(highest[a], n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(docs[p] == highest[p[0]] for p in f[3])
            rows.append((f[0], f[1], f[2], len(f[3]), best, sum(docs[p] for p in f[3]), f[4]))
    return rows


def check(spark, tools, texts, docs, **options):
    found = alignment.align_documents(docs, FIRST, SECOND, **options).collect()
    want = expected(tools, texts)
    assert sorted(tuple(r) for r in found) == sorted((i, *w) for i, w in enumerate(want))


def test_odd_texts_in_small_blocks(spark, tools):
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(ODD * 2)), "doc_id bigint, text string")
    check(spark, tools, ODD * 2, docs.repartition(3), block_bytes=64)


def test_given_documents(spark, tools):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = docs.collect()
    assert [r.doc_id for r in rows] == list(range(len(rows)))
    check(spark, tools, [r.text for r in rows], docs.repartition(4))


def test_empty_table_and_clashing_columns(spark):
    ship(spark)
    empty = spark.createDataFrame([], "doc_id bigint, text string, n_a string")
    assert alignment.align_documents(empty, FIRST, SECOND).collect() == []
    one = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id bigint, text string, `n.a` string, block int")
    assert alignment.align_documents(one, FIRST, SECOND).first().n_a == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms(use_true_random=False))
def test_align_follows_any_two_cuts(steps, random):
    total = sum(steps)
    a = np.cumsum(steps)
    b = np.array(sorted({*(x for x in range(1, total) if random.random() < 0.5), total}))
    link_a, link_b, end_a, end_b = alignment.align(a, b)
    shared = sorted(set(a.tolist()) & set(b.tolist()))
    assert [a[i - 1] for i in end_a] == shared == [b[j - 1] for j in end_b]
    start_a, start_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
    want = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(start_a[i], start_b[j]) < min(a[i], b[j])]
    assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want


def test_long_one_to_one_stretches_are_jumped():
    a = np.arange(1, 100_001)
    b = np.concatenate((a[:5], a[7:60_000], a[60_001:]))
    link_a, link_b, end_a, end_b = alignment.align(a, b)
    assert len(link_a) == len(a) and len(end_a) == len(b)
    assert np.array_equal(np.unique(link_b), np.arange(len(b)))
