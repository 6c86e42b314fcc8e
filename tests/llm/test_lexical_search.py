"""Search over K2-treaps against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from escrutinio.llm import lexical_search as search
from escrutinio.llm.common import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k):
    """Rows (item_id, rank, doc_id, score) by scoring all pairs."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if t in c
            )
            scored.append((-score, doc is None, doc or 0, doc))
        best = sorted(x for x in scored if x[0] < 0)[:k]
        rows += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(best)]
    return rows


def check(spark, docs, items, k=10, parts=3, **options):
    ship(spark)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts)
    index = search.build(table, **{n: v for n, v in options.items() if n == "grid_bytes"})
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    found = search.search(index, asked, k, **{n: v for n, v in options.items() if n == "block_terms"})
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda row: tuple((x is None, x or 0) for x in row)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected(docs, items, k), key=key)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 3, 20, 60]))) for _ in range(n)]
    return texts + texts[: n // 4]  # copies tie


@pytest.mark.parametrize(("grid_bytes", "block_terms"), [(1 << 20, 1 << 18), (600, 7), (1, 1)])
def test_any_grids_and_blocks_give_the_same(spark, grid_bytes, block_terms):
    texts = corpus(1, 160 if grid_bytes > 1 else 40)
    items = [(i, t) for i, t in enumerate(corpus(2, 12))]
    check(spark, list(enumerate(texts)), items, grid_bytes=grid_bytes, block_terms=block_terms)


def test_odd_rows(spark):
    docs = [(3, None), (4, ""), (5, "--"), (6, "Ein Wört x1"), (6, "ein WÖRT x1"), (None, "ein wört"), (None, "ein"), (9, "ÄB äb Äb ab"), (2, "x1 " * 5000)]
    items = [(1, "EIN x1"), (1, "wört"), (None, "ab äb"), (2, None), (3, ""), (4, "unknown"), (5, "ein ein ein")]
    check(spark, docs, items)
    check(spark, docs, items, k=1, grid_bytes=8)


def test_one_document_and_a_term_in_all(spark):
    check(spark, [(7, "a")], [(1, "a"), (2, "b")])
    check(spark, [(i, "a") for i in range(40)], [(1, "a")])


def test_empty_tables_and_clashing_columns(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id bigint, text string, score int, `a.b` string")
    items = spark.createDataFrame([("q", "a", 1)], "item_id string, text string, rank int")
    assert [(r.item_id, r.rank, r.doc_id) for r in search.search(search.build(docs), items).collect()] == [("q", 1, 1)]


def test_the_tree_keeps_all_points_and_maxima():
    rng = np.random.default_rng(3)
    code = rng.choice(40 * 300, size=700, replace=False)
    term, doc, impact = code // 300, code % 300, rng.integers(1, 10**6, size=700)
    tree = search.Treap(search.grow(term, doc, impact, 9))
    assert tree.height == 9 and tree.most[0] == impact.max()
    points = dict(zip(zip(term.tolist(), doc.tolist()), impact.tolist()))
    for t in range(40):
        for d in range(0, 300, 7):
            cell = 0
            for level in range(9):
                child = 2 * (t >> (8 - level) & 1) + (d >> (8 - level) & 1)
                mask = int(tree.mask[cell])
                if not mask >> child & 1:
                    cell = None
                    break
                cell = int(tree.first[cell]) + bin(mask & ((1 << child) - 1)).count("1")
            assert (int(tree.most[cell]) if cell is not None else None) == points.get((t, d))


def test_bounds_leave_ranges_unopened():
    """One document far above all others ends the descent early."""
    docs = 4096
    impact = np.full(docs, 10)
    impact[1234] = 900_000
    tree = search.Treap(search.grow(np.zeros(docs, dtype=np.int64), np.arange(docs), impact, 12))
    best, opened = search.Best(1, 1), []
    add = best.add
    best.add = lambda item, *rest: (opened.append(len(item)), add(item, *rest))
    none = np.zeros(docs, dtype=bool)
    search.descend(tree, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.array([5]), best, np.arange(docs), none)
    assert best.doc.tolist() == [1234] and sum(opened) < 100


def test_large_sums_stay_exact():
    values = np.array([1 << 60, 1, 3], dtype=np.int64)
    assert search._totals(values, np.array([0, 0, 1]), 2).tolist() == [(1 << 60) + 1, 3]
    assert search.impacts(np.array([2]), np.array([10**9]), 10**12, 10**14).tolist() == [2 * 10**9 // (2000 + 8 * (10 + 90 * 10**7))]


def test_sizes_of_the_collection(spark):
    ship(spark)
    index = search.build(spark.createDataFrame([(1, "a b"), (2, None), (3, "a")], "doc_id bigint, text string"))
    assert (index.documents, index.terms) == (2, 3)
    assert pa.types.is_binary(index.grids.select("tree").toArrow().schema.field("tree").type)
