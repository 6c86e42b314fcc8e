"""Measures against a plain computation, and the verdicts on hosts."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from escrutinio.llm import quality_rules as rules
from escrutinio.llm.common import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_full_lines": len(lines),
    }


ODD = [None, "", " \n\t", "a", "é ü\xa0x 日本\n\n a \n a \na", "# | <>&%$*", "x " * 7, "x " * 8, "x " * 9, "a b c d e f g h i " * 3, "ab\n" * 50, "word " * 60_000]


def measured(texts):
    found = rules.measure(pa.array(texts, pa.string()))
    return [{k: int(v[i]) for k, v in found.items()} for i in range(len(texts))]


def test_measures_of_odd_texts():
    assert measured(ODD) == [plain(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é", max_size=120) | st.none(), min_size=1, max_size=6))
def test_measures_of_any_texts(texts):
    assert measured(texts) == [plain(t) for t in texts]


def docs_of(spark, hosts):
    """hosts: name -> (good, bad) numbers of documents."""
    rng = random.Random(5)
    rows = []
    for host, (good, bad) in hosts.items():
        for i in range(good + bad):
            words = [f"word{rng.randrange(5000)}" for _ in range(40)]
            text = " ".join(words) if i < good else " ".join(f"{w} |" for w in words)  # fails symbols, an indirect rule
            rows.append((len(rows), text, host))
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_hosts_are_rejected_by_shrunk_rates(spark):
    ship(spark)
    hosts = {f"good{i}": (40, 1) for i in range(12)} | {"bad": (5, 60), "tiny": (0, 1), None: (0, 5), "": (0, 3)}
    docs = docs_of(spark, hosts)
    kept = {r.source: r.n for r in rules.keep(docs).groupBy("source").agg(F.count("*").alias("n")).collect()}
    # One bad document says too little about a host, and without a host there is no verdict.
    assert kept == {**{f"good{i}": 41 for i in range(12)}, "tiny": 1, None: 5, "": 3}
    found = rules.judge(docs).filter("fails_symbols")
    assert found.filter("base_failed").count() == 0


@pytest.mark.parametrize("share", [4096, 3])
def test_large_and_small_hosts_meet_their_verdicts_alike(spark, monkeypatch, share):
    ship(spark)
    monkeypatch.setattr(rules, "LARGE_SHARE", share)
    docs = docs_of(spark, {"large bad": (0, 90), "large good": (90, 0), "small bad": (0, 30), **{f"g{i}": (9, 0) for i in range(5)}})
    kept = {r.source for r in rules.keep(docs).select("source").distinct().collect()}
    assert kept == {"large good", *(f"g{i}" for i in range(5))}


def test_prior_follows_the_moments():
    class Sums(dict):
        __getattr__ = dict.__getitem__

    def sums(hosts):
        n, f = [x for x, _ in hosts], [x for _, x in hosts]
        return Sums(hosts=len(hosts), of=sum(n), squares=sum(x * x for x in n), f_r=sum(f), q_r=sum(a * a / b for a, b in zip(f, n)))

    mean, weight = rules.prior(sums([(100, 10), (100, 10), (100, 10)]), "r")
    assert mean == pytest.approx(0.1) and weight == rules.PRIOR_WEIGHT[1]  # hosts are alike: to the mean
    mean, weight = rules.prior(sums([(100, 0), (100, 100), (100, 0), (100, 100)]), "r")
    assert mean == pytest.approx(0.5) and weight == rules.PRIOR_WEIGHT[0]  # hosts are all or nothing
    assert rules.prior(sums([]), "r")[0] == 0.0
    assert 10 < rules.prior(sums([(50, 3), (50, 6), (50, 9), (50, 4)]), "r")[1] < 10_000


def test_own_rules_hosts_of_urls_and_clashing_columns(spark):
    ship(spark)
    rows = [(1, "too short", "http://www.A.org:80/x?y", "p"), (2, " ".join(f"w{i}" for i in range(30)), "https://u@a.org/z", "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, url string, `n_words.x` string").withColumn("kept", F.lit(7)).withColumn("host", F.lit("h"))
    hosts = [r.h for r in docs.select(rules.host_of(F.col("url")).alias("h")).collect()]
    assert hosts == ["a.org", "a.org"]
    left = rules.keep(docs, rules.host_of(F.col("url")))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]
    empty = docs.limit(0)
    assert rules.keep(empty, F.col("url")).collect() == [] and rules.judge(empty.withColumn("source", F.lit("s"))).collect() == []
