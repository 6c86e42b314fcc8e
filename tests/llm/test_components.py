"""Components against union-find, and the tasks of their rounds."""

import random

import pytest

from escrutinio.llm import components as C


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def found(spark, links):
    rows = C.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


@pytest.mark.parametrize("task_links", [C.TASK_LINKS, 40])
def test_components_are_those_of_union_find(spark, monkeypatch, task_links):
    monkeypatch.setattr(C, "TASK_LINKS", task_links)  # many tasks leave the shuffle's partitions alone
    rng = random.Random(11)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 230)] + [(300, 300), (7, 7)]
    assert found(spark, links) == plain(links)


def test_a_round_over_few_links_has_a_task_for_each_core(spark, monkeypatch):
    rounds = []

    def kept(df, purpose):
        out = written(df, purpose)
        rounds.append((purpose, len(out.inputFiles())))
        return out

    written = C.written
    monkeypatch.setattr(C, "written", kept)
    cores, names = spark.sparkContext.defaultParallelism, ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ("false", str(4 * cores)), strict=True):
        spark.conf.set(name, value)
    try:
        links = [(i, i + 1) for i in range(40 * cores)]
        assert found(spark, links) == plain(links)
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert 0 < max(n for purpose, n in rounds if purpose == "stars") <= cores
