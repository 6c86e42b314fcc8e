"""Connected components of a table of links, by alternating stars.

Each round links every node's larger neighbours to its smallest one (large star), then its
smaller neighbours and itself to the smallest (small star). The links end as stars around
the smallest node of each component after about log(n) rounds. Every round is an aggregate
and a join, written below spark.checkpoint.dir; nothing is collected but one checksum.
Links are few beside the documents: a round has as many tasks and files as its links ask for, one
for each core at least, and not one for each shuffle partition.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from escrutinio.llm.common import shuffles, written

#: Links that a task of a round has on average, when there are more than the cores take.
TASK_LINKS = 1 << 18


def _tasks(df: DataFrame, tasks: int) -> DataFrame:
    """In ``tasks`` partitions, if these are fewer than the session shuffles into."""
    return df.coalesce(tasks) if tasks < shuffles(df.sparkSession) else df


def _large_star(links: DataFrame, tasks: int) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _tasks(both.groupBy("a").agg(F.min("b").alias("least")), tasks)
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame, tasks: int) -> DataFrame:
    """``links`` point down: a > b."""
    least = _tasks(links.groupBy("a").agg(F.min("b").alias("least")), tasks)
    down = links.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _tasks(down.union(least.select("a", F.col("least").alias("b"))).distinct(), tasks)


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with a link but the smallest itself."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = written(links, "links")
    seen = _checksum(links)
    while True:
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, -(-seen[0] // TASK_LINKS))
        links = written(_small_star(_large_star(links, tasks), tasks), "stars")
        now = _checksum(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = now
