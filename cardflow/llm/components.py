"""Connected components of an edge table, by rounds of Spark jobs.

Every node holds a label, at first the least of itself and its neighbours. A round gives each node the
least label among its own and its neighbours', then replaces each label by that label's own label, so long
chains shorten by a factor each round. All joins are plain equi joins of tables read from the shared folder:
adaptive execution can split a hot node or label. A round's tables are written by as many tasks as their rows need, at least
one for each core: many rounds on few rows would spend their time on empty tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardflow.llm.common import parallelism, written

#: Rows for which a task of its own is worth while.
TASK_ROWS = 20_000


def _tasks(spark: SparkSession, rows: int) -> int:
    return min(parallelism(spark), max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def connected_components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, component): ``component`` is the least node reachable. Nodes without an edge to
    another node are absent; null ends are ignored; repeated edges and loops don't matter."""
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    pairs = written(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-pairs")
    both = pairs.union(pairs.select("v", "u"))
    rows = 2 * pairs.count()
    tasks = _tasks(edges.sparkSession, rows)
    both = written(both.coalesce(tasks), "cc-edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("label"))
                     .coalesce(tasks), "cc-labels")
    while True:
        seen = labels.select(F.col("node").alias("v"), "label")
        offered = both.join(seen, "v").select(F.col("u").alias("node"), "label", F.lit(None).alias("own"))
        lower = written(offered.union(labels.select("node", "label", F.col("label").alias("own"))).groupBy("node")
                        .agg(F.min("label").alias("label"), F.min("own").alias("own")).coalesce(tasks), "cc-lower")
        moved = lower.filter("label < own").limit(1).count()
        if not moved:
            return lower.select("node", F.col("label").alias("component"))
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = written(lower.select("node", "label").join(roots, "label").select("node", F.col("root").alias("label"))
                         .coalesce(tasks), "cc-labels")
