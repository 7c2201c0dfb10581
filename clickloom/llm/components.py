"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import discard, freeze

#: Links to a file, where that makes more files than tasks run at a time.
ROWS = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b); the label is the component's least node.

    Each round a node and the node it is labelled with take the least label among the node's
    neighbours, then labels follow their own labels, so long paths shrink by doubling. A node of
    very many links is summed up per task first, and its join can be split. One shuffle a round
    where the labels are small enough to be broadcast; no links give an empty table.
    """
    spark = links.sparkSession
    one = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = freeze(one.union(one.select("v", "u")).where("u <> v").distinct())
    # small tables need no more files than tasks run at a time
    files = max(spark.sparkContext.defaultParallelism, edges.count() // ROWS)
    labels = freeze(
        edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")).coalesce(files)
    )
    while True:
        mine = lambda k: labels.select(F.col("node").alias(k), F.col("label").alias(f"l{k}"))
        both = edges.join(mine("v"), "v").join(mine("u"), "u")
        none = F.lit(None).cast("bigint").alias("old")
        hooked = (
            labels.select("node", F.col("label").alias("old"), F.col("label").alias("new"))
            .union(both.select("u", none, "lv")).union(both.select("lu", none, "lv"))
            .groupBy("node").agg(F.max("old").alias("old"), F.min("new").alias("new"))
        )
        up = hooked.select(F.col("node").alias("new"), F.col("new").alias("label"))
        before, labels = labels, freeze(hooked.join(up, "new").select("node", "old", "label").coalesce(files))
        discard(before)
        if labels.where("old <> label").isEmpty():
            discard(edges)
            return labels.select("node", "label")
