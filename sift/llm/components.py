"""Connected components of an edge table by alternating large and small stars.

Every step is a grouped minimum, which Spark combines per task, and a join on
the grouped node, which it can split, so a hub with any number of edges does
not meet in one task. Each round is written to the shared scratch folder, so
the lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sift.session import new_scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read again."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b. The small star joins the
    smaller neighbours of each node to its smallest, the large star the larger
    neighbours."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    joined = both.join(least, "a")
    if small:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b")))
    else:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.where("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b) that is not the least
    of its component; the label is the least node. Nodes may be of any ordered
    type; loops and repeated edges do not matter; nulls must not occur."""
    def stamp(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a > b").distinct(), "components")
    before = stamp(current)
    for _ in range(max_rounds):
        current = written(_star(written(_star(current, small=False), "components"), small=True),
                          "components")
        after = stamp(current)
        if after == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
