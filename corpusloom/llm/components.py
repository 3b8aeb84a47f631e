"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import discard, materialize


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in a link.

    Each round finds the least label among a node's neighbours, gives it to the node and to the node's old label (which
    hooks whole trees, so a chain in any order takes few rounds), and then takes the label of that label's node. Labels
    are written to the shared folder after every round, which ends the lineage; the joins are shuffle joins, whose
    skewed partitions Spark splits, and what labels are offered is reduced before the shuffle.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    both = materialize(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("c"))
    labels = materialize(labels, "labels")
    while True:
        theirs = labels.select(F.col("id").alias("b"), F.col("c").alias("t"))
        least = both.join(theirs, "b").groupBy("a").agg(F.min("t").alias("t"))
        near = labels.join(least, F.col("id") == F.col("a")).select("id", "c", F.least("c", "t").alias("t"))
        hooks = near.select(F.col("c").alias("id"), F.lit(None).cast(near.schema["c"].dataType).alias("c"), "t")
        near = near.union(hooks).groupBy("id").agg(F.max("c").alias("c"), F.min("t").alias("t"))
        roots = labels.select(F.col("id").alias("t"), F.col("c").alias("r"))
        after = materialize(near.join(roots, "t").select("id", F.col("c").alias("old"), F.least("t", "r").alias("c")), "labels")
        discard(labels)
        if after.where("old <> c").isEmpty():
            discard(both)
            return after.select("id", F.col("c").alias("component"))
        labels = after
