"""Connected components of links between long ids, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.session import materialise


def _flatten(parent: DataFrame) -> DataFrame:
    """Follow parents to the roots by doubling steps; a parent is never larger than its child."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parent = materialise(parent.join(up, "parent").select("node", F.col("above").alias("parent"),
                             (F.col("above") != F.col("parent")).alias("moved")))
        if parent.filter("moved").isEmpty():
            return parent.select("node", "parent")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for every node in ``links(a, b)``.

    Each round every node takes its smallest neighbour as parent, trees are
    flattened, and links are rewritten between roots until none is left. Each step is written
    to the shared folder, so neither plans grow nor does a lost executor undo them.
    """
    links = materialise(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct() \
        .withColumn("root", F.col("node"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = _flatten(both.groupBy(F.col("a").alias("node"))
                          .agg(F.least(F.min("b"), F.first("a")).alias("parent")))
        to = parent.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        labels = materialise(labels.join(to, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")))
        of = {c: parent.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_root"))
              for c in ("a", "b")}
        links = materialise(links.join(of["a"], "a").join(of["b"], "b").filter("a_root <> b_root")
                            .select(F.least("a_root", "b_root").alias("a"),
                                    F.greatest("a_root", "b_root").alias("b")).distinct())
    return labels
