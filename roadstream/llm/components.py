"""Connected components of an undirected graph, as Spark joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` for each node of ``links`` (columns a, b).

    The label is the least node of the component. In each round a node moves to the
    least of its neighbours, and on to where that one moves; then the edges are drawn
    between the places their ends have moved to, each once, and those within one place
    go. So the edges shrink from round to round, also of a dense graph. Each round is
    written to the shared folder.
    """
    ends = links.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
    edges = stored(ends.filter("src < dst").distinct())
    labels = None
    while True:
        near = edges.select(F.col("src").alias("node"), F.col("dst").alias("near")).union(
            edges.select("dst", "src")
        )
        step = near.groupBy("node").agg(F.min("near").alias("near"))
        first = stored(step.select("node", F.least("node", "near").alias("first")))
        second = first.select(F.col("node").alias("first"), F.col("first").alias("place"))
        places = stored(first.join(second, "first").select("node", "place"))
        if labels is None:
            labels = places.withColumnRenamed("place", "label")
        else:
            moved = places.withColumnRenamed("node", "label")
            labels = stored(
                labels.join(moved, "label", "left").select(
                    "node", F.coalesce("place", "label").alias("label")
                )
            )
        of_src = places.select(F.col("node").alias("src"), F.col("place").alias("p"))
        of_dst = places.select(F.col("node").alias("dst"), F.col("place").alias("q"))
        drawn = edges.join(of_src, "src").join(of_dst, "dst")
        edges = stored(
            drawn.select(F.least("p", "q").alias("src"), F.greatest("p", "q").alias("dst"))
            .filter("src < dst")
            .distinct()
        )
        if edges.isEmpty():
            return labels
