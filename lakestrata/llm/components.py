"""Connected components of a graph held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import stored
from lakestrata.llm.repeats import join_hot


def components(edges: DataFrame) -> DataFrame:
    """The nodes of ``edges`` (a, b) with one node of their component: node, root.

    Each round every node moves to the neighbour that comes first in an order
    drawn anew by hash, and the graph is contracted along these moves; loops and
    repeated edges go. An expected constant share of the nodes goes each round,
    also on long paths, so the rounds are about the logarithm of the largest
    component. Hubs and large components are spread by ``join_hot``. Edges with
    a null end are left out; no edges give no rows.
    """
    live = stored(edges.select("a", "b").filter("a is not null and b is not null and a <> b").distinct(), "cc-edges")
    labels = live.select(F.col("a").alias("node")).union(live.select("b")).distinct()
    labels = stored(labels.withColumn("root", F.col("node")), "cc-labels")
    nodes = labels.count()
    turn = 0
    while count := live.count():
        both = live.union(live.select("b", "a")).union(live.select("a", F.col("a").alias("b")))
        moves = both.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(turn))).alias("to"))
        moves = stored(moves.withColumnRenamed("a", "at"), "cc-moves")
        labels = stored(_moved(labels, "root", moves, nodes), "cc-labels")
        live = _moved(_moved(live, "a", moves, count), "b", moves, count)
        live = stored(live.filter("a <> b").distinct(), "cc-edges")
        turn += 1
    return labels


def _moved(df: DataFrame, col: str, moves: DataFrame, rows: int) -> DataFrame:
    """``df`` with ``col`` replaced by where it moves; what does not move stays."""
    used = df.groupBy(col).agg(F.count("*").alias("_uses"))
    used = used.join(moves, F.col(col) == F.col("at"), "left")
    used = used.select(col, F.coalesce("to", col).alias("_to"), "_uses")
    moved = join_hot(df, used, col, "_uses", rows)
    return moved.select(*[F.col("_to").alias(c) if c == col else F.col(c) for c in df.columns])
