"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import drop_stored, store

#: Times that a round follows the images of images: a node moves up to 2^JUMPS
#: steps towards its local minimum.
JUMPS = 2


def contract(edges: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, image) of every node of ``edges``, and the edges between the
    images. Nodes are ordered by a hash that changes with ``seed``; a node's
    image is reached by walking to the smallest neighbour a few times."""
    rank = lambda c: F.xxhash64(F.lit(seed), F.col(c))
    nearest = edges.groupBy("a").agg(F.min_by("b", rank("b")).alias("b"))
    step = store(nearest.select(F.col("a").alias("node"), F.when(rank("b") < rank("a"), F.col("b"))
                                .otherwise(F.col("a")).alias("image")), "images")
    for _ in range(JUMPS):
        far = step.select(F.col("node").alias("image"), F.col("image").alias("next"))
        moved = store(step.join(far, "image").select("node", F.col("next").alias("image")), "images")
        drop_stored(step)
        step = moved
    left = step.select(F.col("node").alias("a"), F.col("image").alias("x"))
    right = step.select(F.col("node").alias("b"), F.col("image").alias("y"))
    shrunk = store(edges.join(left, "a").join(right, "b").where("x <> y")
                   .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    return step, shrunk


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long), where the
    component is its smallest node.

    Each round contracts the graph: every node moves to a local minimum of an
    order of its own round, drawn by hashing, so no numbering of the nodes (a
    history of versions with ascending ids, say) can make a chain slow: at least
    about half of the nodes of a chain or a star go in a round. The maps of
    the rounds get smaller with the graph and are put together backwards at the
    end. Only tables move: nothing but a test for emptiness reaches the driver.
    """
    plain = edges.select("a", "b").where("a <> b")
    current = store(plain.unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    steps: list[DataFrame] = []
    while not current.isEmpty():
        step, shrunk = contract(current, len(steps))
        drop_stored(current)
        steps.append(step)
        current = shrunk
    if not steps:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    roots = steps.pop()
    while steps:
        step = steps.pop()
        on = roots.select(F.col("node").alias("image"), F.col("image").alias("root"))
        whole = store(step.join(on, "image", "left").select("node", F.coalesce("root", "image").alias("image")), "roots")
        drop_stored(step, roots)
        roots = whole
    smallest = roots.groupBy("image").agg(F.min("node").alias("component"))
    labels = store(roots.join(smallest, "image").select("node", "component"), "labels")
    drop_stored(roots)
    return labels
