"""Connected components by hooking roots and contracting the links, as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def pointed(links: DataFrame) -> DataFrame:
    """root, to: each larger end of a link points to the least smaller end it is linked with, and pointers are followed to their end."""
    to = written(links.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")), "pointers")
    while True:
        step = lambda rows, old, new: rows.join(to.select(F.col("root").alias(old), F.col("to").alias("_next")), old, "left").withColumn(new, F.coalesce("_next", old)).drop("_next")
        after = written(step(step(to.select("root", "to"), "to", "second"), "second", "third").select("root", F.col("third").alias("to"), (F.col("third") != F.col("second")).alias("moved")), "pointers")
        forget(to)
        to = after
        if to.filter("moved").isEmpty():
            return to


def components(edges: DataFrame) -> DataFrame:
    """v, label of every end of an edge; label is the least vertex that v reaches. edges: a, b, both long.

    In a round each root with a smaller root next to it hooks onto the least
    such one; pointers are followed until all are roots, which takes as many
    steps as their length has binary digits, and links are contracted to links
    between different roots. Of two linked roots the larger one always goes,
    so in chance order a round leaves a fraction of them (64 vertices in a row take 4
    rounds, 1,000 take 6) and works on what is left. No rows come to the
    driver but whether some are left. Repeated edges and edges from a vertex
    to itself are as none, so is one with a null end; a vertex without other
    edges has no row. No edges give no rows.
    """
    links = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = links.select(F.col("a").alias("v")).union(links.select("b")).distinct().withColumn("label", F.col("v"))
    done, left = [links], links
    while not left.isEmpty():
        to = pointed(left)
        done.append(to)
        at = to.select("root", F.col("to").alias("_to"))
        move = lambda rows, c: rows.join(at.withColumnRenamed("root", c), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")  # noqa: E731, B023
        labels = move(labels, "label")
        ends = move(move(left, "a"), "b").filter("a <> b")
        left = written(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        done.append(left)
    out = written(labels.select("v", "label"), "labels")
    forget(*done)
    return out


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """v, label after further links; only the components that they join are gone through again. links: a, b."""
    a, b = (labels.select(F.col("v").alias(k), F.col("label").alias(f"l{k}")) for k in "ab")
    edges = links.join(a, "a", "left").join(b, "b", "left")
    ends = edges.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    lower = components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()).withColumnRenamed("label", "low").withColumnRenamed("v", "label")
    fresh = ends.select(F.col("a").alias("v")).union(ends.select("b")).distinct().join(labels, "v", "left_anti").withColumn("label", F.col("v"))
    every = labels.select("v", "label").union(fresh).join(lower, "label", "left")
    return written(every.select("v", F.coalesce("low", "label").alias("label")), "labels")
