"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond").  Every step is two joins over the edges, cut with checkpoint();
nothing is collected but one count and checksum per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streamkit.llm.registry import cut


def _sum(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); ``root`` is the
    smallest node that can be reached.  Loops, repeats and both directions
    may occur; rows with a null end are left out.  An empty table gives none."""
    state = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _sum(state)
    while before[0]:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        old, state = state, cut(large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .where("a <> b").unionByName(low.withColumnRenamed("m", "b")).distinct())
        after = _sum(state)
        if after == before and state.join(old, ["a", "b"], "left_anti").isEmpty():  # as many edges, none of them new
            break
        before = after
    star = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
