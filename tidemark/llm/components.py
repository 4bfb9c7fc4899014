"""Connected components by alternating large-star and small-star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C


def _least(edges: DataFrame) -> DataFrame:
    """For each u its least v, and the number of its edges."""
    return C.staged(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("__n")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both)
    out = C.staged(C.hot_join(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "stars")
    C.unstage(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    linked = C.hot_join(down, least, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = C.staged(linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
    C.unstage(least)
    return out


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u: then each component is a star, and v its least id."""
    return edges.groupBy("u").count().where("count > 1").isEmpty() and edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For edges (u, v) of long ids: node, root, for every node of an edge; root is the least id it can reach.

    Self links and repeated or reversed edges are harmless; an edge with a null end is ignored; no edges give no rows; other columns are
    ignored. Nodes of very many edges are joined by broadcast. Only counts reach the driver. More than most_rounds rounds are an error.
    """
    now = C.staged(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    for _ in range(most_rounds):
        wide = _large_star(now)
        after = _small_star(wide)
        C.unstage(now, wide)
        now = after
        if _are_stars(now):
            break
    else:
        raise RuntimeError(f"no stars after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
