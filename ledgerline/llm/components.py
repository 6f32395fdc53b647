"""Connected components of a link table, as DataFrame joins.

Alternating large-star / small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step replaces each link by
one to the smallest node seen around it, so paths shorten until each
component is a star around its smallest node. Neighbourhoods are only ever
reduced with ``min`` (map-side) and joined back; no component is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """links: (a > b). Larger neighbours of every node go to its smallest."""
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (links.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """links: (a > b). A node and its smaller neighbours go to the smallest."""
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = (links.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u")
             .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _is_star_forest(links: DataFrame) -> bool:
    ends = links.select(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        links.select(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    odd = ends.groupBy("n").agg(F.sum("out").alias("o"), F.max("in").alias("i")).where("o > 1 or (o = 1 and i = 1)")
    return odd.limit(1).count() == 0


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (two columns of one type);
    ``component`` is the component's smallest node. Self-links and repeated
    links are fine; links with a null end are ignored. An empty table gives
    an empty result."""
    x, y = (F.col(c) for c in links.columns[:2])
    links = stage(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"), x.eqNullSafe(y).alias("self"),
                               (x.isNull() | y.isNull()).alias("none"))
                  .where("not none").drop("none").distinct(), "links")
    loops = links.where("self").select(F.col("a").alias("node"))
    now = links.where("not self").select("a", "b")
    while not _is_star_forest(now):
        now = stage(_small_star(_large_star(now)), "stars")
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).unionByName(loops).distinct()
    roots = roots.join(members.select("node"), "node", "left_anti")
    return members.unionByName(roots.select("node", F.col("node").alias("component")))
