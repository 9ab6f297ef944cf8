"""Connected components of a link table by alternating large-star and small-star rounds.

Nothing is collected but one checksum row a round; labels and links stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.llm._common import stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = both.join(low, "u")
    if small:  # u's smaller neighbours and u itself point at the smallest
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    else:  # u's larger neighbours point at the smallest
        out = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> (id, component): for every linked id the smallest id it reaches.

    Self links and repeated links are allowed, rows with a null end are ignored; no links, no rows."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stage(edges, "links"), None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == before:
            break
        before = tuple(seen)
        edges = stage(_star(_star(edges, small=False), small=True), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
