"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from emberwave.plans.shared import Scratch, dealt_anew, release

def _with_least(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with low, the smallest v of their u.

    A representative has a link with each member of its component, so a u may hold a third of all rows. The
    minima are aggregated before any shuffle and dealt anew, so that the rows of such a u are split between tasks.
    """
    return links.join(dealt_anew(links.groupBy("u").agg(F.min("v").alias("low")), "u"), "u")


def components(links: DataFrame, a: str = "a", b: str = "b", scratch: Scratch | None = None) -> DataFrame:
    """(node, component): the smallest node reachable over ``links``, for nodes that have a link.

    Alternately links every larger neighbour of a node, then every smaller one, to its smallest, until
    the links are stars. No task gathers a node's neighbours, and each round is a written table, so neither
    plans nor lineage grow; a round's table goes when the next one is written. With ``scratch``, the last one
    is left to its owner. A link of a node with itself is none; an empty table gives no rows.
    """
    own = scratch or Scratch(links.sparkSession, "components")
    state = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")]

    def kept(frame: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        return own.saved(frame.where("u <> v").distinct().observe(seen, *state), "links"), seen.get

    links, before = kept(links.select(F.col(a).alias("u"), F.col(b).alias("v")))
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v")).where("u <> v").distinct()
        met = _with_least(large)
        small = met.select("u", F.col("low").alias("v")).unionByName(met.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")))
        found, now = kept(small)
        own.drop(links)
        links = found
        release(links.sparkSession)
        if now == before:
            break
        before = now
    nodes = links.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    nodes = nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
    return nodes if scratch else own.result(nodes, "components")
