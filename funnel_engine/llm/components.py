"""Connected components of a link table, in DataFrame steps that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``id, component`` (its smallest id) of every id in ``links(a, b)``.

    Alternates the large-star and small-star steps: each hangs neighbours on the
    smallest one they see, until every component is one star. Links between an id
    and itself count as none; nulls must not occur.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = stored(edges, name)
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stored(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), name)
        before, state = state, _state(edges)
        if before == state:
            break
    own = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return own.union(edges.select("lo", "lo").distinct())


#: DuckDB: ``component(id, least)`` from ``node(id)`` and ``link(a, b)``, by reaching along links in both directions.
COMPONENT_SQL = """
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reached AS (SELECT id, id AS other FROM node UNION SELECT r.id, e.b FROM reached r JOIN both_ways e ON r.other = e.a),
component AS (SELECT id, min(other) AS least FROM reached GROUP BY id)"""
