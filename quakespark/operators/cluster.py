"""Clusters of events: connected components over strongly linked pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakespark.operators.order import number_rows
from quakespark.session import checkpointed


def pair_strength(links: DataFrame) -> DataFrame:
    """A2: links per unordered pair, all link types together and by phase."""
    return links.groupBy(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).agg(
        F.count(F.lit(1)).alias("n_links"),
        F.count_if(F.col("idx").isin(1, 3)).alias("n_p"),
        F.count_if(F.col("idx").isin(2, 4)).alias("n_s"),
    )


def _neighbour_minimum(edges: DataFrame) -> DataFrame:
    """Smallest id among a node and its neighbours; the minimum is combined before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.col("u").alias("u"), F.col("v").alias("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    return edges.select(F.explode(ends).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = _both_ways(edges)
    joined = both.join(_neighbour_minimum(both), "u").filter(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    minimum = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(minimum, "u").filter(F.col("v") != F.col("m"))
    ties = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ties.unionByName(minimum.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """A4: (id, component) where component is the smallest id reachable over ``edges`` (a, b).

    Alternates the large-star and small-star steps until the edges are stars. Each round is written to
    the checkpoint folder, so a lost executor never replays the whole history.
    """
    stars = checkpointed(
        edges.filter(F.col("a") != F.col("b")).select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
    )
    state = None
    for _ in range(max_rounds):
        stars = checkpointed(_small_star(_large_star(stars)))
        row = stars.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if (row["n"], row["h"]) == state:
            break
        state = (row["n"], row["h"])
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def cluster_sizes(components: DataFrame) -> DataFrame:
    """A5: events per component."""
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("n_events"))


def isolated_events(events: DataFrame, components: DataFrame) -> DataFrame:
    """A5: events outside every component."""
    return events.join(components.select("id"), "id", "left_anti")


def ranked_clusters(components: DataFrame) -> DataFrame:
    """Cluster numbers from 1, largest first, ties by the smallest id."""
    sizes = cluster_sizes(components)
    return number_rows(sizes, [F.col("n_events").desc(), F.col("component")], "cluster_id", 1)


def cluster_events(
    links: DataFrame, events: DataFrame, min_cc: int, min_ct: int, data: str = "both"
) -> DataFrame:
    """Event id and cluster number; NULL for isolated events.

    The threshold is the sum of both limits, the limit of an unused data type counts as 0. A threshold of
    0 puts all events in cluster 1.
    """
    limit = (min_cc if data != "ct" else 0) + (min_ct if data != "cc" else 0)
    if limit == 0:
        return events.select("id", F.lit(1).cast("bigint").alias("cluster_id"))
    strong = pair_strength(links).filter(F.col("n_links") >= limit)
    components = connected_components(strong.select("a", "b"))
    numbered = ranked_clusters(components).select("component", "cluster_id")
    members = components.join(numbered, "component").select("id", "cluster_id")
    return events.select("id").join(members, "id", "left")


def centroids(events: DataFrame, by: str | None = None) -> DataFrame:
    """Mean latitude, longitude and depth, per cluster or over all."""
    means = [F.avg(c).alias(f"{c}0") for c in ("lat", "lon", "depth_km")]
    return events.groupBy(by).agg(*means) if by else events.agg(*means)
