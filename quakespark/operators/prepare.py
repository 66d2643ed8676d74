"""Detections and catalogs to events, picks and correlation links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark.functions import timefn
from quakespark.operators.order import number_rows


def detections_only(det: DataFrame) -> DataFrame:
    """rows whose event is not its own template; all rows if there is none."""
    other = F.col("event_id") != F.col("template_id")
    return det.filter(other | ~det.filter(other).exists())


def first_rows(det: DataFrame) -> DataFrame:
    """The first row of every event."""
    columns = [c for c in det.columns if c != "event_id"]
    return det.groupBy("event_id").agg(F.min_by(F.struct(*columns), "row_id").alias("r")).select("event_id", "r.*")


def assign_event_ids(det: DataFrame, start: int = 100000) -> DataFrame:
    """original_id, synthetic_id numbered in order of first appearance."""
    seen = det.groupBy(F.col("event_id").alias("original_id")).agg(F.min("row_id").alias("first_row"))
    return number_rows(seen, ["first_row", "original_id"], "synthetic_id", start).drop("first_row")


def assign_pair_ids(det: DataFrame) -> DataFrame:
    """Ids for events and templates together, events first, numbered from 1."""
    rows = detections_only(det)
    both = rows.select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("row_id").alias("row"), F.col("event_id").alias("original_id")),
                F.struct(F.lit(1).alias("side"), F.col("row_id").alias("row"), F.col("template_id").alias("original_id")),
            )
        ).alias("e")
    ).select("e.*")
    first = both.groupBy("original_id").agg(F.min(F.struct("side", "row")).alias("first"))
    return number_rows(first, ["first", "original_id"], "synthetic_id", 1).drop("first")


def required_id(df: DataFrame, ids: DataFrame, name: str, out: str) -> DataFrame:
    """J2 forward: the integer id of ``name``; an id without mapping fails the job."""
    mapping = ids.select(F.col("original_id").alias(name), F.col("synthetic_id").alias("_id"))
    missing = F.raise_error(F.concat(F.lit("no id mapping for "), F.col(name))).cast("bigint")
    return df.join(mapping, name, "left").withColumn(out, F.coalesce(F.col("_id"), missing)).drop("_id")


def original_ids(df: DataFrame, ids: DataFrame, name: str = "id") -> DataFrame:
    """J2 back: original id of an integer id, NULL where there is none."""
    mapping = ids.select(F.col("synthetic_id").alias(name), F.col("original_id").alias("event_id"))
    return df.join(mapping, name, "left")


def event_headers(det: DataFrame, catalog: DataFrame | None, ids: DataFrame | None) -> DataFrame:
    """One event per id with the place of the event, else of its template, else zeros.

    Magnitude and errors come from the event's own catalog entry only.
    """
    first = first_rows(det)
    zero = F.lit(0.0)
    if catalog is None:
        located = first.select("event_id", "template_id", "origin_time", "row_id", *[
            zero.alias(c) for c in ("lat", "lon", "depth_km", "mag", "eh", "ez")])
    else:
        own = catalog.select("event_id", F.struct("lat", "lon", "depth_km", "mag", "eh", "ez").alias("own"))
        tmpl = catalog.select(F.col("event_id").alias("template_id"), F.struct("lat", "lon", "depth_km").alias("tmpl"))
        joined = first.join(own, "event_id", "left").join(tmpl, "template_id", "left")

        def place(name: str) -> Column:
            return (
                F.when(F.col("own").isNotNull(), F.col(f"own.{name}"))
                .when(F.col("tmpl").isNotNull(), F.col(f"tmpl.{name}"))
                .otherwise(zero)
            )

        def own_only(name: str) -> Column:
            return F.when(F.col("own").isNotNull(), F.col(f"own.{name}")).otherwise(zero)

        located = joined.select(
            "event_id", "template_id", "origin_time", "row_id",
            *[place(c).alias(c) for c in ("lat", "lon", "depth_km")],
            *[own_only(c).alias(c) for c in ("mag", "eh", "ez")],
        )
    if ids is None:
        return located.withColumn("id", F.col("event_id").cast("bigint"))
    return required_id(located, ids, "event_id", "id")


def picks(det: DataFrame, ids: DataFrame | None = None, lag_correction: bool = False) -> DataFrame:
    """wide rows to one row per pick; weight is the correlation or 1.

    With ``lag_correction`` the lag of a detection is added to its travel time; templates stay.
    """
    detected = F.col("event_id") != F.col("template_id")

    def phase(n: int, name: str, low: str) -> Column:
        tt = F.col(f"tt_{low}")
        if lag_correction:
            tt = F.when(detected & F.col(f"lag_{low}").isNotNull(), tt + F.col(f"lag_{low}")).otherwise(tt)
        return F.struct(
            F.lit(n).alias("n"), F.lit(name).alias("phase"), tt.alias("tt"),
            F.coalesce(F.col(f"cc_{low}"), F.lit(1.0)).alias("weight"),
        )

    rows = det.select(
        "event_id", "sta", "row_id", F.explode(F.array(phase(0, "P", "p"), phase(1, "S", "s"))).alias("p")
    ).filter(F.col("p.tt").isNotNull())
    flat = rows.select("event_id", F.struct("row_id", "p.n").alias("seq"), "sta", "p.phase", "p.tt", "p.weight")
    if ids is None:
        return flat.withColumn("id", F.col("event_id").cast("bigint"))
    return required_id(flat, ids, "event_id", "id")


def event_template_pairs(det: DataFrame) -> DataFrame:
    """A1: distinct (event, template) pairs of the detections."""
    return detections_only(det).select("event_id", "template_id").dropDuplicates()


def correlation_links(det: DataFrame, ids: DataFrame | None = None, min_cc: float = 0.0) -> DataFrame:
    """lags with a correlation of at least ``min_cc`` as links from event to template."""
    rows = detections_only(det)

    def phase(n: int, name: str, low: str) -> Column:
        return F.struct(
            F.lit(n).alias("n"), F.lit(name).alias("phase"),
            F.col(f"lag_{low}").alias("dt"), F.col(f"cc_{low}").alias("qual"),
        )

    flat = rows.select(
        "event_id", "template_id", "sta", "row_id",
        F.explode(F.array(phase(0, "P", "p"), phase(1, "S", "s"))).alias("p"),
    ).filter(F.col("p.dt").isNotNull() & (F.col("p.qual") >= min_cc))
    links = flat.select(
        "event_id", "template_id", "sta", F.struct("row_id", "p.n").alias("seq"), "p.phase", "p.dt", "p.qual"
    )
    ids = assign_pair_ids(det) if ids is None else ids
    links = required_id(links, ids, "event_id", "id1")
    links = required_id(links, ids, "template_id", "id2")
    return links.select("id1", "id2", F.lit(0.0).alias("otc"), "seq", "sta", "dt", "qual", "phase")


def arrival_picks(arrivals: DataFrame, events: DataFrame) -> DataFrame:
    """Travel times of absolute arrivals, weight 1."""
    joined = arrivals.join(events.select("id", "origin_time"), "id")
    micros = timefn.epoch_micros("arrival_time") - timefn.epoch_micros("origin_time")
    return joined.withColumn("tt", micros / 1e6).withColumn("weight", F.lit(1.0)).drop("origin_time")


def relocated_in_any(events: DataFrame, runs: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Events relocated in at least one run. A run is (relocations id, id table id, original_id)."""
    found = None
    for reloc, table in runs:
        ids = reloc.select("id").join(table.select("id", "original_id"), "id").select(F.col("original_id").alias("id"))
        found = ids if found is None else found.unionByName(ids)
    return events.join(found, "id", "left_semi")


def without_networks(stations: DataFrame, networks: tuple[str, ...]) -> DataFrame:
    """stations outside the named networks."""
    return stations.filter(~F.col("network").isin(*networks))


# Temporary ocean-bottom networks left out of the station list.
LEFT_OUT_NETWORKS = ("7D", "Z5")


def one_per_station(stations: DataFrame, order: str) -> DataFrame:
    """The first entry of every station name."""
    columns = [c for c in stations.columns if c != "sta"]
    return stations.groupBy("sta").agg(F.min_by(F.struct(*columns), order).alias("r")).select("sta", "r.*")


def drop_repeats(stations: DataFrame, order: str) -> DataFrame:
    """Drop entries that repeat the station of the line before; a name that comes back later stays.

    Numbered lines are joined to their predecessor, so no task has to see the whole list.
    """
    numbered = number_rows(stations, [order], "_row")
    before = numbered.select((F.col("_row") + 1).alias("_row"), F.col("sta").alias("_sta"))
    return (
        numbered.join(before, "_row", "left")
        .filter(F.col("_sta").isNull() | (F.col("_sta") != F.col("sta")))
        .drop("_row", "_sta")
    )
