"""Loading of differential times: filters, joins and checks between pairing and relocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.functions import geo
from quakespark.params import LinkParams
from quakespark.session import checkpointed

# Fixed value: origin time correction that marks a pair without one.
NO_OTC = -999.0
MIN_DEPTH_KM = 0.01
# Smallest length of a degree of latitude, and the latitude from which a circle may hold the pole.
SHORTEST_DEGREE_KM, POLAR_DEG = 109.5, 89.0
#: The column that tells clusters apart.
KEY = "cluster_id"
SHORT_DATE_LIMIT, SHORT_DATE_SHIFT = 10_000_000, 19_000_000


def clean_events(events: DataFrame) -> DataFrame:
    """two-digit years belong to the 1900s; no event is shallower than 10 m."""
    date = F.col("date")
    return events.withColumn(
        "date", F.when(date < SHORT_DATE_LIMIT, date + SHORT_DATE_SHIFT).otherwise(date)
    ).withColumn("depth_km", F.greatest(F.col("depth_km"), F.lit(MIN_DEPTH_KM)))


def choose_events(events: DataFrame, ids: DataFrame | None = None, bad: DataFrame | None = None) -> DataFrame:
    """F16: events on the id list; events on the bad list are flagged, not dropped."""
    kept = events if ids is None else events.join(ids.select("id").distinct(), "id", "left_semi")
    if bad is None:
        return kept.withColumn("marked_bad", F.lit(False))
    flags = bad.select("id").distinct().withColumn("_bad", F.lit(True))
    return kept.join(flags, "id", "left").withColumn("marked_bad", F.coalesce("_bad", F.lit(False))).drop("_bad")


def duplicate_stations(stations: DataFrame) -> DataFrame:
    """Station labels listed more than once."""
    return stations.groupBy("sta").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def id_problems(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Selected ids that are missing from the events or occur more than once."""
    counts = events.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return (
        ids.select("id").distinct().join(counts, "id", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .filter(F.col("n") != 1)
        .withColumn("problem", F.when(F.col("n") == 0, "missing").otherwise("repeated"))
    )


def fail_on_rows(df: DataFrame, problems: DataFrame, what: str) -> DataFrame:
    """``df`` unchanged, failing the job when ``problems`` has rows."""
    broken = problems.exists()
    return df.filter(F.when(broken, F.raise_error(F.lit(what)).cast("boolean")).otherwise(F.lit(True)))


def surface_stations(stations: DataFrame, straight_rays: bool = False) -> DataFrame:
    """elevation in km, below sea level raised to 0 unless rays are straight."""
    km = F.col("elev_m") / 1000.0
    if not straight_rays:
        km = F.when(km < 0, 0.0).otherwise(km)
    return stations.withColumn("elev_km", km)


def near_stations(stations: DataFrame, events: DataFrame, max_dist: float) -> DataFrame:
    """stations within ``max_dist`` km of the mean epicentre."""
    lat = events.select(F.avg("lat")).scalar()
    lon = events.select(F.avg("lon")).scalar()
    placed = stations.withColumn("_lat", lat).withColumn("_lon", lon)
    return placed.filter(geo.distance_km("_lat", "_lon", "lat", "lon", "stations") <= max_dist).drop("_lat", "_lon")


def stations_around(centres: DataFrame, stations: DataFrame, max_dist: float, key: str = KEY) -> DataFrame:
    """F6 for many centres: (key, station columns) of the stations within ``max_dist`` km of each centre (key, lat0, lon0).

    Both tables are dealt to a grid whose bands are as high as the circles' radius and whose cells follow the band's
    latitude; a centre probes the cells its circle can reach, so far stations never meet it.
    """
    height = min(max(max_dist, 1e-3) / SHORTEST_DEGREE_KM, 180.0)
    band = lambda lat: F.floor((F.col(lat) + 90.0) / height)
    edge = F.col("_b") * height - 90.0
    lowest = F.when((edge <= 0) & (edge + height >= 0), 0.0).otherwise(F.least(F.abs(edge), F.abs(edge + height)))
    cells = F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(lowest, F.lit(90.0)))) * (360.0 / height)))
    turn = lambda lon: (lon + 180.0) / 360.0 * F.col("_n")

    placed = stations.withColumn("_b", band("lat")).withColumn("_n", cells)
    placed = placed.withColumn("_x", F.pmod(F.floor(turn(F.col("lon"))), F.col("_n"))).drop("_n")
    sine = F.sin(F.radians(F.lit(height))) / F.cos(F.radians(F.abs("lat0")))
    polar = (F.abs("lat0") + height >= POLAR_DEG) | (F.lit(height) >= 90.0)
    reach = F.when(polar, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), sine))) * 1.001)
    first, last = F.floor(turn(F.col("lon0") - F.col("_reach"))), F.floor(turn(F.col("lon0") + F.col("_reach")))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)
    some = F.array_distinct(F.transform(F.sequence(first, last), lambda x: F.pmod(x, F.col("_n"))))
    probes = (
        centres.select(key, "lat0", "lon0").withColumn("_reach", reach)
        .withColumn("_b", F.explode(F.sequence(band("lat0") - 1, band("lat0") + 1))).withColumn("_n", cells)
        .withColumn("_x", F.explode(F.when(last - first + 1 >= F.col("_n"), every).otherwise(some)))
        .select(key, F.col("lat0").alias("_lat"), F.col("lon0").alias("_lon"), "_b", "_x")
    )
    met = probes.join(placed, ["_b", "_x"])
    return met.filter(geo.distance_km("_lat", "_lon", "lat", "lon", "stations") <= max_dist).select(key, *stations.columns)


def corrected_lags(links: DataFrame) -> DataFrame:
    """drop pairs without an origin time correction, subtract it from the others."""
    return links.filter(F.abs(F.col("otc") - NO_OTC) >= 0.001).withColumn("dt", F.col("dt") - F.col("otc"))


def keep_phases(links: DataFrame, phases: str) -> DataFrame:
    """P, S or both; any other phase code fails the job."""
    known = F.when(F.col("phase").isin("P", "S"), F.col("phase")).otherwise(
        F.raise_error(F.concat(F.lit("unknown phase: "), F.coalesce("phase", F.lit("null"))))
    )
    checked = links.withColumn("phase", known)
    return checked.filter(F.col("phase").isNotNull()) if phases == "both" else checked.filter(F.col("phase") == phases)


def one_table(cc: DataFrame | None, ct: DataFrame | None) -> DataFrame:
    """Correlation links (idx 1, 2) and catalog links (idx 3, 4) in one table."""
    def typed(df: DataFrame, dt: Column, first: int) -> DataFrame:
        idx = F.when(F.col("phase") == "P", first).otherwise(first + 1)
        return df.select("id1", "id2", "sta", "phase", dt.alias("dt"), "qual", idx.alias("idx"))

    parts = []
    if cc is not None:
        parts.append(typed(cc, F.col("dt"), 1))
    if ct is not None:
        parts.append(typed(ct, F.col("t1") - F.col("t2"), 3))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def keep_data(links: DataFrame, data: str) -> DataFrame:
    """correlation links, catalog links or both."""
    if data == "both":
        return links
    return links.filter(F.col("idx") <= 2 if data == "cc" else F.col("idx") >= 3)


def known_pairs(links: DataFrame, events: DataFrame) -> DataFrame:
    """Links whose two events are in the event list."""
    ids = events.select("id").distinct()
    for side in ("id1", "id2"):
        links = links.join(ids.withColumnRenamed("id", side), side, "left_semi")
    return links


def known_stations(links: DataFrame, stations: DataFrame) -> DataFrame:
    """Links at stations of the station list."""
    return links.join(stations.select("sta").distinct(), "sta", "left_semi")


def with_separation(links: DataFrame, events: DataFrame, km_per_deg: float = geo.KM_PER_DEG_LOADER) -> DataFrame:
    """Adds the separation of both events in km, in the plane at the first one; worked out once for each pair."""
    def place(n: int) -> DataFrame:
        return events.select(
            F.col("id").alias(f"id{n}"), F.col("lat").alias(f"_lat{n}"), F.col("lon").alias(f"_lon{n}"),
            F.col("depth_km").alias(f"_dep{n}"),
        )

    sep = geo.separation_km("_lat1", "_lon1", "_dep1", "_lat2", "_lon2", "_dep2", km_per_deg)
    pairs = links.select("id1", "id2").distinct().join(place(1), "id1").join(place(2), "id2")
    return links.join(pairs.select("id1", "id2", sep.alias("sep_km")), ["id1", "id2"])


def close_pairs(links: DataFrame, max_cc: float | None, max_ct: float | None) -> DataFrame:
    """pairs within the first iteration's separation limit of their data type, where it is positive."""
    def inside(limit: float | None) -> Column:
        return F.lit(True) if limit is None or limit <= 0 else F.col("sep_km") <= limit

    return links.filter(F.when(F.col("idx") <= 2, inside(max_cc)).otherwise(inside(max_ct)))


def smaller_id_first(links: DataFrame) -> DataFrame:
    """the smaller id comes first; turning a pair turns the sign of dt."""
    swap = F.col("id1") > F.col("id2")
    return links.withColumns(
        {
            "dt": F.when(swap, -F.col("dt")).otherwise(F.col("dt")),
            "id1": F.least("id1", "id2"),
            "id2": F.greatest("id1", "id2"),
        }
    )


def station_geometry(links: DataFrame, events: DataFrame, stations: DataFrame) -> DataFrame:
    """Distance and azimuth from the first event of a link to its station."""
    first = events.select(F.col("id").alias("id1"), F.col("lat").alias("_elat"), F.col("lon").alias("_elon"))
    places = stations.select("sta", F.col("lat").alias("_slat"), F.col("lon").alias("_slon"))
    return (
        links.join(first, "id1")
        .join(places, "sta")
        .withColumn("sta_dist", geo.distance_km("_elat", "_elon", "_slat", "_slon", "rays"))
        .withColumn("sta_az", geo.azimuth_deg("_elat", "_elon", "_slat", "_slon"))
        .drop("_elat", "_elon", "_slat", "_slon")
    )


def azimuthal_gaps(links: DataFrame) -> DataFrame:
    """A3: largest gap between neighbouring station azimuths of a pair, in whole degrees."""
    seen = links.select("id1", "id2", F.round("sta_az").cast("int").alias("az")).distinct()
    by_pair = W.partitionBy("id1", "id2")
    after = F.lead("az").over(by_pair.orderBy("az"))
    first = F.min("az").over(by_pair)
    gap = F.coalesce(after, first + 360) - F.col("az")
    return seen.withColumn("gap", gap).groupBy("id1", "id2").agg(F.max("gap").alias("gap"))


def geometry_filter(links: DataFrame, events: DataFrame, stations: DataFrame, params: LinkParams) -> DataFrame:
    """Station distance limits per link and the gap limit per pair (links with quality > 0)."""
    if params.max_gap is None and params.min_pair_dist is None and params.max_pair_dist is None:
        return links
    low = 0.0 if params.min_pair_dist is None else params.min_pair_dist
    high = float("inf") if params.max_pair_dist is None else params.max_pair_dist
    placed = station_geometry(smaller_id_first(links), events, stations)
    weighted = F.col("qual") > 0
    kept = placed.filter(~weighted | F.col("sta_dist").between(low, high))
    if params.max_gap is not None:
        wide = azimuthal_gaps(kept.filter(weighted)).filter(F.col("gap") > params.max_gap).select("id1", "id2")
        wide = wide.withColumn("_wide", F.lit(True))
        kept = kept.join(wide, ["id1", "id2"], "left").filter(~weighted | F.col("_wide").isNull()).drop("_wide")
    return kept.drop("sta_dist", "sta_az")


def linked_events(links: DataFrame, events: DataFrame) -> DataFrame:
    """Events that still have a link."""
    ids = links.select(F.explode(F.array("id1", "id2")).alias("id")).distinct()
    return events.join(ids, "id", "left_semi")


def linked_stations(links: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations that still have a link."""
    return stations.join(links.select("sta").distinct(), "sta", "left_semi")


def _chosen_links(cc: DataFrame | None, ct: DataFrame | None, params: LinkParams) -> DataFrame:
    """The links of the wanted data types and phases in one table."""
    if cc is not None and params.data != "ct":
        cc = corrected_lags(cc)
    return keep_phases(one_table(cc if params.data != "ct" else None, ct if params.data != "cc" else None), params.phases)


def load_links(
    cc: DataFrame | None, ct: DataFrame | None, events: DataFrame, stations: DataFrame, params: LinkParams
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole loader: (links with sep_km, events with links, stations with links)."""
    near = near_stations(stations, events, params.max_station_dist) if params.limit_catalog else stations
    links = known_stations(known_pairs(_chosen_links(cc, ct, params), events), near)
    links = with_separation(links, events, params.km_per_deg)
    # written here and after the gap filter, because both results are read several times
    links = checkpointed(close_pairs(links, params.max_sep_cc, params.max_sep_ct))
    kept = geometry_filter(links, events, near, params)
    links = links if kept is links else checkpointed(kept)
    return links, linked_events(links, events), linked_stations(links, near)


def cluster_links(links: DataFrame, members: DataFrame) -> DataFrame:
    """Links with both events in the same cluster of ``members`` (id, cluster_id; NULL is no cluster)."""
    def side(n: int) -> DataFrame:
        return members.filter(F.col(KEY).isNotNull()).select(F.col("id").alias(f"id{n}"), F.col(KEY).alias(f"_c{n}"))

    joined = links.join(side(1), "id1").join(side(2), "id2").filter(F.col("_c1") == F.col("_c2"))
    return joined.withColumn(KEY, F.col("_c1")).drop("_c1", "_c2")


def load_clusters(
    cc: DataFrame | None, ct: DataFrame | None, events: DataFrame, stations: DataFrame, members: DataFrame, params: LinkParams
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The loader for every cluster by itself: (links, events with links, stations with links), all with ``cluster_id``.

    ``members`` (id, cluster_id) says where an event belongs. A cluster keeps the links between its own events, at the
    stations within the limit of its own mean epicentre; separations, gaps and what is linked follow from these alone.
    All clusters go together, and a station may serve several.
    """
    inside = members.filter(F.col(KEY).isNotNull()).select("id", KEY)
    placed = checkpointed(events.join(inside, "id"))
    centres = placed.groupBy(KEY).agg(F.avg("lat").alias("lat0"), F.avg("lon").alias("lon0"))
    near = checkpointed(stations_around(centres, stations, params.max_station_dist))
    links = cluster_links(_chosen_links(cc, ct, params), inside).join(near.select(KEY, "sta"), [KEY, "sta"], "left_semi")
    links = checkpointed(close_pairs(with_separation(links, events, params.km_per_deg), params.max_sep_cc, params.max_sep_ct))
    kept = geometry_filter(links, events, stations, params)     # a pair belongs to one cluster
    links = links if kept is links else checkpointed(kept)
    return links, linked_events(links, placed), near.join(links.select(KEY, "sta").distinct(), [KEY, "sta"], "left_semi")
