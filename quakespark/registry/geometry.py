"""G and T rows: geodesy and time."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakespark.functions import geo, timefn
from quakespark.operators import raytrace
from quakespark.registry import sqltext as q
from quakespark.registry.core import query, rounded
from quakespark.sources.archive import degrees, station_code

TEMPLATE_PAIRS = """
SELECT a.id AS id1, b.id AS id2, a.lat AS lat1, a.lon AS lon1, a.depth_km AS dep1,
       b.lat AS lat2, b.lon AS lon2, b.depth_km AS dep2
FROM v_event a JOIN v_event b ON b.id = a.id - a.id % 10"""


def template_pairs(t):
    e = t("v_event")
    a = e.select(F.col("id").alias("id1"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"),
                 F.col("depth_km").alias("dep1"), (F.col("id") - F.col("id") % 10).alias("id2"))
    b = e.select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("depth_km").alias("dep2"))
    return a.join(b, "id2")


@query("G1_separation", q.views(
    f"""SELECT a.id AS id1, b.id AS id2, round({q.sep('a', 'b')}, 6) AS sep_km,
               round({q.sep('a', 'b', 'loader')}, 6) AS sep_loader_km
        FROM v_event a JOIN v_event b ON b.id = a.id - a.id % 10""", "v_event"))
def g1(t):
    six = [F.col(c) for c in ("lat1", "lon1", "dep1", "lat2", "lon2", "dep2")]
    return template_pairs(t).select(
        "id1", "id2", F.round(geo.separation_km(*six), 6).alias("sep_km"),
        F.round(geo.separation_km(*six, geo.KM_PER_DEG_LOADER), 6).alias("sep_loader_km"))


_PICK_PLACES = "SELECT DISTINCT p.id, p.sta, e.lat, e.lon, s.lat AS slat, s.lon AS slon FROM v_pick p JOIN v_event e ON e.id = p.id JOIN v_station s ON s.sta = p.sta"


@query("G2_distance_azimuth", q.views(
    f"""SELECT id, sta, round({q.dist('lat', 'lon', 'slat', 'slon', 'pairing')}, 5) AS d_pairing,
               round({q.dist('lat', 'lon', 'slat', 'slon', 'stations')}, 5) AS d_stations,
               round({q.dist('lat', 'lon', 'slat', 'slon', 'rays')}, 5) AS d_rays,
               round({q.azimuth('lat', 'lon', 'slat', 'slon')}, 5) AS az
        FROM ({_PICK_PLACES})""", "v_event", "v_station", "v_pick"))
def g2(t):
    s = t("v_station").select("sta", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    places = t("v_pick").select("id", "sta").distinct().join(t("v_event").select("id", "lat", "lon"), "id").join(s, "sta")
    four = ("lat", "lon", "slat", "slon")
    return places.select(
        "id", "sta",
        *[F.round(geo.distance_km(*four, v), 5).alias(f"d_{v}") for v in ("pairing", "stations", "rays")],
        F.round(geo.azimuth_deg(*four), 5).alias("az"))


_FRAME = """
origin AS (SELECT avg(lat) AS lat0, avg(lon) AS lon0 FROM v_event),
o1 AS (SELECT *, tan(lat0 * 1.7453292e-2 - sin(lat0 * 3.4906584e-2) / 2.9826e2) / tan(lat0 * 1.7453292e-2) AS ratio FROM origin),
o2 AS (SELECT *, atan(ratio * tan(lat0 * 1.7453292e-2)) AS here,
              atan(ratio * tan((lat0 + 1e0 / 6e1) * 1.7453292e-2)) AS north FROM o1),
o3 AS (SELECT *, 6.378135e3 * (1e0 - pow(sin(here), 2) / 2.9826e2) AS radius FROM o2),
frame AS (SELECT *, radius * (north - here) AS km_lat,
                 radius * acos(pow(sin(here), 2) + cos(1.7453292e-2 / 6e1) * pow(cos(here), 2)) / cos(here) AS km_lon FROM o3),
local AS (SELECT e.id, e.lat, e.lon,
                 (e.lon - f.lon0) * 6e1 * f.km_lon * cos((atan(f.ratio * tan(e.lat * 1.7453292e-2)) + f.here) / 2) AS x,
                 (e.lat - f.lat0) * 6e1 * f.km_lat AS y
          FROM v_event e CROSS JOIN frame f)"""


def _local(t):
    e = t("v_event")
    lat0, lon0 = e.select(F.avg("lat")).scalar(), e.select(F.avg("lon")).scalar()
    placed = e.select("id", "lat", "lon").withColumn("lat0", lat0).withColumn("lon0", lon0)
    x, y = geo.LocalFrame("lat0", "lon0").to_local("lat", "lon")
    return placed.withColumn("x", x).withColumn("y", y)


@query("G3_to_local", "WITH " + q.adapter.sql_views("v_event") + "," + _FRAME
       + "\nSELECT id, round(x, 5) AS x_km, round(y, 5) AS y_km FROM local")
def g3(t):
    return _local(t).select("id", F.round("x", 5).alias("x_km"), F.round("y", 5).alias("y_km"))


@query("G4_to_geographic", q.views("SELECT id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM v_event", "v_event"))
def g4(t):
    """There and back again: the inverse of G3."""
    lat, lon = geo.LocalFrame("lat0", "lon0").to_geographic("x", "y")
    return _local(t).select("id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query("G5_rotation", q.views("""
    SELECT id, round(x_m * cos(3e1 * 1.7453292e-2) - y_m * sin(3e1 * 1.7453292e-2), 4) AS x_axes,
           round(y_m * cos(3e1 * 1.7453292e-2) + x_m * sin(3e1 * 1.7453292e-2), 4) AS y_axes,
           round(x_m * cos(9e-1) - y_m * sin(9e-1), 4) AS x_turned,
           round(x_m * sin(9e-1) + y_m * cos(9e-1), 4) AS y_turned FROM v_reloc_a""", "v_reloc_a"))
def g5(t):
    xa, ya = geo.rotate_axes("x_m", "y_m", 30.0)
    xt, yt = geo.rotate_points("x_m", "y_m", 0.9)
    return t("v_reloc_a").select("id", *[F.round(c, 4).alias(n) for c, n in (
        (xa, "x_axes"), (ya, "y_axes"), (xt, "x_turned"), (yt, "y_turned"))])


@query("G7_profile", q.views("""
    SELECT id, round((x_m / 1e3 - 1e-1) * cos(radians(6e1)) - (y_m / 1e3 + 2e-1) * sin(radians(6e1)), 5) AS along,
           round((x_m / 1e3 - 1e-1) * cos(radians(-3e1)) - (y_m / 1e3 + 2e-1) * sin(radians(-3e1)), 5) AS across
    FROM v_reloc_a""", "v_reloc_a"))
def g7(t):
    along, across = geo.profile_coordinates(F.col("x_m") / 1000.0, F.col("y_m") / 1000.0, 150.0, 0.1, -0.2)
    return t("v_reloc_a").select("id", F.round(along, 5).alias("along"), F.round(across, 5).alias("across"))


@query("G8_source_radius", q.views("""
    SELECT id, round(pow(7e0 * pow(1e1, 1.5e0 * mag + 1.6e1) / (1.6e1 * 1e6 * 3e1), 1e0 / 3e0) / 1e2, 4) AS radius_m
    FROM v_event""", "v_event"))
def g8(t):
    return t("v_event").select("id", F.round(geo.source_radius_m("mag"), 4).alias("radius_m"))


@query("G9_speed_ratio", q.views("""
    SELECT id, round(depth_km / 2, 6) AS vp, round(depth_km / 2 / 1.73e0, 6) AS vs,
           round((depth_km / 2) / (depth_km / 2 / 1.73e0), 6) AS vp_vs FROM v_event""", "v_event"))
def g9(t):
    layers = t("v_event").select("id", (F.col("depth_km") / 2).alias("vp"))
    layers = raytrace.speed_ratio(layers.withColumn("vs", F.col("vp") / 1.73))
    return rounded(layers, vp=6, vs=6, vp_vs=6)


@query("T1_parts", q.views("""
    SELECT id, CAST(year(origin_time) AS INT) AS yr, CAST(month(origin_time) AS INT) AS mo,
           CAST(day(origin_time) AS INT) AS dy, CAST(hour(origin_time) AS INT) AS hr,
           CAST(minute(origin_time) AS INT) AS mi, round(microsecond(origin_time) / 1e6, 6) AS sc FROM v_event""", "v_event"))
def t1(t):
    p = timefn.timestamp_parts("origin_time")
    iso = t("v_event").select("id", timefn.parse_iso(
        F.concat(F.date_format("origin_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))).alias("origin_time"))
    return rounded(iso.select("id", *[c.alias(n) for n, c in p.items()]), sc=6)


@query("T2_iso_text", q.views("""
    SELECT id, strftime(origin_time, '%Y-%m-%dT%H:%M:') ||
           lpad(printf('%.3f', microsecond(origin_time) / 1e6), 6, '0') || 'Z' AS origin_time FROM v_event""", "v_event"))
def t2(t):
    p = timefn.timestamp_parts("origin_time")
    parts = t("v_event").select("id", *[c.alias(n) for n, c in p.items()])
    return parts.select("id", timefn.parts_to_iso("yr", "mo", "dy", "hr", "mi", "sc").alias("origin_time"))


_INTS = """CAST(year(origin_time) * 10000 + month(origin_time) * 100 + day(origin_time) AS BIGINT) AS date,
           CAST(hour(origin_time) * 1000000 + minute(origin_time) * 10000 + microsecond(origin_time) // 10000 AS BIGINT) AS time"""


@query("T3_date_time_ints", q.views(f"""
    SELECT id, {_INTS}, date_trunc('minute', origin_time) + to_microseconds(microsecond(origin_time) // 10000 * 10000) AS decoded
    FROM v_event""", "v_event"))
def t3(t):
    coded = t("v_event").select("id", timefn.date_int("origin_time").cast("bigint").alias("date"),
                                timefn.time_int("origin_time").cast("bigint").alias("time"))
    return coded.withColumn("decoded", timefn.from_date_time_ints("date", "time"))


@query("T4_shift_origin", q.views("""
    SELECT id, origin_time - to_microseconds(CAST((id % 977 - 488) * 250000 AS BIGINT)) AS origin_time FROM v_event""", "v_event"))
def t4(t):
    shift = (F.col("id") % 977 - 488) / 4.0
    return t("v_event").select("id", timefn.shift_origin("origin_time", shift).alias("origin_time"))


@query("T5_hour_wrap", q.views("""
    SELECT e.id, p.sta, p.phase, round(p.tt, 4) AS tt
    FROM v_pick p JOIN v_event e ON e.id = p.id""", "v_event", "v_pick"))
def t5(t):
    """Travel times survive the trip through minutes and seconds of the hour."""
    arrival = timefn.shift_origin("origin_time", -F.col("tt"))
    both = t("v_pick").join(t("v_event").select("id", "origin_time"), "id").withColumn("arrival", arrival)
    a, o = timefn.timestamp_parts("arrival"), timefn.timestamp_parts("origin_time")
    tt = timefn.travel_time_over_hour(a["mi"], a["sc"], o["mi"], o["sc"])
    return both.select("id", "sta", "phase", F.round(tt, 4).alias("tt"))


@query("T6_station_code", """
    SELECT s_suppkey, rpad(concat(CASE WHEN s_nationkey < 10 THEN 'N' ELSE 'M' END || CAST(s_nationkey % 10 AS STRING),
           CAST(s_suppkey AS STRING)), 7, ' ') AS code FROM supplier""")
def t6(t):
    net = F.concat(F.when(F.col("s_nationkey") < 10, "N").otherwise("M"), (F.col("s_nationkey") % 10).cast("string"))
    return t("supplier").select("s_suppkey", station_code(net, F.col("s_suppkey").cast("string")).alias("code"))


@query("T7_signed_degrees", q.views("""
    SELECT sta, round(lat, 6) AS lat, round(lon, 6) AS lon FROM v_station""", "v_station"))
def t7(t):
    """Degrees, minutes and hemisphere of every station, put together again."""
    deg = F.floor(F.abs("lon"))
    lon = degrees(deg, (F.abs("lon") - deg) * 60.0, F.when(F.col("lon") < 0, "W").otherwise("E"), "W")
    up = F.floor("lat")
    lat = degrees(up, (F.col("lat") - up) * 60.0, F.lit("N"), "S")
    return t("v_station").select("sta", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))
