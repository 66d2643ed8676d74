"""Rows of E1, the loader and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakespark.functions import timefn
from quakespark.operators import cluster, links as lnk, prepare
from quakespark.params import LinkParams
from quakespark.registry import common as c
from quakespark.registry import sqltext as q
from quakespark.registry.core import query, rounded
from quakespark.session import checkpointed

_DET = ("v_event", "v_station", "v_pick", "v_detection")


# --- E1 -----------------------------------------------------------------------------------------


@query("F1_detections_only", q.views("""
    SELECT event_id, template_id, sta FROM v_detection
    WHERE event_id <> template_id OR NOT EXISTS (SELECT 1 FROM v_detection WHERE event_id <> template_id)""", *_DET))
def f1(t):
    return prepare.detections_only(t("v_detection")).select("event_id", "template_id", "sta")


@query("F2_picks", q.views("""
    SELECT event_id, sta, 'P' AS phase, round(tt_p + (CASE WHEN event_id <> template_id THEN coalesce(lag_p, 0e0) ELSE 0e0 END), 6) AS tt,
           coalesce(cc_p, 1e0) AS weight FROM v_detection WHERE tt_p IS NOT NULL
    UNION ALL
    SELECT event_id, sta, 'S', round(tt_s + (CASE WHEN event_id <> template_id THEN coalesce(lag_s, 0e0) ELSE 0e0 END), 6),
           coalesce(cc_s, 1e0) FROM v_detection WHERE tt_s IS NOT NULL""", *_DET))
def f2(t):
    return rounded(prepare.picks(t("v_detection"), None, lag_correction=True).select("event_id", "sta", "phase", "tt", "weight"), tt=6)


@query("F3_correlation_links", "WITH " + q.adapter.sql_views(*_DET) + "," + q.CC_STEPS
       + " SELECT id1, id2, sta, phase, dt, qual FROM cc WHERE qual >= 6e-1")
def f3(t):
    return c.correlation_links(t, 0.6).select("id1", "id2", "sta", "phase", "dt", "qual")


@query("W3_first_rows", q.views("""
    SELECT event_id, arg_min(sta, row_id) AS sta, min(row_id) AS row_id FROM v_detection GROUP BY event_id""", *_DET))
def w3(t):
    return prepare.first_rows(t("v_detection")).select("event_id", "sta", "row_id")


@query("W6_event_ids", q.views("""
    SELECT event_id AS original_id, CAST(99999 + row_number() OVER (ORDER BY min(row_id)) AS BIGINT) AS synthetic_id
    FROM v_detection GROUP BY event_id""", *_DET))
def w6(t):
    return prepare.assign_event_ids(t("v_detection"))


@query("U1_pair_ids", q.views("""
    SELECT original_id, CAST(row_number() OVER (ORDER BY min(side * 1000000000 + row_id)) AS BIGINT) AS synthetic_id
    FROM (SELECT event_id AS original_id, 0 AS side, row_id FROM v_detection WHERE event_id <> template_id
          UNION ALL SELECT template_id, 1, row_id FROM v_detection WHERE event_id <> template_id) GROUP BY original_id""", *_DET))
def u1(t):
    return prepare.assign_pair_ids(t("v_detection"))


@query("A1_event_template_pairs", q.views(
    "SELECT DISTINCT event_id, template_id FROM v_detection WHERE event_id <> template_id", *_DET))
def a1(t):
    return prepare.event_template_pairs(t("v_detection"))


@query("J1_event_headers", q.views("""
    SELECT CAST(f.event_id AS BIGINT) AS id, f.origin_time, round(coalesce(o.lat, m.lat, 0e0), 6) AS lat,
           round(coalesce(o.lon, m.lon, 0e0), 6) AS lon, coalesce(o.depth_km, m.depth_km, 0e0) AS depth_km,
           coalesce(o.mag, 0e0) AS mag, coalesce(o.eh, 0e0) AS eh, coalesce(o.ez, 0e0) AS ez
    FROM (SELECT DISTINCT event_id, template_id, origin_time FROM v_detection) f
    LEFT JOIN v_catalog o ON o.event_id = f.event_id LEFT JOIN v_catalog m ON m.event_id = f.template_id""", *_DET, "v_catalog"))
def j1(t):
    out = prepare.event_headers(t("v_detection"), t("v_catalog"), c.own_ids(t))
    return rounded(out.select("id", "origin_time", "lat", "lon", "depth_km", "mag", "eh", "ez"), lat=6, lon=6)


@query("J2_id_mapping", q.views("""
    SELECT r.id + 7 AS id, CAST(e.id AS STRING) AS event_id FROM v_reloc_a r LEFT JOIN v_event e ON e.id = r.id + 7""",
    "v_event", "v_reloc_a"))
def j2(t):
    """Back mapping of shifted ids: ids past the end have no original."""
    shifted = t("v_reloc_a").select((F.col("id") + 7).alias("id"))
    return prepare.original_ids(shifted, c.own_ids(t))


@query("J13_arrivals", q.views(
    "SELECT p.id, p.sta, p.phase, round(p.tt, 6) AS tt, 1e0 AS weight FROM v_pick p", "v_event", "v_station", "v_pick"))
def j13(t):
    arrival = timefn.shift_origin("origin_time", -F.col("tt")).alias("arrival_time")
    arrivals = t("v_pick").join(t("v_event").select("id", "origin_time"), "id").select("id", "sta", "phase", arrival)
    return rounded(prepare.arrival_picks(arrivals, t("v_event")).select("id", "sta", "phase", "tt", "weight"), tt=6)


@query("J14_relocated_in_any", q.views("""
    SELECT id FROM v_event WHERE id IN (SELECT id FROM v_reloc_a) OR id IN (SELECT id - 1 FROM v_reloc_b)""",
    "v_event", "v_reloc_a", "v_reloc_b"))
def j14(t):
    def own(shift):
        return t("v_event").select("id", (F.col("id") - shift).alias("original_id"))

    runs = [(t("v_reloc_a"), own(0)), (t("v_reloc_b"), own(1))]
    return prepare.relocated_in_any(t("v_event"), runs).select("id")


@query("W4_one_per_station", """
    SELECT CAST(l_suppkey AS STRING) AS sta, min(l_orderkey * 10 + l_linenumber) AS line FROM lineitem GROUP BY l_suppkey""")
def w4(t):
    lines = t("lineitem").select(F.col("l_suppkey").cast("string").alias("sta"),
                                 (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"))
    return prepare.one_per_station(lines, "line")


@query("W4_drop_repeats", """
    SELECT event_id AS line, event_type AS sta FROM (
      SELECT event_id, event_type, lag(event_type) OVER (ORDER BY event_id) AS prev FROM events)
    WHERE prev IS NULL OR prev <> event_type""")
def w4b(t):
    return prepare.drop_repeats(t("events").select(F.col("event_id").alias("line"), F.col("event_type").alias("sta")), "line")


@query("F26_without_networks", """
    SELECT s_suppkey, network FROM (SELECT s_suppkey, CASE WHEN s_acctbal < 1e3 THEN '7D' WHEN s_acctbal < 2e3 THEN 'Z5' ELSE 'NC' END AS network
    FROM supplier) WHERE network NOT IN ('7D', 'Z5')""")
def f26(t):
    net = F.when(F.col("s_acctbal") < 1e3, "7D").when(F.col("s_acctbal") < 2e3, "Z5").otherwise("NC")
    return prepare.without_networks(t("supplier").select("s_suppkey", net.alias("network")), prepare.LEFT_OUT_NETWORKS)


# --- loader ---------------------------------------------------------------------------------------


@query("F6_near_stations", q.views(f"""
    SELECT sta FROM (SELECT s.sta, {q.dist('c.lat', 'c.lon', 's.lat', 's.lon', 'stations')} AS d FROM v_station s
    CROSS JOIN (SELECT avg(lat) AS lat, avg(lon) AS lon FROM v_event) c) WHERE d <= 4.5e1""", "v_event", "v_station"))
def f6(t):
    return lnk.near_stations(t("v_station"), t("v_event"), 45.0).select("sta")


@query("F9_close_pairs", q.chain(f"""
    SELECT l.id1, l.id2, l.sta, l.idx, round({q.sep('e', 'f', 'loader')}, 6) AS sep_km FROM link l
    JOIN v_event e ON e.id = l.id1 JOIN v_event f ON f.id = l.id2
    WHERE {q.sep('e', 'f', 'loader')} <= CASE WHEN idx <= 2 THEN 8e0 ELSE 4.5e0 END"""))
def f9(t):
    links = lnk.close_pairs(lnk.with_separation(c.all_links(t), t("v_event")), 8.0, 4.5)
    return rounded(links.select("id1", "id2", "sta", "idx", "sep_km"), sep_km=6)


_OTC = "(CASE WHEN (id1 + id2) % 9 = 0 THEN -9.99e2 ELSE (id1 % 5) / 1e2 END)"


@query("F10_corrected_lags", "WITH " + q.adapter.sql_views(*_DET) + "," + q.CC_STEPS + f"""
    SELECT id1, id2, sta, phase, round(dt - {_OTC}, 6) AS dt FROM cc WHERE {_OTC} <> -9.99e2""")
def f10(t):
    otc = F.when((F.col("id1") + F.col("id2")) % 9 == 0, lnk.NO_OTC).otherwise(F.col("id1") % 5 / 1e2)
    links = lnk.corrected_lags(c.correlation_links(t).withColumn("otc", otc))
    return rounded(links.select("id1", "id2", "sta", "phase", "dt"), dt=6)


@query("F11_phases", "WITH " + q.adapter.sql_views(*_DET) + "," + q.CC_STEPS + " SELECT id1, id2, sta, phase, dt FROM cc WHERE phase = 'S'")
def f11(t):
    return lnk.keep_phases(c.correlation_links(t), "S").select("id1", "id2", "sta", "phase", "dt")


@query("F12_data_types", q.chain("SELECT id1, id2, sta, idx, round(dt, 6) AS dt FROM link WHERE idx >= 3"))
def f12(t):
    return rounded(lnk.keep_data(c.all_links(t), "ct").select("id1", "id2", "sta", "idx", "dt"), dt=6)


@query("U2_all_links", q.chain("SELECT id1, id2, sta, phase, round(dt, 6) AS dt, round(qual, 6) AS qual, idx FROM link"))
def u2(t):
    return rounded(c.all_links(t), dt=6, qual=6)


_TURNED = f"""
turned AS (SELECT least(id1, id2) AS id1, greatest(id1, id2) AS id2, sta, idx, CASE WHEN id1 > id2 THEN -dt ELSE dt END AS dt, qual FROM link),
placed AS MATERIALIZED (SELECT l.*, {q.dist('e.lat', 'e.lon', 's.lat', 's.lon', 'rays')} AS sta_dist,
    {q.azimuth('e.lat', 'e.lon', 's.lat', 's.lon')} AS az
    FROM turned l JOIN v_event e ON e.id = l.id1 JOIN v_station s ON s.sta = l.sta)"""


@query("F13_station_range", q.chain("""
    SELECT id1, id2, sta, idx, round(dt, 6) AS dt, round(sta_dist, 4) AS sta_dist FROM placed WHERE sta_dist BETWEEN 2e1 AND 6e1 OR qual <= 0""", _TURNED))
def f13(t):
    limits = LinkParams(min_pair_dist=20.0, max_pair_dist=60.0)
    near = lnk.geometry_filter(c.all_links(t), t("v_event"), t("v_station"), limits)
    kept = lnk.station_geometry(near, t("v_event"), t("v_station"))
    return rounded(kept.select("id1", "id2", "sta", "idx", "dt", "sta_dist"), dt=6, sta_dist=4)


@query("A3_azimuthal_gap", q.chain("""
    SELECT id1, id2, CAST(max(coalesce(nxt, first_az + 360) - az) AS BIGINT) AS gap FROM (
      SELECT id1, id2, az, lead(az) OVER (PARTITION BY id1, id2 ORDER BY az) AS nxt, min(az) OVER (PARTITION BY id1, id2) AS first_az
      FROM (SELECT DISTINCT id1, id2, CAST(round(az) AS INT) AS az FROM placed)) GROUP BY id1, id2""", _TURNED))
def a3(t):
    placed = lnk.station_geometry(lnk.smaller_id_first(c.all_links(t)), t("v_event"), t("v_station"))
    return lnk.azimuthal_gaps(placed).withColumn("gap", F.col("gap").cast("bigint"))


_LOADED = f"""
center AS (SELECT avg(lat) AS lat, avg(lon) AS lon FROM v_event),
near_sta AS (SELECT * FROM (SELECT s.*, {q.dist('c.lat', 'c.lon', 's.lat', 's.lon', 'stations')} AS d FROM v_station s CROSS JOIN center c) WHERE d <= 9e1),
near_link AS (SELECT l.*, {q.sep('e', 'f', 'loader')} AS sep_km FROM link l JOIN v_event e ON e.id = l.id1 JOIN v_event f ON f.id = l.id2
              WHERE l.sta IN (SELECT sta FROM near_sta) AND {q.sep('e', 'f', 'loader')} <= CASE WHEN idx <= 2 THEN 8e0 ELSE 4.5e0 END),
turn2 AS (SELECT least(l.id1, l.id2) AS id1, greatest(l.id1, l.id2) AS id2, l.sta, l.idx, CASE WHEN l.id1 > l.id2 THEN -l.dt ELSE l.dt END AS dt, l.qual FROM near_link l),
place2 AS MATERIALIZED (SELECT l.*, {q.dist('e.lat', 'e.lon', 's.lat', 's.lon', 'rays')} AS sd, {q.azimuth('e.lat', 'e.lon', 's.lat', 's.lon')} AS az
           FROM turn2 l JOIN v_event e ON e.id = l.id1 JOIN v_station s ON s.sta = l.sta),
kept2 AS (SELECT * FROM place2 WHERE NOT qual > 0 OR sd BETWEEN 5e0 AND 8e1),
gap2 AS (SELECT id1, id2, max(coalesce(nxt, f + 360) - az) AS gap FROM (
           SELECT id1, id2, az, lead(az) OVER (PARTITION BY id1, id2 ORDER BY az) AS nxt, min(az) OVER (PARTITION BY id1, id2) AS f
           FROM (SELECT DISTINCT id1, id2, CAST(round(az) AS INT) AS az FROM kept2 WHERE qual > 0)) GROUP BY id1, id2),
loaded AS MATERIALIZED (SELECT k.* FROM kept2 k LEFT JOIN gap2 g ON g.id1 = k.id1 AND g.id2 = k.id2 AND g.gap > 250 WHERE NOT k.qual > 0 OR g.id1 IS NULL)"""


def _loaded(t):
    return lnk.load_links(c.correlation_links(t), c.catalog_links(t), t("v_event"), t("v_station"), c.LOADER)


@query("J6_J7_loaded_links", q.chain("SELECT id1, id2, sta, idx, round(dt, 6) AS dt, round(qual, 6) AS qual FROM loaded", _LOADED))
def loaded(t):
    return rounded(_loaded(t)[0].select("id1", "id2", "sta", "idx", "dt", "qual"), dt=6, qual=6)


@query("J6_known_stations", q.chain("SELECT id1, id2, sta, idx FROM link WHERE sta IN (SELECT sta FROM v_station WHERE elev_km > 4e-1)"))
def j6(t):
    return lnk.known_stations(c.all_links(t), t("v_station").filter(F.col("elev_km") > 0.4)).select("id1", "id2", "sta", "idx")


@query("J7_known_pairs", q.chain("""
    SELECT id1, id2, sta, idx FROM link WHERE id1 IN (SELECT id FROM v_event WHERE depth_km < 2.4e1)
    AND id2 IN (SELECT id FROM v_event WHERE depth_km < 2.4e1)"""))
def j7(t):
    return lnk.known_pairs(c.all_links(t), t("v_event").filter(F.col("depth_km") < 24.0)).select("id1", "id2", "sta", "idx")


@query("J9_linked_events", q.chain("""
    SELECT 'event' AS kind, CAST(id AS STRING) AS name FROM v_event WHERE id IN (SELECT id1 FROM loaded) OR id IN (SELECT id2 FROM loaded)
    UNION ALL SELECT 'station', sta FROM near_sta WHERE sta IN (SELECT sta FROM loaded)""", _LOADED))
def j9(t):
    _, events, stations = _loaded(t)
    return events.select(F.lit("event").alias("kind"), F.col("id").cast("string").alias("name")).unionByName(
        stations.select(F.lit("station").alias("kind"), F.col("sta").alias("name")))


@query("F14_surface_stations", q.views("SELECT sta, round(greatest(elev_km, 0e0), 6) AS elev_km FROM v_station", "v_station"))
def f14(t):
    m = t("v_station").select("sta", (F.col("elev_km") * 1000.0).alias("elev_m"))
    return rounded(lnk.surface_stations(m).select("sta", "elev_km"), elev_km=6)


@query("F15_clean_events", q.views("""
    SELECT id, CAST(CASE WHEN mag > 4.5e-1 THEN year(origin_time) * 10000 + month(origin_time) * 100 + day(origin_time)
           ELSE 19000000 + 840101 + id % 20 END AS BIGINT) AS date, greatest(depth_km - 6e0, 1e-2) AS depth_km FROM v_event""", "v_event"))
def f15(t):
    date = F.when(F.col("mag") > 0.45, timefn.date_int("origin_time").cast("bigint")).otherwise(840101 + F.col("id") % 20)
    raw = t("v_event").select("id", date.alias("date"), (F.col("depth_km") - 6.0).alias("depth_km"))
    return lnk.clean_events(raw)


@query("F16_choose_events", q.views("""
    SELECT id, id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS marked_bad FROM v_event
    WHERE id IN (SELECT o_custkey FROM orders)""", "v_event"))
def f16(t):
    listed = t("orders").select(F.col("o_custkey").alias("id"))
    bad = t("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("id"))
    return lnk.choose_events(t("v_event"), listed, bad).select("id", "marked_bad")


@query("A20_id_problems", q.views("""
    SELECT id, CAST(n AS BIGINT) AS n, CASE WHEN n = 0 THEN 'missing' ELSE 'repeated' END AS problem FROM (
      SELECT e.id, count(o.o_custkey) AS n FROM v_event e LEFT JOIN orders o ON o.o_custkey = e.id GROUP BY e.id) WHERE n <> 1
    UNION ALL SELECT -1 - s_nationkey, count(*), 'repeated' FROM supplier GROUP BY s_nationkey HAVING count(*) > 1""", "v_event"))
def a20(t):
    """Events against the customers of all orders, and nations that label more than one supplier."""
    found = lnk.id_problems(t("orders").select(F.col("o_custkey").alias("id")), t("v_event"))
    labels = lnk.duplicate_stations(t("supplier").select(F.col("s_nationkey").cast("bigint").alias("sta")))
    return found.select("id", F.col("n").cast("bigint").alias("n"), "problem").unionByName(
        labels.select((-1 - F.col("sta")).alias("id"), F.col("n").cast("bigint").alias("n"), F.lit("repeated").alias("problem")))


# --- clusters ---------------------------------------------------------------------------------------

_COMP = """
strong AS (SELECT least(id1, id2) AS a, greatest(id1, id2) AS b, count(*) AS n FROM ct GROUP BY 1, 2 HAVING count(*) >= 31),
edge AS (SELECT a, b FROM strong UNION SELECT b, a FROM strong),
reach AS (SELECT DISTINCT a AS id, a AS root FROM edge UNION SELECT e.b, r.root FROM reach r JOIN edge e ON e.a = r.id),
comp AS (SELECT id, min(root) AS component FROM reach GROUP BY id),
size AS (SELECT component, count(*) AS n_events FROM comp GROUP BY component),
numbered AS (SELECT component, n_events, row_number() OVER (ORDER BY n_events DESC, component) AS cluster_id FROM size)"""


def _components_sql(select: str) -> str:
    return q.pairing("", "v_event").replace("WITH ", "WITH RECURSIVE ", 1) + "," + _COMP + "\n" + select


def _components(t):
    links = lnk.one_table(None, c.catalog_links(t))
    strong = cluster.pair_strength(links).filter(F.col("n_links") >= 31)
    return cluster.connected_components(strong.select("a", "b"))


@query("A4_components", _components_sql("SELECT id, component FROM comp"))
def a4(t):
    return _components(t)


@query("A5_cluster_sizes", _components_sql("""
    SELECT component, n_events FROM size UNION ALL SELECT -1, count(*) FROM v_event WHERE id NOT IN (SELECT id FROM comp)"""))
def a5(t):
    """Events per component, and the number of isolated events under component -1."""
    comp = _components(t)
    alone = cluster.isolated_events(t("v_event"), comp).agg(F.count(F.lit(1)).alias("n_events"))
    return cluster.cluster_sizes(comp).unionByName(alone.select(F.lit(-1).cast("bigint").alias("component"), "n_events"))


@query("W5_ranked_clusters", _components_sql("""
    SELECT e.id, CAST(n.cluster_id AS BIGINT) AS cluster_id FROM v_event e LEFT JOIN comp c ON c.id = e.id
    LEFT JOIN numbered n ON n.component = c.component"""))
def w5(t):
    return cluster.cluster_events(lnk.one_table(None, c.catalog_links(t)), t("v_event"), 0, 31)


_FAR, _NORTH, _EAST = 1_000_000, 6.0, 30.0

_TWO = f"""
two_event AS (SELECT id, lat, lon, depth_km FROM v_event UNION ALL SELECT id + {_FAR}, lat + {_NORTH}e0, lon + {_EAST}e0, depth_km FROM v_event),
two_station AS (SELECT sta, lat, lon FROM v_station UNION ALL SELECT 'T' || sta, lat + {_NORTH}e0, lon + {_EAST}e0 FROM v_station),
two_link AS (SELECT id1, id2, sta, dt, qual, idx FROM link UNION ALL SELECT id1 + {_FAR}, id2 + {_FAR}, 'T' || sta, dt, qual, idx FROM link),
{_COMP.replace("FROM ct GROUP", "FROM two_link WHERE idx >= 3 GROUP").strip()},
member AS (SELECT c.id, n.cluster_id FROM comp c JOIN numbered n ON n.component = c.component),
middle AS (SELECT m.cluster_id, avg(e.lat) AS lat, avg(e.lon) AS lon FROM member m JOIN two_event e ON e.id = m.id GROUP BY m.cluster_id),
around AS (SELECT c.cluster_id, s.* FROM middle c JOIN two_station s ON {q.dist('c.lat', 'c.lon', 's.lat', 's.lon', 'stations')} <= 9e1),
own AS (SELECT m.cluster_id, least(l.id1, l.id2) AS id1, greatest(l.id1, l.id2) AS id2, l.sta, l.idx, CASE WHEN l.id1 > l.id2 THEN -l.dt ELSE l.dt END AS dt, l.qual
        FROM two_link l JOIN member m ON m.id = l.id1 JOIN member n ON n.id = l.id2 AND n.cluster_id = m.cluster_id
        JOIN two_event e ON e.id = l.id1 JOIN two_event f ON f.id = l.id2 JOIN around a ON a.cluster_id = m.cluster_id AND a.sta = l.sta
        WHERE {q.sep('e', 'f', 'loader')} <= CASE WHEN idx <= 2 THEN 8e0 ELSE 4.5e0 END),
seen AS MATERIALIZED (SELECT l.*, {q.dist('e.lat', 'e.lon', 's.lat', 's.lon', 'rays')} AS sd, {q.azimuth('e.lat', 'e.lon', 's.lat', 's.lon')} AS az
         FROM own l JOIN two_event e ON e.id = l.id1 JOIN two_station s ON s.sta = l.sta),
ranged AS (SELECT * FROM seen WHERE NOT qual > 0 OR sd BETWEEN 5e0 AND 8e1),
wide AS (SELECT id1, id2 FROM (
           SELECT id1, id2, az, lead(az) OVER (PARTITION BY id1, id2 ORDER BY az) AS nxt, min(az) OVER (PARTITION BY id1, id2) AS f
           FROM (SELECT DISTINCT id1, id2, CAST(round(az) AS INT) AS az FROM ranged WHERE qual > 0)) GROUP BY id1, id2 HAVING max(coalesce(nxt, f + 360) - az) > 250),
own_loaded AS MATERIALIZED (SELECT r.* FROM ranged r LEFT JOIN wide w ON w.id1 = r.id1 AND w.id2 = r.id2 WHERE NOT r.qual > 0 OR w.id1 IS NULL)"""


def _two_regions(t):
    """The test catalog and a copy of it far away: events, stations, correlation and catalog links."""
    def also(df, columns, ids, names=(), places=False):
        far = df.select(*columns).withColumns({i: F.col(i) + _FAR for i in ids}).withColumns({n: F.concat(F.lit("T"), n) for n in names})
        if places:
            far = far.withColumns({"lat": F.col("lat") + _NORTH, "lon": F.col("lon") + _EAST})
        return df.select(*columns).unionByName(far)

    pair = ["id1", "id2", "sta", "phase"]
    return (
        also(t("v_event"), ["id", "lat", "lon", "depth_km"], ["id"], places=True),
        also(t("v_station"), ["sta", "lat", "lon", "elev_km"], [], ["sta"], places=True),
        also(c.correlation_links(t), [*pair, "dt", "qual", "otc"], ["id1", "id2"], ["sta"]),
        also(checkpointed(c.catalog_links(t)), [*pair, "t1", "t2", "qual"], ["id1", "id2"], ["sta"]),
    )


@query("J6_cluster_loading", q.chain("""
    SELECT 'link' AS kind, CAST(cluster_id AS BIGINT) AS cluster_id, id1, id2, sta, idx, round(dt, 6) AS dt FROM own_loaded
    UNION ALL SELECT 'event', CAST(cluster_id AS BIGINT), id, NULL, NULL, NULL, NULL FROM member
      WHERE id IN (SELECT id1 FROM own_loaded) OR id IN (SELECT id2 FROM own_loaded)
    UNION ALL SELECT 'station', CAST(cluster_id AS BIGINT), NULL, NULL, sta, NULL, NULL FROM (SELECT DISTINCT cluster_id, sta FROM own_loaded)""",
    _TWO).replace("WITH ", "WITH RECURSIVE ", 1))
def j6_clusters(t):
    """Two regions far apart, clusters of their links, and what the loader keeps for each cluster."""
    events, stations, cc, ct = _two_regions(t)
    members = checkpointed(cluster.cluster_events(lnk.one_table(None, ct), events, 0, 31))
    links, used, near = lnk.load_clusters(cc, ct, events, stations, members, c.LOADER)
    none = lambda kind: F.lit(None).cast(kind)
    rows = links.select(F.lit("link").alias("kind"), "cluster_id", "id1", "id2", "sta", "idx", F.round("dt", 6).alias("dt"))
    rows = rows.unionByName(used.select(F.lit("event").alias("kind"), "cluster_id", F.col("id").alias("id1"), none("bigint").alias("id2"),
                                        none("string").alias("sta"), none("int").alias("idx"), none("double").alias("dt")))
    return rows.unionByName(near.select(F.lit("station").alias("kind"), "cluster_id", none("bigint").alias("id1"), none("bigint").alias("id2"),
                                        "sta", none("int").alias("idx"), none("double").alias("dt")))


@query("A6_centroids", q.views("""
    SELECT cluster_id, round(avg(lat), 6) AS lat0, round(avg(lon), 6) AS lon0, round(avg(depth_km), 6) AS depth_km0
    FROM v_reloc_a GROUP BY cluster_id""", "v_reloc_a"))
def a6(t):
    return rounded(cluster.centroids(t("v_reloc_a"), "cluster_id"), lat0=6, lon0=6, depth_km0=6)


@query("F19_one_cluster", q.views("SELECT id, cluster_id FROM v_reloc_a WHERE cluster_id = 3", "v_reloc_a"))
def f19(t):
    from quakespark.plans.relocate import only_cluster

    return only_cluster(t("v_reloc_a"), 3).select("id", "cluster_id")
