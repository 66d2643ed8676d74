"""SQL building blocks of the counterparts. Doubles are written with exponents, never as decimals."""

from __future__ import annotations

from quakespark import adapter

KM = {"pairing": "1.111949266e2", "loader": "1.11e2"}
RADIUS = {
    "pairing": "6.378163e3 * (1e0 + 3.35278e-3 * (1e0 / 3e0 - {c} * {c}))",
    "stations": "6.371227e3 * (1e0 - 3.37853e-3 * {c} * {c})",
    "rays": "6.378140e3 * (1e0 - 3.37853e-3 * {c} * {c})",
}


def sep(a: str, b: str, km: str = "pairing", depth: str = "depth_km") -> str:
    k = KM[km]
    return (
        f"sqrt(pow(({a}.lat - {b}.lat) * {k}, 2) + pow(({a}.lon - {b}.lon) * cos(radians({a}.lat)) * {k}, 2)"
        f" + pow({a}.{depth} - {b}.{depth}, 2))"
    )


def colat(lat: str) -> str:
    return f"(1.570796e0 - atan(9.93231e-1 * tan(({lat}) * 1.745329e-2)))"


def dist(lat1: str, lon1: str, lat2: str, lon2: str, variant: str) -> str:
    a, b, d = colat(lat1), colat(lat2), f"((({lon2}) - ({lon1})) * 1.745329e-2)"
    angle = f"acos(least(1e0, sin({a}) * sin({b}) * cos({d}) + cos({a}) * cos({b})))"
    c = f"cos(1.570796e0 - (({lat1}) + ({lat2})) * 8.726645e-3)"
    return f"({angle} * ({RADIUS[variant].format(c=c)}))"


def azimuth(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a, b, d = colat(lat1), colat(lat2), f"((({lon2}) - ({lon1})) * 1.745329e-2)"
    raw = f"(atan2(sin({d}), sin({a}) / tan({b}) - cos({a}) * cos({d})) / 1.745329e-2)"
    return f"(CASE WHEN {raw} < 0 THEN {raw} + 3.6e2 ELSE {raw} END)"


PAIR_STEPS = f"""
used AS (SELECT * FROM v_pick WHERE weight < 0 OR weight >= 0),
chosen AS (SELECT e.*, c.n_picks FROM v_event e
           JOIN (SELECT id, count(*) AS n_picks FROM used GROUP BY id HAVING count(*) >= 8) c ON c.id = e.id),
cand AS MATERIALIZED (
  SELECT * FROM (SELECT a.id AS id1, b.id AS id2, {sep('a', 'b')} AS sep,
                        (a.lat + b.lat) / 2 AS mid_lat, (a.lon + b.lon) / 2 AS mid_lon
                 FROM chosen a JOIN chosen b ON a.id < b.id) WHERE sep <= 5e0),
matched AS MATERIALIZED (
  SELECT c.id1, c.id2, c.sep, x.sta, x.phase, x.tt AS t1, y.tt AS t2,
         (abs(x.weight) + abs(y.weight)) / 2 AS qual, (x.weight < 0 OR y.weight < 0) AS important,
         {dist('s.lat', 's.lon', 'c.mid_lat', 'c.mid_lon', 'pairing')} AS dist,
         CASE WHEN s.sta IS NULL THEN 'unknown'
              WHEN {dist('s.lat', 's.lon', 'c.mid_lat', 'c.mid_lon', 'pairing')} > 2e2 THEN 'far'
              WHEN abs(x.tt - y.tt) > c.sep / (CASE WHEN x.phase = 'P' THEN 4e0 ELSE 2.3e0 END) + 5e-1 THEN 'outlier'
              ELSE 'ok' END AS status
  FROM cand c JOIN used x ON x.id = c.id1
  JOIN used y ON y.id = c.id2 AND y.sta = x.sta AND y.phase = x.phase
  LEFT JOIN v_station s ON s.sta = x.sta),
counts AS MATERIALIZED (
  SELECT id1, id2, sep, count(*) AS n_links, count(*) FILTER (phase = 'P') AS n_p, count(*) FILTER (phase = 'S') AS n_s
  FROM matched WHERE status = 'ok' GROUP BY id1, id2, sep),
walk AS (
  SELECT *, coalesce(sum(CASE WHEN n_links >= 8 THEN 1 ELSE 0 END) OVER
                     (PARTITION BY ev ORDER BY sep, nb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT *, id1 AS ev, id2 AS nb FROM counts UNION ALL SELECT *, id2 AS ev, id1 AS nb FROM counts)),
reached AS (SELECT * FROM walk WHERE before < 10),
written AS (SELECT id1, id2, sep, n_links, n_p, n_s, bool_or(ev = id1) AS forward
            FROM reached WHERE n_links >= 8 GROUP BY id1, id2, sep, n_links, n_p, n_s),
ranked AS (
  SELECT m.*, w.forward,
         row_number() OVER (PARTITION BY m.id1, m.id2
                            ORDER BY CASE WHEN m.important THEN 0e0 ELSE m.dist END, m.sta, m.phase) AS rank,
         count(*) FILTER (m.important) OVER (PARTITION BY m.id1, m.id2) AS n_important
  FROM matched m JOIN written w ON w.id1 = m.id1 AND w.id2 = m.id2 WHERE m.status = 'ok'),
ct AS MATERIALIZED (
  SELECT CASE WHEN forward THEN id1 ELSE id2 END AS id1, CASE WHEN forward THEN id2 ELSE id1 END AS id2,
         sta, phase, CASE WHEN forward THEN t1 ELSE t2 END AS t1, CASE WHEN forward THEN t2 ELSE t1 END AS t2,
         qual, sep, rank
  FROM ranked WHERE rank <= 50 + n_important)"""

CC_STEPS = """
cc AS (
  SELECT CAST(event_id AS BIGINT) AS id1, CAST(template_id AS BIGINT) AS id2, sta, 'P' AS phase, lag_p AS dt, cc_p AS qual
  FROM v_detection WHERE event_id <> template_id AND lag_p IS NOT NULL AND cc_p IS NOT NULL
  UNION ALL
  SELECT CAST(event_id AS BIGINT), CAST(template_id AS BIGINT), sta, 'S', lag_s, cc_s
  FROM v_detection WHERE event_id <> template_id AND lag_s IS NOT NULL AND cc_s IS NOT NULL)"""

LINK_STEPS = """
link AS MATERIALIZED (
  SELECT id1, id2, sta, phase, dt, qual, CASE WHEN phase = 'P' THEN 1 ELSE 2 END AS idx FROM cc
  UNION ALL
  SELECT id1, id2, sta, phase, t1 - t2, qual, CASE WHEN phase = 'P' THEN 3 ELSE 4 END FROM ct)"""

# links at known stations with separations, straight-ray travel times, residuals and weights
RAY_STEPS = f"""
path AS (SELECT DISTINCT sta, id FROM (SELECT sta, id1 AS id FROM link UNION ALL SELECT sta, id2 FROM link)),
geom AS (
  SELECT p.sta, p.id, e.depth_km + s.elev_km AS h,
         {dist('e.lat', 'e.lon', 's.lat', 's.lon', 'rays')} AS dist,
         {azimuth('e.lat', 'e.lon', 's.lat', 's.lon')} AS az
  FROM path p JOIN v_event e ON e.id = p.id JOIN v_station s ON s.sta = p.sta),
ray AS MATERIALIZED (
  SELECT *, sqrt(dist * dist + h * h) / 6e0 AS tt_p, sqrt(dist * dist + h * h) / (6e0 / 1.73e0) AS tt_s,
         CASE WHEN h < 0 THEN atan2(dist, abs(h)) * 5.72958e1 ELSE 1.8e2 - atan2(dist, abs(h)) * 5.72958e1 END AS angle
  FROM geom),
res AS MATERIALIZED (
  SELECT l.*, CASE WHEN l.phase = 'P' THEN a.tt_p - b.tt_p ELSE a.tt_s - b.tt_s END AS cal,
         l.dt - (CASE WHEN l.phase = 'P' THEN a.tt_p - b.tt_p ELSE a.tt_s - b.tt_s END) AS res,
         {sep('e', 'f', 'loader')} * 1e3 AS offs_m
  FROM link l JOIN ray a ON a.sta = l.sta AND a.id = l.id1 JOIN ray b ON b.sta = l.sta AND b.id = l.id2
  JOIN v_event e ON e.id = l.id1 JOIN v_event f ON f.id = l.id2)"""

SPREAD_STEPS = """
med AS (SELECT idx <= 2 AS cc, median(res) AS med FROM res GROUP BY idx <= 2),
mad AS (SELECT m.cc, m.med, median(abs(r.res - m.med)) / 6.7449e-1 AS mad
        FROM res r JOIN med m ON m.cc = (r.idx <= 2) GROUP BY m.cc, m.med)"""

# weights with type weights 1, 0.5, 0.8, 0.4, cutoffs of 6 MAD (cc) and 0.05 s (ct), limits 30 km (cc) and 6 km (ct)
WEIGHT_STEPS = SPREAD_STEPS + """,
prior AS (
  SELECT r.*, r.qual * (CASE idx WHEN 1 THEN 1e0 WHEN 2 THEN 5e-1 WHEN 3 THEN 8e-1 ELSE 4e-1 END)
         * (CASE WHEN idx <= 2 THEN pow(1e0 - pow(offs_m / 3e4, 5), 5) ELSE pow(1e0 - pow(offs_m / 6e3, 3), 3) END) AS w1,
         CASE WHEN idx <= 2 THEN 6e0 * m.mad ELSE 5e-2 END AS cutoff
  FROM res r JOIN mad m ON m.cc = (r.idx <= 2)),
wres AS MATERIALIZED (
  SELECT *, CASE WHEN w1 > 1e-6 THEN w1 * pow(1e0 - pow(abs(res) / cutoff, 3), 3) ELSE w1 END AS wt FROM prior)"""

_VIEWS = ("v_event", "v_station", "v_pick", "v_detection")


def pairing(select: str, *views: str) -> str:
    return "WITH " + adapter.sql_views("v_event", "v_station", "v_pick", *views) + "," + PAIR_STEPS + "\n" + select


def chain(select: str, *steps: str) -> str:
    """Views, pairing, links and the given further steps, then ``select``."""
    parts = [adapter.sql_views(*_VIEWS), PAIR_STEPS, CC_STEPS, LINK_STEPS, *steps]
    return "WITH " + ",".join(parts) + "\n" + select


def views(select: str, *wanted: str) -> str:
    return "WITH " + adapter.sql_views(*wanted) + "\n" + select
