"""Rows of one iteration, the solver and whole relocations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from quakespark.functions import geo
from quakespark.operators import cluster, raytrace, solve, stats, weights
from quakespark.params import IterationParams, RelocationParams, params_for
from quakespark.plans import relocate as rel
from quakespark.plans import workflows
from quakespark.registry import common as c
from quakespark.registry import sqltext as q
from quakespark.registry.core import PAIRING, query, rounded
from quakespark.session import checkpointed

SCHEDULE = (
    IterationParams(last=2, w_ccp=0.01, w_ccs=0.005, w_ctp=1.0, w_cts=0.5, damp=30.0),
    IterationParams(last=4, w_ccp=1.0, w_ccs=0.5, w_ctp=0.1, w_cts=0.05, res_cc=6.0, res_ct=6.0, dist_cc=3.0, dist_ct=5.0, damp=25.0),
)


# --- schedule, weights, residuals -----------------------------------------------------------------


@query("R1_schedule", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 <= 2 THEN 3e1 ELSE 2.5e1 END AS damp FROM orders""")
def r1(t):
    """Damping valid for an iteration number taken from every order."""
    damp = F.element_at(F.array(*[F.lit(params_for(SCHEDULE, i).damp) for i in range(6)]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return t("orders").select("o_orderkey", damp.alias("damp"))


@query("R2_prior_weight", q.chain("""
    SELECT id1, id2, sta, idx, round(qual * (CASE idx WHEN 1 THEN 1e0 WHEN 2 THEN 5e-1 WHEN 3 THEN 8e-1 ELSE 4e-1 END), 6) AS wt FROM link"""))
def r2(t):
    return c.all_links(t).select("id1", "id2", "sta", "idx", F.round(weights.prior_weight(c.STEP), 6).alias("wt"))


@query("J11_used_paths", q.chain("SELECT DISTINCT sta, id FROM path", q.RAY_STEPS))
def j11(t):
    return raytrace.used_paths(c.all_links(t))


_ANGLE, _SPEED = "angle * 3.141593e0 / 1.8e2", {"p": "6e0", "s": "(6e0 / 1.73e0)"}
_SLOWNESS = ", ".join(
    f"""round(sin({_ANGLE}) * cos((az - 9e1) * 3.141593e0 / 1.8e2) / {v}, 6) AS {n}x, round(sin({_ANGLE}) * cos(az * 3.141593e0 / 1.8e2) / {v}, 6) AS {n}y,
        round(cos({_ANGLE}) / {v} * (CASE WHEN h < 0 THEN -1 ELSE 1 END), 6) AS {n}z""" for n, v in _SPEED.items())


@query("R3_straight_rays", q.chain(f"SELECT sta, id, round(tt_p, 6) AS tt_p, round(tt_s, 6) AS tt_s, round(angle, 4) AS angle, {_SLOWNESS} FROM ray", q.RAY_STEPS))
def r3(t):
    out = c.rays(t, c.all_links(t)).withColumnRenamed("angle_p", "angle")
    partials = ("px", "py", "pz", "sx", "sy", "sz")
    return rounded(out.select("sta", "id", "tt_p", "tt_s", "angle", *partials), tt_p=6, tt_s=6, angle=4, **{n: 6 for n in partials})


@query("J8_R8_residuals", q.chain("SELECT id1, id2, sta, idx, round(res, 6) AS res FROM res", q.RAY_STEPS))
def r8(t):
    return rounded(c.residual_links(t).select("id1", "id2", "sta", "idx", "res"), res=6)


@query("R8_shifted_sources", q.chain("""
    SELECT id1, id2, sta, idx, round(dt - (cal - ((id1 % 7 - 3) * 5e0 - (id2 % 7 - 3) * 5e0) / 1e3), 6) AS res FROM res""", q.RAY_STEPS))
def r8_shifted(t):
    """Residuals with source time shifts of up to 15 ms."""
    links = c.with_offsets(t, c.all_links(t))
    shifts = t("v_event").select("id", ((F.col("id") % 7 - 3) * 5.0).alias("t"))
    res = weights.residuals(weights.with_travel_times(links, c.rays(t, links)), shifts)
    return rounded(res.select("id1", "id2", "sta", "idx", "res"), res=6)


@query("R9_distance_weight", q.chain("""
    SELECT id1, id2, sta, idx, round(CASE WHEN idx <= 2 THEN pow(1e0 - pow(offs_m / 3e4, 5), 5) ELSE pow(1e0 - pow(offs_m / 6e3, 3), 3) END, 4) AS w FROM res""", q.RAY_STEPS))
def r9(t):
    links = c.with_offsets(t, c.all_links(t)).join(t("v_station").select("sta"), "sta", "left_semi")
    return links.select("id1", "id2", "sta", "idx", F.round(weights.distance_factor(F.col("offs_m"), c.STEP), 4).alias("w"))


@query("A8_median_mad", q.chain("SELECT cc, round(med, 6) AS med, round(mad, 6) AS mad FROM mad", q.RAY_STEPS, q.SPREAD_STEPS))
def a8(t):
    return rounded(weights.spreads(checkpointed(c.residual_links(t).select("idx", "res")), []).select("cc", "med", "mad"), med=6, mad=6)


@query("R10_weights", q.chain("SELECT id1, id2, sta, idx, round(wt, 4) AS wt FROM wres", q.RAY_STEPS, q.WEIGHT_STEPS))
def r10(t):
    return rounded(c.weighted_links(t).select("id1", "id2", "sta", "idx", "wt"), wt=4)


@query("F17_usable_links", q.chain("SELECT id1, id2, sta, idx, round(wt, 5) AS wt FROM wres WHERE wt >= 1e-5", q.RAY_STEPS, q.WEIGHT_STEPS))
def f17(t):
    return rounded(weights.usable_links(c.weighted_links(t)).select("id1", "id2", "sta", "idx", "wt"), wt=5)


@query("J15_zero_weight", q.chain("""
    SELECT id1, id2, sta, idx, CASE WHEN e.depth_km < 8e0 OR f.depth_km < 8e0 THEN 0e0 ELSE round(w.qual, 6) END AS wt
    FROM link w JOIN v_event e ON e.id = w.id1 JOIN v_event f ON f.id = w.id2"""))
def j15(t):
    """Shallow events taken as air quakes."""
    links = c.all_links(t).withColumn("wt", F.round("qual", 6))
    air = t("v_event").filter(F.col("depth_km") < 8.0)
    return weights.zero_air_quakes(links, air).select("id1", "id2", "sta", "idx", "wt")


# --- statistics -----------------------------------------------------------------------------------

_USED = q.WEIGHT_STEPS + ", u AS MATERIALIZED (SELECT * FROM wres WHERE wt >= 1e-5)"


def _used(t, rays=False):
    return weights.usable_links(c.weighted_links(t, rays))


@query("A9_rms", q.chain("""
    SELECT CAST(n_cc AS BIGINT) AS n_cc, CAST(n_ct AS BIGINT) AS n_ct,
           round(sqrt((d2c - pow(avc, 2) / n_cc) / (n_cc - 1)), 5) AS rms_cc_plain,
           round(sqrt((fc * fc * w2c - pow(fc * wac, 2) / n_cc) / (n_cc - 1)), 5) AS rms_cc,
           round(sqrt((d2t - pow(avt, 2) / n_ct) / (n_ct - 1)), 5) AS rms_ct_plain,
           round(sqrt((ft * ft * w2t - pow(ft * wat, 2) / n_ct) / (n_ct - 1)), 5) AS rms_ct
    FROM (SELECT *, n_cc / wc AS fc, n_ct / wt_ AS ft FROM (SELECT
           count(*) FILTER (idx <= 2) AS n_cc, count(*) FILTER (idx > 2) AS n_ct,
           sum(wt) FILTER (idx <= 2) AS wc, sum(wt) FILTER (idx > 2) AS wt_,
           sum(res * res) FILTER (idx <= 2) AS d2c, sum(res * res) FILTER (idx > 2) AS d2t,
           avg(res) FILTER (idx <= 2) AS avc, avg(res) FILTER (idx > 2) AS avt,
           sum(wt * res * wt * res) FILTER (idx <= 2) AS w2c, sum(wt * res * wt * res) FILTER (idx > 2) AS w2t,
           avg(wt * res) FILTER (idx <= 2) AS wac, avg(wt * res) FILTER (idx > 2) AS wat FROM u))""", q.RAY_STEPS, _USED))
def a9(t):
    return rounded(stats.rms_table(_used(t)), rms_cc_plain=5, rms_cc=5, rms_ct_plain=5, rms_ct=5)


@query("A10_residual_summary", q.chain("""
    SELECT CAST(n AS BIGINT) AS n, CAST(ne AS BIGINT) AS n_events, round(m, 6) AS mean, round(wm * n / w, 6) AS weighted_mean,
           round(v * n * 1e6 / greatest(n - 4 * ne, 1), 2) AS variance, round(wv * n * 1e6 / greatest(n - 4 * ne, 1), 2) AS weighted_variance
    FROM (SELECT count(*) AS n, avg(res) AS m, avg(wt * res) AS wm, sum(wt) AS w, var_pop(res) AS v, var_pop(wt * res) AS wv FROM u)
    CROSS JOIN (SELECT count(*) AS ne FROM (SELECT id1 FROM u UNION SELECT id2 FROM u))""", q.RAY_STEPS, _USED))
def a10(t):
    used = _used(t)
    out = stats.residual_summary(used, stats.linked_event_counts(used))
    return rounded(out, mean=6, weighted_mean=6, variance=2, weighted_variance=2)


_COUNTS = """count(*) FILTER (idx = 1) AS n_cc_p, count(*) FILTER (idx = 2) AS n_cc_s, count(*) FILTER (idx = 3) AS n_ct_p,
           count(*) FILTER (idx = 4) AS n_ct_s, round(sqrt(avg(res * res) FILTER (idx <= 2)), 6) AS rms_cc,
           round(sqrt(avg(res * res) FILTER (idx > 2)), 6) AS rms_ct"""


@query("A11_station_results", q.chain(f"SELECT sta, {_COUNTS} FROM u GROUP BY sta", q.RAY_STEPS, _USED))
def a11(t):
    return rounded(stats.station_results(_used(t)), rms_cc=6, rms_ct=6)


@query("A12_event_results", q.chain(
    f"SELECT id, {_COUNTS} FROM (SELECT id1 AS id, idx, res FROM u UNION ALL SELECT id2, idx, res FROM u) GROUP BY id", q.RAY_STEPS, _USED))
def a12(t):
    return rounded(stats.event_results(_used(t)), rms_cc=6, rms_ct=6)


@query("A13_kept_shares", q.chain("""
    SELECT round(1e2 * ne / ne0, 4) AS pct_events, round(1e2 * c / c0, 4) AS pct_cc, round(1e2 * k / k0, 4) AS pct_ct,
           round(coh, 6) AS mean_coherency, round(quality, 6) AS mean_quality
    FROM (SELECT count(*) FILTER (idx <= 2) AS c, count(*) FILTER (idx > 2) AS k, avg(sqrt(qual)) FILTER (idx <= 2) AS coh,
                 avg(qual) FILTER (idx > 2) AS quality FROM u)
    CROSS JOIN (SELECT count(*) AS ne FROM (SELECT id1 FROM u UNION SELECT id2 FROM u))
    CROSS JOIN (SELECT count(*) FILTER (idx <= 2) AS c0, count(*) FILTER (idx > 2) AS k0 FROM link)
    CROSS JOIN (SELECT count(*) AS ne0 FROM (SELECT id1 FROM link UNION SELECT id2 FROM link))""", q.RAY_STEPS, _USED))
def a13(t):
    out = stats.kept_shares(_used(t), stats.start_counts(c.all_links(t)))
    return rounded(out, pct_events=4, pct_cc=4, pct_ct=4, mean_coherency=6, mean_quality=6)


@query("A15_worst_stations", q.chain("""
    , st AS (SELECT sta, sqrt(avg(res * res) FILTER (idx <= 2)) AS rc, sqrt(avg(res * res) FILTER (idx > 2)) AS rt FROM u GROUP BY sta)
    SELECT * FROM (SELECT sta AS sta_cc, round(rc, 6) AS max_rms_cc FROM st WHERE rc IS NOT NULL ORDER BY rc DESC, sta LIMIT 1)
    CROSS JOIN (SELECT sta AS sta_ct, round(rt, 6) AS max_rms_ct FROM st WHERE rt IS NOT NULL ORDER BY rt DESC, sta LIMIT 1)""", q.RAY_STEPS, _USED))
def a15(t):
    return rounded(stats.worst_stations(stats.station_results(_used(t))), max_rms_cc=6, max_rms_ct=6)


@query("W7_change_percent", q.views("""
    SELECT cluster_id, it AS iteration, round((m - prev) * 1e2 / abs(prev), 4) AS rms_change_pct FROM (
      SELECT cluster_id, it, m, lag(m) OVER (PARTITION BY cluster_id ORDER BY it) AS prev FROM (
        SELECT cluster_id, id // 25 AS it, avg(ex_m) + 1e0 AS m FROM v_reloc_a GROUP BY 1, 2))""", "v_reloc_a"))
def w7(t):
    """Mean errors by blocks of ids stand for iterations."""
    m = t("v_reloc_a").groupBy("cluster_id", F.expr("id div 25").alias("iteration")).agg((F.avg("ex_m") + 1.0).alias("rms"))
    return rounded(stats.change_percent(m, ["rms"], ["cluster_id"]).drop("rms"), rms_change_pct=4)


# --- design rows, scaling, start ------------------------------------------------------------------

_ENTRY = f"""
dir AS (SELECT sta, id, sin(angle * 3.141593e0 / 1.8e2) * cos((az - 9e1) * 3.141593e0 / 1.8e2) AS x,
               sin(angle * 3.141593e0 / 1.8e2) * cos(az * 3.141593e0 / 1.8e2) AS y,
               cos(angle * 3.141593e0 / 1.8e2) * (CASE WHEN h < 0 THEN -1 ELSE 1 END) AS z FROM ray),
g AS (SELECT u.id1, u.id2, u.sta, u.idx, u.res, u.wt, u.wt / (CASE WHEN u.phase = 'P' THEN 6e0 ELSE 6e0 / 1.73e0 END) AS f,
             a.x AS x1, a.y AS y1, a.z AS z1, b.x AS x2, b.y AS y2, b.z AS z2
      FROM u JOIN dir a ON a.sta = u.sta AND a.id = u.id1 JOIN dir b ON b.sta = u.sta AND b.id = u.id2),
entry AS MATERIALIZED (
  SELECT id1, id2, sta, idx, id1 AS id, 0 AS param, x1 * f AS value FROM g UNION ALL SELECT id1, id2, sta, idx, id1, 1, y1 * f FROM g
  UNION ALL SELECT id1, id2, sta, idx, id1, 2, z1 * f FROM g UNION ALL SELECT id1, id2, sta, idx, id1, 3, wt FROM g
  UNION ALL SELECT id1, id2, sta, idx, id2, 0, -x2 * f FROM g UNION ALL SELECT id1, id2, sta, idx, id2, 1, -y2 * f FROM g
  UNION ALL SELECT id1, id2, sta, idx, id2, 2, -z2 * f FROM g UNION ALL SELECT id1, id2, sta, idx, id2, 3, -wt FROM g)"""


@query("R12_design_rows", q.chain("SELECT id1, id2, sta, idx, id, param, round(value, 4) + 0e0 AS value FROM entry", q.RAY_STEPS, _USED, _ENTRY))
def r12(t):
    rows = solve.design_entries(_used(t, rays=True), [])
    return rounded(rows, value=4).withColumn("value", F.col("value") + 0.0)


@query("R13_column_norms", q.chain("""
    SELECT id, param, round(sqrt(sum(value * value) / (SELECT count(*) FROM g)), 6) AS norm FROM entry GROUP BY id, param""", q.RAY_STEPS, _USED, _ENTRY))
def r13(t):
    return rounded(solve.column_norms(_used(t, rays=True), []), norm=6)


@query("R14_transposed_product", q.chain("""
    SELECT e.id, e.param, round(sum(e.value * u.wt * u.res * 1e3), 3) AS product FROM entry e
    JOIN u ON u.id1 = e.id1 AND u.id2 = e.id2 AND u.sta = e.sta AND u.idx = e.idx GROUP BY e.id, e.param""", q.RAY_STEPS, _USED, _ENTRY))
def r14_product(t):
    """One product of the solver: design matrix transposed times the weighted residuals."""
    sums = solve.event_sums(solve.pair_blocks(_fixed(_used(t, rays=True)), []), [])
    return sums.select("id", F.posexplode("data").alias("param", "product")).withColumn("product", F.round("product", 3))


def _fixed(links):
    return links.withColumn("fix1", F.lit(0)).withColumn("fix2", F.lit(0))


@query("R15_fix_rows", q.views("""
    SELECT e.id, f.param, f.value FROM v_event e JOIN (VALUES (1, 2, 1e2), (2, 2, 1e2), (2, 3, 1e2), (3, 0, 1e1), (3, 1, 1e1), (3, 2, 1e1),
    (4, 0, 1e2), (4, 1, 1e2), (4, 2, 1e2), (4, 3, 1e2), (5, 3, 1e3), (6, 0, 1e2), (6, 1, 1e2)) f(code, param, value) ON f.code = e.id % 8""", "v_event"))
def r15(t):
    return solve.fix_entries(t("v_event").withColumn("fix", (F.col("id") % 8).cast("int")), [])


# the local frame of an origin (lat0, lon0) in SQL, with the constants of ``functions.geo``
_RAD = f"{geo.FRAME_RAD!r}::DOUBLE"


def _geocentric(lat):
    return f"atan(ratio * tan(({lat}) * {_RAD}))"


def _frame(origins):
    """Steps that add km per minute and the geocentric latitude to the rows of ``origins``."""
    return f"""
    f1 AS (SELECT *, tan(lat0 * {_RAD} - sin(lat0 * {_RAD} * 2) / 2.9826e2) / tan(lat0 * {_RAD}) AS ratio FROM {origins}),
    f2 AS (SELECT *, {_geocentric('lat0')} AS here, {_geocentric('lat0 + 1e0 / 6e1')} AS next FROM f1),
    f3 AS (SELECT *, 6.378135e3 * (1e0 - sin(here) * sin(here) / 2.9826e2) AS radius,
                  acos(sin(here) * sin(here) + cos({_RAD} / 6e1) * cos(here) * cos(here)) AS minute FROM f2),
    frame AS (SELECT *, radius * (next - here) AS km_lat, radius * minute / cos(here) AS km_lon FROM f3)"""


def _north(lat):
    return f"(({lat}) - lat0) * 6e1 * km_lat"


def _east(lat, lon):
    return f"(({lon}) - lon0) * 6e1 * km_lon * cos(({_geocentric(lat)} + here) / 2)"


_START = """
o AS (SELECT cluster_id, avg(lat) AS lat0, avg(lon) AS lon0, avg(depth_km) AS dep0 FROM v_reloc_a GROUP BY cluster_id),""" + _frame("o")


@query("R11_start_sources", "WITH " + q.adapter.sql_views("v_reloc_a") + "," + _START + """
    SELECT r.id, r.cluster_id, round(o.lat0, 6) AS lat, round(o.lon0, 6) AS lon, round(o.dep0, 6) AS depth_km, 0e0 AS x, 0e0 AS y, 0e0 AS z, 0e0 AS t,
           round((r.depth_km - o.dep0) * 1e3, 3) AS z_catalog, round(""" + _east("r.lat", "r.lon") + """ * 1e3, 1) AS x_catalog,
           round(""" + _north("r.lat") + """ * 1e3, 2) AS y_catalog
    FROM v_reloc_a r JOIN frame o ON o.cluster_id = r.cluster_id""")
def r11(t):
    base = t("v_reloc_a").select("id", "cluster_id", "lat", "lon", "depth_km").join(cluster.centroids(t("v_reloc_a"), "cluster_id"), "cluster_id")
    one = rel.initial_sources(base, "centroid").select("id", "cluster_id", "lat", "lon", "depth_km", "x", "y", "z", "t")
    own = rel.initial_sources(base, "catalog").select("id", *[F.col(n).alias(f"{n}_catalog") for n in "xyz"])
    return rounded(one.join(own, "id"), lat=6, lon=6, depth_km=6, x_catalog=1, y_catalog=2, z_catalog=3)


def _step(t):
    """A made step: shifts and errors as simple functions of the id."""
    return t("v_event").select(
        "id", ((F.col("id") % 11 - 5) * 10.0).alias("dx"), ((F.col("id") % 7 - 3) * 10.0).alias("dy"),
        ((F.col("id") % 13 - 6) * -1500.0).alias("dz"), (F.col("id") % 3 - 1.0).alias("dt"),
        *[(F.col("id") % k / 2.0).alias(n) for n, k in (("ex", 5), ("ey", 6), ("ez", 7), ("et", 8))])


def _start(t):
    base = t("v_event").withColumn("fix", F.lit(0)).withColumn("cluster_id", F.lit(1).cast("bigint"))
    return rel.initial_sources(base.join(cluster.centroids(base, "cluster_id"), "cluster_id"))


_SHIFTED = q.adapter.sql_views("v_event") + """,
o AS (SELECT avg(lat) AS lat0, avg(lon) AS lon0, avg(depth_km) AS dep0 FROM v_event),""" + _frame("o") + f""",
moved AS (SELECT e.id, frame.*, e.depth_km + (e.id % 13 - 6) * -1.5e0 AS depth_km, (e.depth_km - dep0) * 1e3 + (e.id % 13 - 6) * -1.5e3 AS z,
                 {_east('e.lat', 'e.lon')} * 1e3 + (e.id % 11 - 5) * 1e1 AS x, {_north('e.lat')} * 1e3 + (e.id % 7 - 3) * 1e1 AS y
          FROM v_event e CROSS JOIN frame),
back AS (SELECT *, lat0 + y / 1e3 / km_lat / 6e1 AS lat FROM moved)"""


@query("R18_moved_sources", f"""WITH {_SHIFTED}
    SELECT id, round(lat, 6) AS lat, round(lon0 + x / 1e3 / (km_lon * cos(({_geocentric('lat')} + here) / 2)) / 6e1, 6) AS lon,
           round(depth_km, 6) AS depth_km, round(x, 1) AS x, round(y, 2) AS y, round(z, 3) AS z, (id % 3 - 1) + 0e0 AS t,
           (id % 5) / 2 AS ex, (id % 6) / 2 AS ey, (id % 7) / 2 AS ez, (id % 8) / 2 AS et FROM back""")
def r18(t):
    moved = rel.moved_sources(_start(t), _step(t))
    return rounded(moved.select("id", "lat", "lon", "depth_km", "x", "y", "z", "t", "ex", "ey", "ez", "et"), lat=6, lon=6, depth_km=6, x=1, y=2, z=3)


@query("F18_states", q.views("""
    SELECT CAST(cluster_id AS BIGINT) AS cluster_id, CAST(CASE WHEN n - lost >= 2 AND lost = 0 THEN pos + 1 ELSE pos END AS INT) AS iteration,
           CAST(CASE WHEN n - lost >= 2 AND lost > 0 THEN 1 ELSE 0 END AS INT) AS n_redo,
           CASE WHEN n - lost < 2 THEN 'skipped' WHEN lost = 0 AND pos + 1 > 2 THEN 'done' ELSE 'active' END AS status, n - lost >= 2 AND lost = 0 AS moves
    FROM (SELECT cluster_id, 1 + cluster_id % 2 AS pos, CASE WHEN cluster_id = 5 THEN 0 ELSE count(*) END AS n,
                 CASE WHEN cluster_id % 3 = 0 THEN 0 ELSE count(*) FILTER (cluster_id < 4 AND depth_km + (id % 13) * -1.5e0 < 0) END AS lost
          FROM v_reloc_a GROUP BY cluster_id)""", "v_reloc_a"))
def f18_states(t):
    """What a step makes of clusters: redone without air quakes, moved on, done, or skipped for want of a solution."""
    rows = t("v_reloc_a").withColumn("cluster_id", F.col("cluster_id").cast("bigint"))
    number = F.col("cluster_id")
    state = rows.select("cluster_id").distinct().select(
        "cluster_id", (1 + number % 2).cast("int").alias("iteration"), F.lit(0).alias("n_redo"), F.lit(rel.ACTIVE).alias("status"),
        F.lit(2).alias("last"), (number % 3 != 0).alias("removes"))
    step = rows.filter(number < 5).select("id", "cluster_id", (F.col("id") % 13 * -1500.0).alias("dz"))
    air = rel.air_quakes(step.filter(number < 4), rows)
    return rel.next_state(state, step, air).drop("last", "removes")


@query("F18_air_quakes", q.views("SELECT id FROM v_event WHERE depth_km + (id % 13 - 6) * -1.5e0 < 0", "v_event"))
def f18(t):
    return rel.air_quakes(_step(t), _start(t)).select("id")


_STEPS = {"dx": "(id % 11 - 5) * 1e1", "dy": "(id % 7 - 3) * 1e1", "dz": "(id % 13 - 6) * -1.5e3", "dt": "(id % 3 - 1)"}
_SUMMARY = [f"round(avg(abs({v})), 5) AS mean_abs_{n}" for n, v in _STEPS.items()]
_SUMMARY += [f"round(avg((id % {k}) / 2), 5) AS mean_{n}" for n, k in (("ex", 5), ("ey", 6), ("ez", 7), ("et", 8))]
_SUMMARY += [f"round(avg({v}), 5) AS centroid_{n[1]}" for n, v in _STEPS.items()]


@query("A14_shift_summary", q.views(f"SELECT {', '.join(_SUMMARY)} FROM v_event", "v_event"))
def a14(t):
    out = stats.shift_summary(rel.moved_sources(_start(t), _step(t)))
    return rounded(out, **{n: 5 for n in out.columns})


@query("R19_separations", q.chain("""
    , p AS (SELECT id, x_m AS x, y_m AS y, z_m AS z FROM (SELECT id, (lon + 1.2445e2) * 8.46e4 AS x_m, (lat - 4.035e1) * 1.11e5 AS y_m, (depth_km - 1.5e1) * 1e3 AS z_m FROM v_event))
    SELECT l.id1, l.id2, l.sta, l.idx, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), 4) AS offs_m
    FROM link l JOIN p a ON a.id = l.id1 JOIN p b ON b.id = l.id2"""))
def r19(t):
    pos = t("v_event").select("id", ((F.col("lon") + 124.45) * 84600.0).alias("x"), ((F.col("lat") - 40.35) * 111000.0).alias("y"),
                              ((F.col("depth_km") - 15.0) * 1000.0).alias("z"))
    out = rel.separations(c.all_links(t), pos)
    return rounded(out.select("id1", "id2", "sta", "idx", "offs_m"), offs_m=4)


@query("J10_station_models", q.views("""
    SELECT sta, CASE WHEN k IN (1, 2, 3) THEN k ELSE 1 END AS model_id FROM (SELECT sta, CAST(round(elev_km * 1e1) AS INT) % 5 AS k FROM v_station)""", "v_station"))
def j10(t):
    stations = t("v_station").withColumn("model_id", F.round(F.col("elev_km") * 10).cast("int") % 5)
    return raytrace.model_of_station(stations, t.spark.createDataFrame(MODELS, raytrace.MODEL_SCHEMA)).select("sta", "model_id")


# --- layered models ------------------------------------------------------------------------------

TOP, VP = [0.0, 1.0, 3.0, 5.0, 9.0, 15.0, 25.0], [3.2, 4.8, 5.4, 5.7, 6.2, 6.6, 8.0]
LAYERED = raytrace.velocity_model(TOP, VP, [1.73] * 7)
MODELS = LAYERED + raytrace.velocity_model(TOP, [v * 1.05 for v in VP], [1.75] * 7, model_id=2) + raytrace.velocity_model(
    TOP, [v * 0.95 for v in VP], [1.7] * 7, model_id=3)

_OWN_MODEL = "CASE WHEN CAST(round(s.elev_km * 1e1) AS INT) % 5 IN (1, 2, 3) THEN CAST(round(s.elev_km * 1e1) AS INT) % 5 ELSE 1 END"


def _layered_sql(model: list[tuple], which: str) -> str:
    """First arrivals of every path: the direct ray by halving an interval, head waves from their closed form."""
    rows = []
    for n in sorted({m[0] for m in model}):
        columns = zip(*(m[1:] for m in model if m[0] == n), strict=True)
        rows.append(f"({n}, " + ", ".join("[" + ", ".join(f"{x!r}e0" for x in column) + "]" for column in columns) + ")")
    level = "sqrt(1e0 + s * s * (1e0 - rel[i] * rel[i]))"
    slow = "sqrt(v[m] * v[m] - v[i] * v[i])"
    a = "angle * 3.141593e0 / 1.8e2"
    values = {
        "tt": "time", "angle": "angle", "x": f"sin({a}) * cos((az - 9e1) * 3.141593e0 / 1.8e2) / v[src]",
        "y": f"sin({a}) * cos(az * 3.141593e0 / 1.8e2) / v[src]", "z": f"cos({a}) / v[src]",
    }
    wide = ", ".join(
        f"round(max({x}) FILTER (phase = '{w}'), {4 if n == 'angle' else 6}) AS {w + n if n in 'xyz' else n + '_' + w}" for w in "ps" for n, x in values.items())
    steps = f"""
model(model_id, top, vp, vs) AS (VALUES {", ".join(rows)}),
shot AS (
  SELECT g.sta, g.id, g.dist, g.az, s.elev_km, w.phase, m.top, CASE w.phase WHEN 'p' THEN m.vp ELSE m.vs END AS v,
         CASE WHEN len(list_filter(m.top, lambda t: abs(e.depth_km - t) < 1e-4)) > 0 THEN e.depth_km - 1e-3 ELSE e.depth_km END AS depth
  FROM geom g JOIN v_event e ON e.id = g.id JOIN v_station s ON s.sta = g.sta JOIN model m ON m.model_id = {which}
  CROSS JOIN (VALUES ('p'), ('s')) w(phase)),
lifted AS (SELECT *, depth + elev_km AS below, list_transform(top, lambda t, i: CASE WHEN i = 1 THEN 0e0 ELSE t + elev_km END) AS st FROM shot),
placed AS (SELECT *, greatest(1, len(list_filter(st, lambda t: t < below))) AS k, greatest(1, len(list_filter(top, lambda t: t < depth))) AS src FROM lifted),
legs AS MATERIALIZED (
  SELECT *, below - st[k] AS inside, list_transform(range(1, k + 1), lambda i: CASE WHEN i = k THEN below - st[k] ELSE st[i + 1] - st[i] END) AS leg,
         list_transform(v[1:k], lambda x: x / list_max(v[1:k])) AS rel FROM placed),
halved(sta, id, phase, lo, hi, n) AS (
  SELECT sta, id, phase, 0e0, dist / list_sum(list_transform(range(1, k + 1), lambda i: CASE WHEN rel[i] = 1 THEN leg[i] ELSE 0e0 END)), 0 FROM legs
  UNION ALL
  SELECT sta, id, phase, CASE WHEN reached < dist THEN s ELSE lo END, CASE WHEN reached < dist THEN hi ELSE s END, n + 1 FROM (
    SELECT *, list_sum(list_transform(range(1, k + 1), lambda i: leg[i] * rel[i] * s / {level})) AS reached
    FROM (SELECT h.*, (lo + hi) / 2 AS s, dist, k, leg, rel FROM halved h JOIN legs USING (sta, id, phase) WHERE n < 90))),
direct AS (
  SELECT *, list_sum(list_transform(range(1, k + 1), lambda i: leg[i] * sqrt(1e0 + s * s) / (v[i] * {level}))) AS t_up, rel[k] * s / sqrt(1e0 + s * s) AS u_up
  FROM (SELECT l.*, (lo + hi) / 2 AS s FROM halved JOIN legs l USING (sta, id, phase) WHERE n = 90)),
refractor AS (SELECT *, unnest(range(k + 1, len(v) + 1)) AS m FROM legs),
head AS (
  SELECT sta, id, phase, min(t) AS t_head, arg_min(u, t) AS u_head FROM (
    SELECT sta, id, phase, dist, v[k] / v[m] AS u,
           dist / v[m] + list_sum(list_transform(range(1, m), lambda i:
             ((st[i + 1] - st[i]) * (CASE WHEN i < k THEN 1 ELSE 2 END) - (CASE WHEN i = k THEN inside ELSE 0e0 END)) * {slow} / (v[i] * v[m]))) AS t,
           list_sum(list_transform(range(1, m), lambda i:
             ((st[i + 1] - st[i]) * (CASE WHEN i < k THEN 1 ELSE 2 END) - (CASE WHEN i = k THEN inside ELSE 0e0 END)) * v[i] / {slow})) AS critical
    FROM refractor WHERE v[m] > list_max(v[1:m - 1])) WHERE critical <= dist GROUP BY sta, id, phase),
arrival AS (
  SELECT d.*, CASE WHEN t_head < t_up THEN t_head ELSE t_up END AS time,
         CASE WHEN t_head < t_up THEN asin(u_head) * 5.72958e1 ELSE 1.8e2 - asin(least(u_up, 1e0)) * 5.72958e1 END AS angle
  FROM direct d LEFT JOIN head USING (sta, id, phase))"""
    select = f"SELECT sta, id, round(max(dist), 5) AS dist, round(max(az), 5) AS az, {wide} FROM arrival GROUP BY sta, id"
    return q.chain(select, q.RAY_STEPS, steps).replace("WITH ", "WITH RECURSIVE ", 1)


def _paths(t, stations):
    return raytrace.path_geometry(raytrace.used_paths(c.all_links(t)), t("v_event"), stations)


def _rounded_rays(out):
    return rounded(out, dist=5, az=5, angle_p=4, angle_s=4, **{n: 6 for n in raytrace.TT_COLUMNS})


@query("R4_R5_R6_layered_rays", _layered_sql(LAYERED, "1"))
def r6(t):
    """First arrivals (direct or head wave) of every used path in a layered model."""
    return _rounded_rays(raytrace.travel_times(_paths(t, t("v_station")), LAYERED, "layered"))


@query("R7_station_models", _layered_sql(MODELS, _OWN_MODEL))
def r7(t):
    stations = t("v_station").withColumn("model_id", F.round(F.col("elev_km") * 10).cast("int") % 5)
    stations = raytrace.model_of_station(stations, t.spark.createDataFrame(MODELS, raytrace.MODEL_SCHEMA))
    return _rounded_rays(raytrace.travel_times(_paths(t, stations), MODELS, "station"))


# --- solver and whole runs ----------------------------------------------------------------------


@query("R14_solution", q.chain("SELECT DISTINCT id, TRUE AS solved, TRUE AS has_errors FROM (SELECT id1 AS id FROM u UNION SELECT id2 FROM u)", q.RAY_STEPS, _USED))
def r14(t):
    """Damped least squares of all links, held against the normal equations formed from R12 and R13.

    An event is solved where no component of the scaled gradient is above 1e-5 of the data's length.
    """
    links = checkpointed(_fixed(_used(t, rays=True)).withColumn("cluster_id", F.lit(1)))
    places = t("v_event").select(F.lit(1).alias("cluster_id"), "id", F.col("lon").alias("x"), F.col("lat").alias("y"), (F.col("depth_km") / 100).alias("z"))
    found = checkpointed(solve.solve(links, "cluster_id", c.STEP.damp, places))
    values = found.select("id", F.posexplode(F.array(*[-F.col(n) for n in solve.SOLUTION[:4]])).alias("param", "x"))
    entries = checkpointed(solve.design_entries(links, []))
    link = ["id1", "id2", "sta", "idx"]
    fitted = entries.join(values, ["id", "param"]).groupBy(*link).agg(F.sum(F.col("value") * F.col("x")).alias("fit"))
    data = links.select(*link, (F.col("wt") * F.col("res") * 1000.0).alias("d"))
    rest = entries.join(data, link).join(fitted, link)
    sums = rest.groupBy("id", "param").agg(
        F.sum(F.col("value") * F.col("d")).alias("b"), F.sum(F.col("value") * (F.col("d") - F.col("fit"))).alias("g"))
    scaled = sums.join(values, ["id", "param"]).join(solve.column_norms(links, []), ["id", "param"]).select(
        "id", (F.col("b") / F.col("norm")).alias("b"), (F.col("g") / F.col("norm") - c.STEP.damp**2 * F.col("norm") * F.col("x")).alias("g"))
    scaled = checkpointed(scaled)
    length = scaled.agg(F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("length"))  # one row is joined
    held = scaled.crossJoin(length).groupBy("id").agg(F.bool_and(F.abs("g") <= F.col("length") * 1e-5).alias("solved"))
    errors = F.forall(F.array(*solve.SOLUTION[4:], "cond"), lambda e: e > 0)
    return held.join(found.select("id", errors.alias("has_errors")), "id")


RUN = RelocationParams(schedule=(SCHEDULE[0], replace(SCHEDULE[1], last=3)), min_cc=0, min_ct=8)


@query("R17_relocation")
def r17(t):
    """E2 and E3 end to end: pairing, loading, clusters and three iterations."""
    result = workflows.relocate_catalog(
        t("v_event"), t("v_pick"), t("v_station"), c.correlation_links(t), LAYERED, PAIRING, c.LOADER, RUN)
    return result.relocations


@query("R21_compare_methods")
def r21(t):
    one = RelocationParams(schedule=(replace(SCHEDULE[0], w_ccp=1.0, w_ccs=0.5, last=1),))
    stations = t("v_station")
    return workflows.compare_methods(
        t("v_detection"), t("v_event").select(F.col("id").cast("string").alias("event_id"), "lat", "lon", "depth_km", "mag",
                                              F.lit(0.0).alias("eh"), F.lit(0.0).alias("ez")),
        stations, LAYERED, PAIRING, c.LOADER, one)
