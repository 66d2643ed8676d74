"""Rows of comparison, selection and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakespark.operators import compare
from quakespark.registry import sqltext as q
from quakespark.registry.core import query, rounded

_AB = ("v_event", "v_reloc_a", "v_reloc_b")
_DIFF = """
d AS (SELECT a.id, (b.lat - a.lat) * 1.11e5 AS dlat, (b.lon - a.lon) * 1.11e5 * cos(radians(a.lat)) AS dlon,
             (b.depth_km - a.depth_km) * 1e3 AS dz FROM v_reloc_a a JOIN v_reloc_b b ON b.id = a.id),
diff AS (SELECT *, sqrt(dlat * dlat + dlon * dlon) AS h, sqrt(dlat * dlat + dlon * dlon + dz * dz) AS total FROM d)"""


def _diff(select):
    return "WITH " + q.adapter.sql_views(*_AB) + "," + _DIFF + "\n" + select


def _compared(t):
    return compare.compare_relocations(t("v_reloc_a"), t("v_reloc_b"))


@query("J12_G6_differences", _diff("SELECT id, round(dlat, 3) AS dlat_m, round(dlon, 3) AS dlon_m, round(dz, 3) AS ddepth_m, round(h, 3) AS horizontal_m, round(total, 3) AS total_m FROM diff"))
def j12(t):
    cols = ("dlat_m", "dlon_m", "ddepth_m", "horizontal_m", "total_m")
    return rounded(_compared(t).select("id", *cols), **{n: 3 for n in cols})


@query("A17_difference_summary", _diff(" UNION ALL ".join(
    f"SELECT '{n}' AS difference, count(*) AS n, round(avg({x}), 3) AS mean, round(median({x}), 3) AS median, round(max({x}), 3) AS max, round(min({x}), 3) AS min FROM diff"
    for n, x in (("horizontal", "h"), ("depth", "dz"), ("total", "total")))))
def a17(t):
    return rounded(compare.difference_summary(_compared(t)), mean=3, median=3, max=3, min=3)


@query("F23_large_differences", _diff("SELECT id, round(total, 3) AS total_m FROM diff WHERE total > 1e1"))
def f23(t):
    return rounded(compare.large_differences(_compared(t)).select("id", "total_m"), total_m=3)


@query("A16_extent", q.views("""
    SELECT round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat, round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon,
           round(min(depth_km), 6) AS min_depth_km, round(max(depth_km), 6) AS max_depth_km, count(DISTINCT cluster_id) AS n_clusters
    FROM v_reloc_a""", "v_reloc_a"))
def a16(t):
    out = compare.extent(t("v_reloc_a"))
    return rounded(out, **{n: 6 for n in out.columns if n != "n_clusters"})


@query("A18_template_distances", q.views("""
    SELECT count(*) AS n, round(avg(d), 5) AS mean, round(max(d), 5) AS max, round(min(d), 5) AS min, round(median(d), 5) AS median
    FROM (SELECT sqrt(pow(r.lon - t.lon, 2) + pow(r.lat - t.lat, 2)) * 1.11e2 AS d FROM v_reloc_a r
          CROSS JOIN (SELECT lat, lon FROM v_reloc_a WHERE id = 10) t)""", "v_reloc_a"))
def a18(t):
    return rounded(compare.template_distances(t("v_reloc_a"), 10), mean=5, max=5, min=5, median=5)


@query("A19_quality_summary", q.views("""
    SELECT count(*) AS n_events, round(avg(ex_m / 1e3), 6) AS mean_ex, round(avg(ey_m / 1e3), 6) AS mean_ey,
           round(avg(ez_m / 1e3), 6) AS mean_ez, min(CASE WHEN mag = 0 THEN 2e-1 ELSE mag END) AS min_mag,
           max(CASE WHEN mag = 0 THEN 2e-1 ELSE mag END) AS max_mag FROM v_reloc_a""", "v_reloc_a"))
def a19(t):
    return rounded(compare.quality_summary(t("v_reloc_a")), mean_ex=6, mean_ey=6, mean_ez=6)


_X, _Y = "(x_m / 1e3 - 1e-1)", "(y_m / 1e3)"


@query("F20_cross_section", q.views(f"""
    SELECT id, round(along, 5) AS along_km, round(across, 5) AS across_km FROM (
      SELECT id, {_X} * cos(radians(6e1)) - {_Y} * sin(radians(6e1)) AS along,
             {_X} * cos(radians(-3e1)) - {_Y} * sin(radians(-3e1)) AS across FROM v_reloc_a) WHERE abs(across) < 2e0""", "v_reloc_a"))
def f20(t):
    out = compare.cross_section(t("v_reloc_a"), 150.0, 2.0, 0.1, 0.0)
    return rounded(out.select("id", "along_km", "across_km"), along_km=5, across_km=5)


@query("F21_near_fault", q.views("""
    SELECT id, round(d, 5) AS fault_dist_km FROM (
      SELECT id, abs(cos(atan(1.32e0)) * (-1.32e0 * x_m / 1e3 - 1.7e0 - y_m / 1e3)) AS d FROM v_reloc_a) WHERE d <= 2.8e0""", "v_reloc_a"))
def f21(t):
    return rounded(compare.near_fault(t("v_reloc_a"), -1.32, -1.7, 2.8).select("id", "fault_dist_km"), fault_dist_km=5)


@query("F22_marked", q.views("""
    SELECT id, mag > 4.5e-1 AS is_large, origin_time >= TIMESTAMP '2024-01-02 00:00:00' AS is_late, id IN (3, 20, 77) AS is_listed
    FROM v_reloc_a""", "v_reloc_a"))
def f22(t):
    return compare.marked(t("v_reloc_a"), 0.45, 20240101, [3, 20, 77]).select("id", "is_large", "is_late", "is_listed")


@query("F25_event_rows", q.views("""
    SELECT id, CAST(year(origin_time) * 10000 + month(origin_time) * 100 + day(origin_time) AS BIGINT) AS date,
           CAST(hour(origin_time) * 1000000 + minute(origin_time) * 10000 + microsecond(origin_time) // 10000 AS BIGINT) AS time,
           round((ex_m + ey_m) / 2, 6) AS eh, ez_m AS ez, 0 AS fix FROM v_reloc_a""", "v_reloc_a"))
def f25(t):
    out = compare.event_rows(t("v_reloc_a"))
    return rounded(out.select("id", F.col("date").cast("bigint").alias("date"), F.col("time").cast("bigint").alias("time"), "eh", "ez", "fix"), eh=6)


@query("F27_with_observations", q.views("""
    SELECT s.sta FROM v_station s WHERE s.sta IN (SELECT sta FROM v_pick)""", "v_event", "v_station", "v_pick"))
def f27(t):
    counts = t("v_pick").groupBy("sta").agg(
        F.count_if(F.col("phase") == "P").alias("n_ct_p"), F.count_if(F.col("phase") == "S").alias("n_ct_s"))
    rows = t("v_station").join(counts, "sta", "left").fillna(0, ["n_ct_p", "n_ct_s"])
    rows = rows.withColumn("n_cc_p", F.lit(0)).withColumn("n_cc_s", F.lit(0))
    return compare.with_observations(rows).select("sta")


@query("J16_with_detections", q.views("""
    SELECT d.event_id, d.sta, round(r.lat, 6) AS lat, round(r.lon, 6) AS lon FROM v_detection d JOIN v_reloc_a r ON CAST(r.id AS STRING) = d.event_id""",
    "v_event", "v_station", "v_pick", "v_detection", "v_reloc_a"))
def j16(t):
    moved = t("v_reloc_a").select(F.col("id").cast("string").alias("event_id"), "lat", "lon")
    return rounded(compare.with_detections(moved, t("v_detection")).select("event_id", "sta", "lat", "lon"), lat=6, lon=6)
