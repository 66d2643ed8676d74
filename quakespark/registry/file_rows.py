"""Rows of sources and sinks: the views are written in the exchange formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quakespark.functions import timefn
from quakespark.operators import pairing
from quakespark.registry import common as c
from quakespark.registry import sqltext as q
from quakespark.registry.core import query, rounded
from quakespark.session import scratch_path
from quakespark.sinks import text as sink
from quakespark.sources import archive, tables, text

_DET = ("v_event", "v_station", "v_pick", "v_detection")


def _path(t, kind):
    return scratch_path(t.spark, kind)


def _floor(value):
    """Whole part as a double."""
    return F.floor(value).cast("double")


def _detection_csv(t):
    path = _path(t, "detections")
    iso = F.concat(F.date_format("origin_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    sink.write_csv(t("v_detection").select(
        "event_id", "template_id", iso.alias("origin_time"), F.col("sta").alias("station"),
        F.col("tt_p").alias("travel_time_p"), F.col("tt_s").alias("travel_time_s"),
        F.col("lag_p").alias("lag_time_p"), F.col("lag_s").alias("lag_time_s"), "cc_p", "cc_s"), path)
    return path


@query("S1_detections", q.views("""
    SELECT event_id, template_id, origin_time, sta, tt_p, tt_s, lag_p, lag_s, cc_p, cc_s FROM v_detection""", *_DET))
def s1(t):
    return tables.read_detections(t.spark, _detection_csv(t)).drop("row_id")


@query("S2_stations", q.views("SELECT sta, round(lat, 6) AS lat, round(lon, 6) AS lon, round(elev_km, 6) AS elev_km FROM v_station", "v_station"))
def s2(t):
    path = _path(t, "stations")
    sink.write_csv(t("v_station").select(
        F.lit("XX").alias("network"), F.col("sta").alias("station"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"), (F.col("elev_km") * 1000).alias("elevation")), path)
    return rounded(tables.read_stations(t.spark, path), lat=6, lon=6, elev_km=6)


@query("S3_catalog", q.views("SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon, depth_km, mag, nullif(eh, 0e0) IS NOT NULL AS has_eh, eh, 0e0 AS ez FROM v_catalog", "v_event", "v_catalog"))
def s3(t):
    """Zero uncertainties are left empty in the file, the depth uncertainty column is missing."""
    path = _path(t, "catalog")
    sink.write_csv(t("v_catalog").select(
        "event_id", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("depth_km").alias("depth"),
        F.col("mag").alias("magnitude"), F.nullif("eh", F.lit(0.0)).alias("uncertainty_x")), path)
    return rounded(tables.read_catalog(t.spark, path), lat=6, lon=6).withColumn("has_eh", F.col("eh") != 0)


def _phases(t):
    """Origin times are put on whole hundredths first, which the file holds exactly."""
    path = _path(t, "phases")
    hundredths = F.floor(timefn.epoch_micros("origin_time") / 10_000) * 10_000
    sink.write_phases(t("v_event").withColumn("origin_time", timefn.from_micros(hundredths.cast("bigint"))), t("v_pick"), path)
    return text.read_phase_file(t.spark, path)


@query("S4_K2_phase_events", q.views("""
    SELECT id, round(lat, 4) AS lat, round(lon, 4) AS lon, depth_km, round(mag, 2) AS mag, 0e0 AS eh, 0e0 AS ez, 0e0 AS rms,
           date_trunc('minute', origin_time) + to_microseconds(microsecond(origin_time) // 10000 * 10000) AS origin_time FROM v_event""", "v_event"))
def s4(t):
    events, _ = _phases(t)
    return rounded(events.drop("ord"), lat=4, lon=4, mag=2)


@query("S4_K2_phase_picks", q.views("SELECT id, sta, phase, tt, weight FROM v_pick", "v_event", "v_station", "v_pick"))
def s4_picks(t):
    return _phases(t)[1].select("id", "sta", "phase", "tt", "weight")


@query("S5_K1_station_file", q.views("""
    SELECT sta, round(lat, 5) AS lat, round(lon, 5) AS lon, 0 AS model_id, floor(elev_km * 1e3) AS elev_m FROM v_station""", "v_station"))
def s5(t):
    """Elevations are put on whole metres first, which the file holds exactly."""
    path = _path(t, "station-file")
    sink.write_stations(t("v_station").withColumn("elev_km", _floor(F.col("elev_km") * 1000.0) / 1000.0), path)
    return rounded(text.read_station_file(t.spark, path).drop("src"), lat=5, lon=5)


@query("S6_K3_correlation_file", "WITH " + q.adapter.sql_views(*_DET) + "," + q.CC_STEPS + """
    SELECT id1, id2, sta, phase, round(dt, 6) AS dt, round(qual, 3) AS qual, 0e0 AS otc FROM cc WHERE qual >= 6e-1""")
def s6(t):
    path = _path(t, "cc")
    sink.write_correlation_links(c.correlation_links(t, 0.6), path)
    out = text.read_correlation_links(t.spark, path)
    return rounded(out.select("id1", "id2", "sta", "phase", "dt", "qual", "otc"), dt=6, qual=3)


@query("S7_K4_catalog_file", q.pairing("SELECT id1, id2, sta, phase, t1, t2, round(qual, 4) AS qual FROM ct"))
def s7(t):
    path = _path(t, "ct")
    sink.write_catalog_links(c.catalog_links(t), path)
    out = text.read_catalog_links(t.spark, path)
    return rounded(out.select("id1", "id2", "sta", "phase", "t1", "t2", "qual"), qual=4)


@query("S8_K5_event_list", q.views("""
    SELECT id, CAST(year(origin_time) * 10000 + month(origin_time) * 100 + day(origin_time) AS BIGINT) AS date,
           CAST(hour(origin_time) * 1000000 + minute(origin_time) * 10000 + microsecond(origin_time) // 10000 AS BIGINT) AS time,
           round(lat, 4) AS lat, round(lon, 4) AS lon, depth_km, round(mag, 2) AS mag, 0 AS fix FROM v_event""", "v_event"))
def s8(t):
    path = _path(t, "event-list")
    sink.write_events(t("v_event"), path)
    out = text.read_event_list(t.spark, path)
    return rounded(out.select("id", F.col("date").cast("bigint").alias("date"), F.col("time").cast("bigint").alias("time"),
                              "lat", "lon", "depth_km", "mag", "fix"), lat=4, lon=4, mag=2)


@query("K6_used_stations", q.pairing("SELECT sta, round(lat, 5) AS lat, round(lon, 5) AS lon FROM v_station WHERE sta IN (SELECT sta FROM ct)"))
def k6(t):
    path = _path(t, "used-stations")
    sink.write_used_stations(pairing.used_stations(c.catalog_links(t), t("v_station")), path)
    return rounded(text.read_station_file(t.spark, path).select("sta", "lat", "lon"), lat=5, lon=5)


def _reloc(t):
    """The 24 values, on steps that the text format holds exactly."""
    p = timefn.timestamp_parts(F.date_trunc("second", "origin_time").cast("timestamp_ntz"))
    a = t("v_reloc_a")
    ints = {"n_cc_p": 3, "n_cc_s": 5, "n_ct_p": 7, "n_ct_s": 11}
    return a.select(
        "id", "lat", "lon", "depth_km", *[_floor(n).alias(n) for n in ("x_m", "y_m", "z_m")], "ex_m", "ey_m", "ez_m",
        *[v.alias(n) for n, v in p.items()], "mag",
        *[(F.col("id") % k).cast("int").alias(n) for n, k in ints.items()],
        F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 9 / 1e3).alias("rms_cc"),
        (F.col("id") % 8 / 1e3).alias("rms_ct"), "cluster_id")


_PARTS = ", ".join(f"CAST({part}(origin_time) AS INT) AS {n}" for part, n in (("year", "yr"), ("month", "mo"), ("day", "dy"), ("hour", "hr"), ("minute", "mi")))
_NUMBERS = ", ".join(f"CAST(id % {k} AS INT) AS {n}" for n, k in (("n_cc_p", 3), ("n_cc_s", 5), ("n_ct_p", 7), ("n_ct_s", 11)))


@query("S9_K7_relocations", q.views(f"""
    SELECT id, round(lat, 5) AS lat, round(lon, 5) AS lon, round(depth_km, 3) AS depth_km, floor(x_m) AS x_m, floor(y_m) AS y_m, floor(z_m) AS z_m,
           ex_m, ey_m, ez_m, {_PARTS}, CAST(second(origin_time) AS DOUBLE) AS sc, round(mag, 2) AS mag, {_NUMBERS},
           CASE WHEN id % 4 = 0 THEN -9e0 ELSE (id % 9) / 1e3 END AS rms_cc, (id % 8) / 1e3 AS rms_ct, CAST(cluster_id AS INT) AS cluster_id
    FROM v_reloc_a""", "v_reloc_a"))
def s9(t):
    path = _path(t, "reloc")
    sink.write_relocations(_reloc(t), path)
    return rounded(text.read_relocations(t.spark, path), lat=5, lon=5, depth_km=3, mag=2)


@query("S10_id_list", "SELECT DISTINCT o_custkey AS id FROM orders")
def s10(t):
    path = _path(t, "ids")
    t("orders").select(F.col("o_custkey").cast("string").alias("line")).distinct().write.text(path)
    return text.read_ids(t.spark, path)


def _grid(place):
    """The place moved on hundredths of a minute, as far as archives resolve."""
    whole = F.floor(F.abs(place))
    return F.signum(place) * (whole + F.floor((F.abs(place) - whole) * 6000.0) / 6000.0)


def _archive_text(t, layout="long"):
    """Events and picks laid out in the fixed columns of an archive format, on the steps that it resolves.

    The short layout has years of two digits, all written as 84, and names verticals by a V in the site code.
    """
    events = t("v_event").withColumns({
        "lat": _grid(F.col("lat")), "lon": _grid(F.col("lon")), "origin_time": F.date_trunc("second", "origin_time").cast("timestamp_ntz")})
    p = timefn.timestamp_parts("origin_time")
    e = events.withColumns({n: v for n, v in p.items()}).withColumns({
        "hund": F.floor(F.col("sc") * 100 + 1e-6), "la": F.floor("lat"), "lo": F.floor(F.abs("lon"))})
    minutes = lambda v, d: F.round((v - d) * 6000.0).cast("bigint")
    head = F.format_string(
        "%s%02d%02d%02d%02d%04d%2d %4d%3d %4d%5d", F.format_string("%04d", "yr") if layout == "long" else F.lit("84"), "mo", "dy", "hr", "mi", "hund", F.col("la"),
        minutes(F.col("lat"), F.col("la")), F.col("lo"), minutes(F.abs("lon"), F.col("lo")), F.round(F.col("depth_km") * 100).cast("bigint"))
    head = F.concat(F.rpad(head, 136 if layout == "long" else 128, " "), F.format_string("%10d", "id"))
    code = F.when(F.abs("weight") == 1, 0).when(F.abs("weight") == 0.5, 1).when(F.abs("weight") == 0.2, 2).otherwise(3)
    picks = t("v_pick").withColumn("tt", F.floor(F.col("tt") * 100.0) / 100.0)
    joined = picks.join(e.select("id", "mi", "sc"), "id")
    at = F.col("sc") + F.col("tt")
    hundredths = F.format_string("%5d", F.round(at * 100).cast("bigint"))
    blank5 = F.lit("     ")
    is_p = F.col("phase") == "P"
    importance = F.when(F.col("weight") < 0, " 900").otherwise(" 100")
    short = F.concat(
        F.lit("S"), F.substring("sta", 3, 2), F.when(is_p, "V").otherwise("N"), F.when(is_p, "P ").otherwise("  "), F.lit(" "),
        F.when(is_p, code.cast("string")).otherwise("4"), F.lit(" " * 9), F.format_string("%2d", "mi"),
        F.when(is_p, hundredths).otherwise(blank5), F.lit(" " * 7), F.when(is_p, blank5).otherwise(hundredths),
        F.when(is_p, "  ").otherwise("S "), F.lit(" "), F.when(is_p, "4").otherwise(code.cast("string")), F.lit(" " * 42),
        F.when(is_p, importance).otherwise("   0"), F.when(is_p, "   0").otherwise(importance), F.lit("    Q  EXX"))
    pick = short if layout == "short" else F.concat(
        F.rpad("sta", 5, " "), F.lit("XX  HH"), F.when(is_p, "Z").otherwise("N"), F.lit(" "),
        F.when(is_p, "P ").otherwise("  "), F.lit(" "), F.when(is_p, code.cast("string")).otherwise("4"),
        F.lit("          "), F.format_string("%2d", "mi"), F.when(is_p, hundredths).otherwise(blank5), F.lit(" " * 7),
        F.when(is_p, blank5).otherwise(hundredths), F.when(is_p, "  ").otherwise("S "), F.lit(" "),
        F.when(is_p, "4").otherwise(code.cast("string")), F.lit(" " * 50),
        F.when(is_p, importance).otherwise("   0"), F.when(is_p, "   0").otherwise(importance))
    body = joined.select(F.col("id").alias("key"), "seq", pick.alias("line"))
    ends = e.select(F.col("id").alias("key"), F.lit((1 << 62)).alias("seq"), F.format_string("%62s%10d", F.lit(""), "id").alias("line"))
    path = _path(t, "archive")
    sink.write_header_detail(e.select(F.col("id").alias("key"), head.alias("line")), body.unionByName(ends), path)
    return path


def _grid_sql(place):
    whole = f"floor(abs({place}))"
    return f"round(sign({place}) * ({whole} + floor((abs({place}) - {whole}) * 6e3) / 6e3), 6)"


@query("S11_archive_events", q.views(f"""
    SELECT id, {_grid_sql('lat')} AS lat, {_grid_sql('lon')} AS lon, depth_km, CAST(date_trunc('second', origin_time) AS TIMESTAMP) AS origin_time
    FROM v_event""", "v_event"))
def s11(t):
    out = archive.archive_events(archive.read_archive(t.spark, _archive_text(t)))
    return rounded(out.select("id", "lat", "lon", "depth_km", "origin_time"), lat=6, lon=6)


@query("F24_archive_picks", q.views("""
    SELECT id, concat('XX', sta) AS sta, phase, weight, round(floor(tt * 1e2) / 1e2, 2) AS tt FROM v_pick""", "v_event", "v_station", "v_pick"))
def f24(t):
    picks = archive.archive_picks(archive.read_archive(t.spark, _archive_text(t)))
    return rounded(picks.select("id", "sta", "phase", "weight", "tt"), tt=2)


@query("S11_archive_events_short", q.views(f"""
    SELECT id, {_grid_sql('lat')} AS lat, {_grid_sql('lon')} AS lon, depth_km,
           make_timestamp(1984, month(origin_time), day(origin_time), hour(origin_time), minute(origin_time), CAST(second(origin_time) AS DOUBLE)) AS origin_time
    FROM v_event""", "v_event"))
def s11_short(t):
    out = archive.archive_events(archive.read_archive(t.spark, _archive_text(t, "short")))
    return rounded(out.select("id", "lat", "lon", "depth_km", "origin_time"), lat=6, lon=6)


@query("F24_archive_picks_short", q.views("""
    SELECT id, concat('XXS', substr(sta, 3, 2), CASE phase WHEN 'P' THEN 'VQ' ELSE 'NQ' END) AS sta, phase, weight, round(floor(tt * 1e2) / 1e2, 2) AS tt
    FROM v_pick""", "v_event", "v_station", "v_pick"))
def f24_short(t):
    """The layout with years of two digits, verticals known by the site code."""
    picks = archive.archive_picks(archive.read_archive(t.spark, _archive_text(t, "short")), archive.ArchiveRules(site_vertical=True))
    return rounded(picks.select("id", "sta", "phase", "weight", "tt"), tt=2)


@query("S12_station_archive", q.views("SELECT rpad(concat('XX', sta), 7, ' ') AS sta, round(lat, 5) AS lat, round(lon, 5) AS lon FROM v_station", "v_station"))
def s12(t):
    path = _path(t, "station-archive")
    lo = F.floor(F.abs("lon"))
    line = F.concat(
        F.rpad("sta", 5, " "), F.lit(" XX"), F.lit(" " * 7), F.format_string("%2d ", F.floor("lat")),
        F.format_string("%7.4f", (F.col("lat") - F.floor("lat")) * 60.0), F.lit("N"), F.format_string("%3d ", lo),
        F.format_string("%7.4f", (F.abs("lon") - lo) * 60.0), F.lit("W"))
    t("v_station").select(line.alias("line")).write.text(path)
    return rounded(archive.read_station_archive(t.spark, path).drop("src"), lat=5, lon=5)


@query("S13_arrivals", q.views("""
    SELECT p.id, p.sta, p.phase, e.origin_time + to_microseconds(CAST(round(p.tt * 1e6) AS BIGINT)) AS arrival_time
    FROM v_pick p JOIN v_event e ON e.id = p.id""", "v_event", "v_station", "v_pick"))
def s13(t):
    path = _path(t, "arrivals")
    arrival = F.date_format(timefn.shift_origin("origin_time", -F.col("tt")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    rows = t("v_pick").join(t("v_event").select("id", "origin_time"), "id")
    sink.write_csv(rows.select(F.col("id").alias("event"), F.col("sta").alias("station"), "phase", arrival.alias("time")), path)
    return tables.read_arrivals(t.spark, path).drop("src")


@query("S13_station_list", """
    SELECT CAST(s_suppkey AS STRING) AS sta, 'N' || CAST(s_nationkey AS STRING) AS network, s_acctbal AS lat, s_nationkey / 4e0 - 1.2e2 AS lon FROM supplier""")
def s13_stations(t):
    path = _path(t, "station-list")
    t("supplier").select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("Network"), F.col("s_suppkey").alias("Station"),
        F.col("s_acctbal").alias("Latitude"), (F.col("s_nationkey") / 4 - 120).alias("Longitude")).write.csv(path, header=True, sep="|")
    return tables.read_station_list(t.spark, path).drop("src")


@query("S14_K8_id_mapping", q.views("SELECT CAST(id AS STRING) AS original_id, id + 100000 AS synthetic_id FROM v_event", "v_event"))
def s14(t):
    path = _path(t, "mapping")
    sink.write_csv(t("v_event").select(
        F.col("id").cast("string").alias("event_id"), (F.col("id") + 100000).alias("number_id")), path)
    return tables.read_id_mapping(t.spark, path)


@query("S15_velocity_table", q.views("""
    SELECT 1 AS model_id, round(elev_km, 4) AS top, round(lat / 1e1, 4) AS vp, round(round(lat / 1e1, 4) / 2, 5) AS vs, 2e0 AS vp_vs FROM v_station""", "v_station"))
def s15(t):
    """One layer per station stands for a long velocity table; the title line is skipped."""
    path = _path(t, "velocity")
    rows = t("v_station").select(
        F.col("sta").alias("key"),
        F.concat_ws(" ", F.round("elev_km", 4).cast("string"), F.round(F.col("lat") / 10, 4).cast("string"),
                    F.round(F.round(F.col("lat") / 10, 4) / 2, 5).cast("string")).alias("line"))
    title = t("v_station").groupBy().agg(F.lit("").alias("key"), F.lit("depth vp vs").alias("line"))
    sink.write_lines(title.unionByName(rows), ["key"], path)
    return rounded(text.read_velocity_table(t.spark, path), vp_vs=6)


@query("S15_station_models", q.views("""
    SELECT CAST(substr(sta, 2) AS INT) AS model_id, 0e0 AS top, round(lat / 1e1, 4) AS vp, round(round(lat / 1e1, 4) / 2, 5) AS vs FROM v_station
    UNION ALL
    SELECT CAST(substr(sta, 2) AS INT), round(elev_km, 4), round(abs(lon) / 1e2, 4), round(round(abs(lon) / 1e2, 4) / 2, 5) FROM v_station""", "v_station"))
def s15_models(t):
    """A model of two layers for each station."""
    path = _path(t, "station-models")
    vp = F.round(F.col("lat") / 10, 4), F.round(F.abs("lon") / 100, 4)
    layers = [F.concat_ws(" ", *(x.cast("string") for x in (top, v, F.round(v / 2, 5)))) for top, v in zip((F.lit(0.0), F.round("elev_km", 4)), vp, strict=True)]
    head = F.concat(F.substring("sta", 2, 9).cast("int").cast("string"), F.lit(" 2"))
    sink.write_lines(t("v_station").select(F.col("sta").alias("key"), F.concat_ws("\n", head, *layers).alias("line")), ["key"], path)
    return text.read_station_models(t.spark, path)


@query("S16_K7_station_results", q.views("""
    SELECT sta, round(lat, 4) AS lat, round(lon, 4) AS lon, 0e0 AS dist_km, 0e0 AS az_deg, CAST(np % 7 AS INT) AS n_cc_p, CAST(ns % 5 AS INT) AS n_cc_s,
           CAST(np AS INT) AS n_ct_p, CAST(ns AS INT) AS n_ct_s, CASE WHEN np % 7 + ns % 5 = 0 THEN 0e0 ELSE (np % 7) / 1.6e1 END AS rms_cc,
           ns / 1.6e1 AS rms_ct, CAST(np % 3 + 1 AS INT) AS cluster_id
    FROM (SELECT s.sta, s.lat, s.lon, count(*) FILTER (phase = 'P') AS np, count(*) FILTER (phase = 'S') AS ns
          FROM v_station s JOIN v_pick p ON p.sta = s.sta GROUP BY s.sta, s.lat, s.lon)""", "v_event", "v_station", "v_pick"))
def s16(t):
    """Every column of the file; rms values are sixteenths, which four digits hold exactly, and one without links is empty."""
    path = _path(t, "station-results")
    p, s = F.col("n_ct_p"), F.col("n_ct_s")
    counts = t("v_pick").groupBy("sta").agg(
        F.count_if(F.col("phase") == "P").alias("n_ct_p"), F.count_if(F.col("phase") == "S").alias("n_ct_s"))
    rows = t("v_station").join(counts, "sta").withColumns({
        "n_cc_p": p % 7, "n_cc_s": s % 5, "rms_cc": F.when(p % 7 + s % 5 > 0, p % 7 / 16.0), "rms_ct": s / 16.0, "cluster_id": p % 3 + 1})
    sink.write_lines(sink.station_result_lines(rows), ["sta"], path)
    return rounded(text.read_station_results(t.spark, path), lat=4, lon=4)


@query("K7_result_tables", q.views("SELECT id, CAST(cluster_id AS INT) AS cluster_id, CAST(id % 3 AS INT) AS iteration, round(lat, 6) AS lat FROM v_reloc_a", "v_reloc_a"))
def k7(t):
    """Result tables as Parquet, split by cluster and iteration."""
    path = _path(t, "results")
    rows = t("v_reloc_a").select("id", F.col("cluster_id").cast("int").alias("cluster_id"), (F.col("id") % 3).cast("int").alias("iteration"), "lat")
    sink.write_results(rows, path, "cluster_id", "iteration")
    return rounded(t.spark.read.parquet(path), lat=6)


@query("K7_residual_lines", q.chain("""
    SELECT id1, id2, sta, idx, round(dt, 6) AS dt, round(qual, 4) AS qual, floor(res * 1e3) AS res_ms, round(qual, 4) AS wt, floor(offs_m) AS offs_m
    FROM res""", q.RAY_STEPS))
def k7_res(t):
    """Residuals are put on whole milliseconds and separations on whole metres, which the lines hold exactly."""
    path = _path(t, "residuals")
    links = c.residual_links(t).withColumns({
        "wt": F.col("qual"), "res": _floor(F.col("res") * 1000.0) / 1000.0, "offs_m": _floor("offs_m")})
    sink.write_lines(sink.residual_lines(links), ["id1", "id2", "sta", "idx"], path)
    names = {"sta": "string", "dt": "double", "id1": "bigint", "id2": "bigint", "idx": "int", "qual": "double", "res_ms": "double", "wt": "double", "offs_m": "double"}
    back = text.read_lines(t.spark, path).select(*[F.get("tok", F.lit(i)).cast(kind).alias(n) for i, (n, kind) in enumerate(names.items())])
    return rounded(back, dt=6, qual=4, wt=4)


@query("K8_export", q.views(f"""
    SELECT id AS synthetic_id, CAST(id AS STRING) AS event_id, strftime(origin_time, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS origin_time,
           round(lat, 5) AS lat, round(lon, 5) AS lon, round(depth_km, 3) AS depth_km, floor(x_m) AS x_m, floor(y_m) AS y_m, floor(z_m) AS z_m,
           ex_m, ey_m, ez_m, round(mag, 2) AS mag, {_NUMBERS}, CASE WHEN id % 4 <> 0 THEN (id % 9) / 1e3 END AS rms_cc, (id % 8) / 1e3 AS rms_ct,
           CAST(cluster_id AS INT) AS cluster_id
    FROM v_reloc_a""", "v_event", "v_reloc_a"))
def k8(t):
    from quakespark.operators import compare

    path = _path(t, "export")
    sink.write_csv(compare.export_relocations(_reloc(t), c.own_ids(t)), path)
    kinds = {n: "double" for n in ("lat", "lon", "depth_km", "x_m", "y_m", "z_m", "ex_m", "ey_m", "ez_m", "mag", "rms_cc", "rms_ct")}
    kinds |= {"synthetic_id": "bigint", "cluster_id": "int", "n_cc_p": "int", "n_cc_s": "int", "n_ct_p": "int", "n_ct_s": "int"}
    back = t.spark.read.csv(path, header=True).withColumns({n: F.col(n).cast(kind) for n, kind in kinds.items()})
    return rounded(back.select("event_id", "origin_time", *kinds), lat=5, lon=5, depth_km=3, mag=2)
