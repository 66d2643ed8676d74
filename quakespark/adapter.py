"""Earthquake-shaped views over the test tables.

Each view is plain SQL that Spark and other ANSI engines read alike; ``{name}`` stands for a table or an
earlier view. The queries of the registry and their SQL counterparts start from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "v_event": """
SELECT user_id AS id, user_id AS ord, min(ts) AS origin_time,
       4.03e1 + (user_id * 7919 % 1000) / 1e4 AS lat,
       -1.245e2 + (user_id * 104729 % 1000) / 1e4 AS lon,
       5e0 + (user_id * 31 % 200) / 1e1 AS depth_km,
       round(avg(value) / 1e2, 2) AS mag
FROM {events} GROUP BY user_id""",
    "v_station": """
SELECT concat('S', lpad(CAST(s_suppkey AS STRING), CAST(greatest(3, length(CAST(s_suppkey AS STRING))) AS INT), '0')) AS sta,
       4e1 + (s_suppkey * 37 % 100) / 1e2 AS lat,
       -1.249e2 + (s_suppkey * 53 % 100) / 1e2 AS lon,
       s_acctbal / 1e4 AS elev_km
FROM {supplier}""",
    "v_pick": """
SELECT p.id, p.sta, p.phase, p.first_id AS seq,
       round(CASE WHEN s.sta IS NULL THEN 0e0
                  ELSE sqrt(((e.lat - s.lat) * 1.111949266e2) * ((e.lat - s.lat) * 1.111949266e2)
                          + ((e.lon - s.lon) * cos(radians(e.lat)) * 1.111949266e2)
                          * ((e.lon - s.lon) * cos(radians(e.lat)) * 1.111949266e2)
                          + (e.depth_km + s.elev_km) * (e.depth_km + s.elev_km)) END
             / 6e0 * (CASE WHEN p.phase = 'P' THEN 1e0 ELSE 1.73e0 END)
             + (p.first_id * 37 % 100) / 1e3, 3) AS tt,
       CASE p.first_id % 5 WHEN 0 THEN 1e0 WHEN 1 THEN 5e-1 WHEN 2 THEN 2e-1 WHEN 3 THEN 1e-1 ELSE -1e0 END AS weight
FROM (SELECT user_id AS id,
             concat('S', lpad(CAST(event_id % 20 AS STRING), 3, '0')) AS sta,
             CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'P' ELSE 'S' END AS phase,
             min(event_id) AS first_id
      FROM {events}
      GROUP BY user_id, concat('S', lpad(CAST(event_id % 20 AS STRING), 3, '0')),
               CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'P' ELSE 'S' END) p
JOIN {v_event} e ON e.id = p.id
LEFT JOIN {v_station} s ON s.sta = p.sta""",
    "v_detection": """
SELECT CAST(p.id AS STRING) AS event_id, CAST(p.id - p.id % 10 AS STRING) AS template_id,
       min(e.origin_time) AS origin_time, p.sta AS sta, min(p.seq) AS row_id,
       max(CASE WHEN p.phase = 'P' THEN p.tt END) AS tt_p,
       max(CASE WHEN p.phase = 'S' THEN p.tt END) AS tt_s,
       max(CASE WHEN p.phase = 'P' AND p.id % 10 <> 0 THEN (p.seq * 13 % 81 - 40) / 1e2 END) AS lag_p,
       max(CASE WHEN p.phase = 'S' AND p.id % 10 <> 0 THEN (p.seq * 13 % 81 - 40) / 1e2 END) AS lag_s,
       max(CASE WHEN p.phase = 'P' AND p.id % 10 <> 0 THEN 5e-1 + (p.seq * 29 % 50) / 1e2 END) AS cc_p,
       max(CASE WHEN p.phase = 'S' AND p.id % 10 <> 0 THEN 5e-1 + (p.seq * 29 % 50) / 1e2 END) AS cc_s
FROM {v_pick} p JOIN {v_event} e ON e.id = p.id
GROUP BY p.id, p.sta""",
    "v_catalog": """
SELECT CAST(id AS STRING) AS event_id, lat, lon, depth_km, mag,
       (id % 7) / 1e1 AS eh, (id % 9) / 1e1 AS ez
FROM {v_event} WHERE depth_km >= 8e0""",
    "v_reloc_a": """
SELECT id, lat + (id * 17 % 41 - 20) / 1e5 AS lat, lon + (id * 23 % 41 - 20) / 1e5 AS lon,
       depth_km + (id * 11 % 21 - 10) / 1e3 AS depth_km,
       (lon + 1.2445e2) * 8.46e4 AS x_m, (lat - 4.035e1) * 1.11e5 AS y_m, (depth_km - 1.5e1) * 1e3 AS z_m,
       (id * 7 % 50) / 1e1 AS ex_m, (id * 3 % 40) / 1e1 AS ey_m, (id * 13 % 90) / 1e1 AS ez_m,
       origin_time, CASE WHEN id % 13 = 0 THEN 0e0 ELSE mag END AS mag, id % 5 + 1 AS cluster_id
FROM {v_event} WHERE depth_km < 2.4e1""",
    "v_reloc_b": """
SELECT id, lat + (id * 29 % 61 - 30) / 1e5 AS lat, lon + (id * 31 % 61 - 30) / 1e5 AS lon,
       depth_km + (id * 19 % 31 - 15) / 1e3 AS depth_km
FROM {v_event} WHERE lat < 4.0395e1""",
}

TABLES = ("events", "supplier", "orders", "lineitem")


def view_names(*wanted: str) -> list[str]:
    """The wanted views and everything they read, in dependency order."""
    needed: set[str] = set()

    def visit(name: str) -> None:
        for other in VIEWS:
            if "{" + other + "}" in VIEWS[name]:
                visit(other)
        needed.add(name)

    for name in wanted:
        visit(name)
    return [name for name in VIEWS if name in needed]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view as a DataFrame."""
    frames: dict[str, DataFrame] = {}
    for step in view_names(name):
        text = VIEWS[step]
        inputs = {}
        for other in (*TABLES, *frames):
            if "{" + other + "}" in text:
                inputs[other] = frames.get(other) if other in frames else table(spark, sf_dir, other)
        frames[step] = spark.sql(text, **inputs)
    return frames[name]


def sql_views(*wanted: str) -> str:
    """The wanted views as a list of common table expressions."""
    parts = []
    for name in view_names(*wanted):
        text = VIEWS[name]
        for other in (*TABLES, *VIEWS):
            text = text.replace("{" + other + "}", other)
        parts.append(f"{name} AS ({text})")
    return ",\n".join(parts)
