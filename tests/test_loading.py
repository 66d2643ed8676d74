"""Loading by cluster: stations around many centres, and every cluster as if it were loaded alone."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quakespark.functions import geo
from quakespark.operators import links as lnk
from quakespark.params import LinkParams


@pytest.mark.parametrize("limit", [0.0, 3.0, 90.0, 700.0, 5000.0, 30000.0])
def test_stations_around_match_all_pairs(spark, limit):
    rng = np.random.default_rng(int(limit) + 1)
    near = rng.normal(0, 1, (60, 2)) * [limit / 111 + 0.01, limit / 80 + 0.01]
    spots = np.array([[0, 0], [0, 179.9], [-0.01, -179.95], [60, 179.99], [88.7, 10], [-89.99, 100], [90, 0], [45, 7], [-33, 151]])
    places = np.concatenate([spots[rng.integers(0, len(spots), 60)] + near, rng.uniform([-90, -180], [90, 180], (60, 2)), spots])
    places[:, 0] = places[:, 0].clip(-90, 90)
    places[:, 1] = (places[:, 1] + 180) % 360 - 180
    stations = spark.createDataFrame([(f"S{i}", float(a), float(b), 0.1) for i, (a, b) in enumerate(places)], "sta string, lat double, lon double, elev_km double")
    centres = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(spots)], "cluster_id long, lat0 double, lon0 double")
    got = lnk.stations_around(centres, stations, limit)
    assert got.columns == ["cluster_id", "sta", "lat", "lon", "elev_km"]
    far = geo.distance_km("lat0", "lon0", "lat", "lon", "stations")
    want = centres.crossJoin(stations).filter(far <= limit).select("cluster_id", "sta")
    rows = [(r.cluster_id, r.sta) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {tuple(r) for r in want.collect()}


def region(k, seed):
    """Events, stations and links of a region around 10 k degrees east."""
    rng = np.random.default_rng(seed)
    events = [(100 * k + i, float(40 + rng.normal(0, 0.02)), float(10 * k + rng.normal(0, 0.02)), float(rng.uniform(4, 8))) for i in range(8)]
    stations = [(f"R{k}S{i}", float(40 + rng.normal(0, 0.5)), float(10 * k + rng.normal(0, 0.6)), 0.2) for i in range(12)]
    ct = []
    for a in events:
        for b in events:
            if a[0] < b[0]:
                ct += [(a[0], b[0], s[0], p, float(rng.uniform(1, 9)), float(rng.uniform(1, 9)), 1.0) for s in stations for p in "PS" if rng.random() < 0.7]
    cc = [(b, a, s, p, t1 - t2, q * 0.5) for a, b, s, p, t1, t2, q in ct[::3]]
    return events, stations, ct, cc


def tables(spark, *regions):
    rows = [sum((r[i] for r in regions), []) for i in range(4)]
    kinds = ("id long, lat double, lon double, depth_km double", "sta string, lat double, lon double, elev_km double",
             "id1 long, id2 long, sta string, phase string, t1 double, t2 double, qual double", "id1 long, id2 long, sta string, phase string, dt double, qual double")
    events, stations, ct, cc = (spark.createDataFrame(r, k) for r, k in zip(rows, kinds, strict=True))
    return cc.withColumn("otc", F.lit(0.0)), ct, events, stations


def content(loaded):
    links, events, stations = loaded
    drop = lambda df: df.drop("cluster_id")
    links = drop(links).select("id1", "id2", "sta", "phase", "idx", F.round("dt", 9), F.round("sep_km", 9))
    return tuple(sorted(map(tuple, df.collect())) for df in (links, drop(events).select("id"), drop(stations).select("sta")))


LIMITS = LinkParams(max_station_dist=60.0, max_gap=300.0, min_pair_dist=10.0, max_pair_dist=70.0, max_sep_cc=3.0, max_sep_ct=4.0)


def test_each_cluster_as_if_loaded_alone(spark):
    a, b = region(1, 1), region(5, 2)
    # a link across the regions and events outside every cluster belong to none
    stray = ([(999, 40.0, 30.0, 5.0)], [], [(100, 500, "R1S0", "P", 1.0, 2.0, 1.0), (100, 999, "R1S0", "P", 1.0, 2.0, 1.0)], [])
    both = tables(spark, a, b, stray)
    members = both[2].select("id", F.when(F.col("id") < 999, F.floor(F.col("id") / 100)).alias("cluster_id"))
    found = lnk.load_clusters(*both, members, LIMITS)
    for k, one in ((1, a), (5, b)):
        alone = content(lnk.load_links(*tables(spark, one), LIMITS))
        assert alone[0] and content([df.filter(F.col("cluster_id") == k) for df in found]) == alone
    assert {r.cluster_id for r in found[0].select("cluster_id").distinct().collect()} == {1, 5}
    # the mean of both regions is far from any station
    assert lnk.load_links(*both, LIMITS)[0].isEmpty()


def test_a_station_may_serve_several_clusters(spark):
    loaded = tables(spark, region(1, 3))
    members = loaded[2].select("id", (F.col("id") % 2).alias("cluster_id"))
    links, _, stations = lnk.load_clusters(*loaded, members, LinkParams(max_station_dist=500.0))
    assert stations.groupBy("sta").count().filter("count = 2").count() > 5
    assert links.filter("id1 % 2 <> cluster_id OR id2 % 2 <> cluster_id").isEmpty()


def test_nothing_to_load(spark):
    loaded = tables(spark, region(1, 3))
    members = loaded[2].select("id", F.lit(None).cast("long").alias("cluster_id"))
    assert all(df.isEmpty() for df in lnk.load_clusters(*loaded, members, LIMITS))
