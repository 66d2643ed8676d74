"""What the queries on links share: the links are made once, and statistics do not carry rays."""

import pathlib
import time

from compare import DATA
from pyspark.sql import functions as F

from quakespark import session
from quakespark.operators import links as lnk
from quakespark.operators import weights
from quakespark.registry import common as c
from quakespark.registry.core import Tables


def test_links_are_made_once(spark, monkeypatch):
    made = []
    links = spark.createDataFrame([(1, 2, "S1", "P", 0.1, 1.0, 3)], "id1 long, id2 long, sta string, phase string, dt double, qual double, idx int")
    monkeypatch.setattr(c, "correlation_links", lambda t: None)
    monkeypatch.setattr(c, "catalog_links", lambda t: made.append(t) or links)
    monkeypatch.setattr(lnk, "one_table", lambda cc, ct: ct)
    t = Tables(spark, DATA)
    assert c.all_links(t).collect() == c.all_links(t).collect() == links.collect() and len(made) == 1


def test_statistics_do_not_carry_rays(spark, monkeypatch):
    row = (1, 2, "S1", "P", 3, 1.0, 0.01, 100.0, (1.0,), (2.0,))
    kinds = "id1 long, id2 long, sta string, phase string, idx int, qual double, res double, offs_m double, ray1 struct<tt: double>, ray2 struct<tt: double>"
    monkeypatch.setattr(c, "residual_links", lambda t: spark.createDataFrame([row, row], kinds))
    plain, full = c.weighted_links(None), c.weighted_links(None, rays=True)
    assert set(full.columns) - set(plain.columns) == {"ray1", "ray2"}
    assert [r.wt for r in plain.collect()] == [r.wt for r in full.collect()]


def test_travel_times_alone_leave_derivatives_behind(spark):
    links = spark.createDataFrame([(1, 2, "S1", "P", 0.5, 3), (1, 2, "S1", "S", 0.5, 4)], "id1 long, id2 long, sta string, phase string, dt double, idx int")
    tt = spark.createDataFrame(
        [("S1", i, 1.0 * i, 2.0 * i, *[0.1 * k for k in range(6)]) for i in (1, 2)],
        "sta string, id long, tt_p double, tt_s double, px double, py double, pz double, sx double, sy double, sz double")
    res = weights.residuals(weights.with_travel_times(links, tt))
    plan = res.select("idx", "res")._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join"):]
    assert not [n for n in ("_px", "_py", "_sz") if n in join]
    assert sorted((r.idx, r.res, r.ray1.x) for r in res.collect()) == [(3, 1.5, 0.0), (4, 2.5, 0.3 + 5e-17)]


def test_separation_is_worked_out_for_pairs(spark):
    events = spark.createDataFrame([(1, 40.0, -124.0, 5.0), (2, 40.0, -124.0, 8.0)], "id long, lat double, lon double, depth_km double")
    links = spark.createDataFrame([(1, 2, "S1"), (1, 2, "S2"), (1, 2, "S2"), (1, 3, "S1"), (None, 2, "S1")], "id1 long, id2 long, sta string")
    found = lnk.with_separation(links, events)
    assert sorted((r.sta, r.sep_km) for r in found.collect()) == [("S1", 3.0), ("S2", 3.0), ("S2", 3.0)]
    assert "Aggregate [id1" in found._jdf.queryExecution().optimizedPlan().toString()


def test_written_tables_leave_no_shuffle_files(spark):
    """They would stay until the driver collects garbage, and add up over the steps of a query."""
    folders = [pathlib.Path(f.getPath()) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    files = lambda: {p for f in folders for p in f.rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get(session.DROP_SHUFFLES)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = session.checkpointed(counts)
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(session.DROP_SHUFFLES) == setting
    assert table.count() == 7 and counts.count() == 7     # what was written can be worked out again
