"""Pairing against a plain walk over all events, also where many events share one place."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quakespark.operators import pairing
from quakespark.params import PairParams

EVENTS = "id long, ord long, lat double, lon double, depth_km double"
PICKS = "id long, seq long, sta string, phase string, tt double, weight double"
STATIONS = "sta string, lat double, lon double, elev_km double"


def catalog(seed, n, hot):
    """``hot`` of the events at one location, the rest around it."""
    rng = random.Random(seed)
    events, picks = [], []
    for i in range(n):
        if i < hot:
            place = (40.3, -124.5, 10.0)
        else:
            place = (40.3 + rng.uniform(-0.05, 0.05), -124.5 + rng.uniform(-0.05, 0.05), 10.0 + rng.uniform(-3, 3))
        events.append((1000 + (i * 37) % n, i, *place))
    for id_, *_ in events:
        for s in rng.sample(range(8), rng.randint(2, 8)):
            for phase in "PS":
                if rng.random() < 0.8:
                    picks.append((id_, len(picks), f"S{s}", phase, rng.uniform(4, 4.4), rng.choice([1.0, 0.5, -1.0])))
    stations = [(f"S{s}", 40.0 + s / 10, -124.9 + s / 12, 0.1) for s in range(7)]
    return events, picks, stations


def separation(a, b, km=111.1949266):
    return math.sqrt(((a[2] - b[2]) * km) ** 2 + ((a[3] - b[3]) * math.cos(math.radians(a[2])) * km) ** 2 + (a[4] - b[4]) ** 2)


def link_count(a, b, picks, known, sep):
    n = 0
    for (sta, phase), (tt, _) in picks[a[0]].items():
        other = picks[b[0]].get((sta, phase))
        if other and sta in known and abs(tt - other[0]) <= sep / (4.0 if phase == "P" else 2.3) + 0.5:
            n += 1
    return n


def walk(events, picks, stations, p):
    """Reference walk: every event looks outwards until it has seen enough strong neighbours."""
    by_event = {}
    for id_, _, sta, phase, tt, w in picks:
        by_event.setdefault(id_, {}).setdefault((sta, phase), (tt, w))
    known = {s[0] for s in stations}
    events = sorted((e for e in events if len([x for x in picks if x[0] == e[0]]) >= p.min_obs), key=lambda e: e[1])
    for e in events:
        by_event.setdefault(e[0], {})
    found = {}
    for a in events:
        others = []
        for b in events:
            if a is not b:
                first, second = (a, b) if a[1] < b[1] else (b, a)
                others.append((separation(first, second), b[1], b, first, second))
        strong = 0
        for sep, _, b, first, second in sorted(others, key=lambda o: o[:2]):
            if sep > p.max_sep or strong >= p.max_neighbours:
                break
            n = link_count(first, second, by_event, known, sep)
            strong += n >= p.min_links
            if n >= p.min_obs:
                key = (first[0], second[0])
                found[key] = (n, found.get(key, (0, False))[1] or a is first)
    return {(k if fwd else k[::-1]): n for k, (n, fwd) in found.items()}


@pytest.mark.parametrize("seed,n,hot", [(1, 40, 0), (2, 45, 15)])
def test_linked_pairs_match_the_walk(spark, seed, n, hot):
    events, picks, stations = catalog(seed, n, hot)
    p = PairParams(max_sep=6.0, max_neighbours=3, min_links=5, min_obs=2)
    want = walk(events, picks, stations, p)
    random.Random(seed).shuffle(events)
    e = spark.createDataFrame(events, EVENTS)
    k = spark.createDataFrame(picks, PICKS)
    s = spark.createDataFrame(stations, STATIONS)
    chosen, first = pairing.pairing_inputs(e, k, p)
    for found in (
        pairing.linked_pairs(chosen, first, s, p),
        pairing.staged_neighbours(chosen, first, s, p, p.max_sep / 4, hot_cell=5),
    ):
        assert {(r.id1, r.id2): r.n_links for r in found.collect()} == want


def test_salted_cells_give_the_same_pairs(spark):
    events, *_ = catalog(3, 60, 20)
    e = spark.createDataFrame(events, EVENTS)
    want = sorted(
        (min(a, b, key=lambda x: x[1])[0], max(a, b, key=lambda x: x[1])[0])
        for i, a in enumerate(events) for b in events[:i]
        if separation(min(a, b, key=lambda x: x[1]), max(a, b, key=lambda x: x[1])) <= 4.0
    )
    for hot_cell in (None, 3):
        pairs = pairing.candidate_pairs(e, 4.0, hot_cell=hot_cell).collect()
        assert sorted((r.id1, r.id2) for r in pairs) == want


def test_important_links_come_on_top_of_the_limit(spark):
    p = PairParams(max_sep=6.0, min_obs=1, min_links=1, max_obs=2)
    events, picks, stations = catalog(5, 12, 0)
    e, k, s = (spark.createDataFrame(r, c) for r, c in ((events, EVENTS), (picks, PICKS), (stations, STATIONS)))
    chosen, first = pairing.pairing_inputs(e, k, p)
    pairs = pairing.linked_pairs(chosen, first, s, p)
    all_links = pairing.nearest_links(pairs, chosen, first, s, PairParams(max_sep=6.0, max_obs=1000)).collect()
    cut = pairing.nearest_links(pairs, chosen, first, s, p).collect()
    weights = {}
    for id_, _, sta, phase, _, w in picks:
        weights.setdefault((id_, sta, phase), w)
    by_pair = {}
    for r in all_links:
        by_pair.setdefault((r.id1, r.id2), []).append(
            weights[r.id1, r.sta, r.phase] < 0 or weights[r.id2, r.sta, r.phase] < 0)
    for pair, marks in by_pair.items():
        assert sum((r.id1, r.id2) == pair for r in cut) == min(len(marks), 2 + sum(marks))


def test_no_links_gives_no_pairs(spark):
    events, picks, stations = catalog(6, 5, 0)
    e, k = spark.createDataFrame(events, EVENTS), spark.createDataFrame(picks, PICKS)
    nowhere = spark.createDataFrame([("X", 0.0, 0.0, 0.0)], STATIONS)
    assert pairing.differential_times(e, k, nowhere, PairParams(max_sep=5.0, min_obs=1)).count() == 0


def crowded(spark, n_spots=12, at_spot=25, seed=9):
    """Events at few places, each with all picks of eight stations: everything is linked with everything near."""
    rng = random.Random(seed)
    events, picks = [], []
    for i in range(n_spots * at_spot):
        k = i % n_spots
        events.append((i, i, 40.3 + k * 0.004, -124.5, 10.0))
        picks += [(i, 16 * i + j, f"S{j // 2}", "PS"[j % 2], 4.0 + rng.uniform(0, 0.1), rng.choice([1.0, -1.0])) for j in range(16)]
    stations = [(f"S{s}", 40.0 + s / 10, -124.9 + s / 12, 0.1) for s in range(7)]
    frames = [spark.createDataFrame(r, c) for r, c in ((events, EVENTS), (picks, PICKS), (stations, STATIONS))]
    return (events, picks, stations), frames


def test_crowded_places_are_searched_without_forming_all_pairs(spark, monkeypatch):
    rows, (e, k, s) = crowded(spark)
    p = PairParams(max_sep=5.0, max_neighbours=3)
    monkeypatch.setattr(pairing, "DIRECT_PAIRS", 100)
    monkeypatch.setattr(pairing, "candidate_pairs", lambda *_, **__: pytest.fail("all pairs are formed"))
    matched, match = [], pairing.match_picks
    monkeypatch.setattr(pairing, "match_picks", lambda pairs, *a, **b: matched.append(pairs.count()) or match(pairs, *a, **b))
    chosen, first = pairing.pairing_inputs(e, k, p)
    found = pairing.linked_pairs(chosen, first, s, p).collect()
    assert {(r.id1, r.id2): r.n_links for r in found} == walk(*rows, p)
    assert sum(matched) <= 10 * len(rows[0])  # all pairs within 5 km: some 30,000


def test_funnel_looks_only_at_pairs_that_are_reached(spark, monkeypatch):
    _, (e, k, s) = crowded(spark, n_spots=4, at_spot=20)
    p = PairParams(max_sep=5.0, max_neighbours=3)
    want = {r.metric: r.value for r in pairing.selection_funnel(e, k, s, p).collect()}
    monkeypatch.setattr(pairing, "DIRECT_PAIRS", 100)
    monkeypatch.setattr(pairing, "candidate_pairs", lambda *_, **__: pytest.fail("all pairs are formed"))
    got = {r.metric: r.value for r in pairing.selection_funnel(e, k, s, p).collect()}
    assert got == pytest.approx(want) and got["unknown_station"] > 0


def test_links_of_a_pair_are_never_shuffled(spark):
    """Pairs are: after the links are formed, counting and ranking them needs no exchange."""
    _, (e, k, s) = crowded(spark, n_spots=2, at_spot=4)
    p = PairParams(max_sep=5.0)
    chosen, first = pairing.pairing_inputs(e, k, p)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = pairing.match_picks(pairing.candidate_pairs(chosen, p.max_sep), first, s, p.max_dist)
        plan = pairing.pair_counts(links)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange" not in plan[: plan.index("Generate inline")]


def test_stations_listed_twice_count_twice(spark):
    _, (e, k, s) = crowded(spark, n_spots=1, at_spot=2)
    p = PairParams(max_sep=5.0)
    chosen, first = pairing.pairing_inputs(e, k, p)
    pairs = pairing.candidate_pairs(chosen, p.max_sep)
    once, twice = (pairing.match_picks(pairs, first, x, p.max_dist) for x in (s, s.union(s)))
    count = lambda df: sorted((r["status"], r["count"]) for r in df.groupBy("status").count().collect())
    assert count(once) == [("ok", 14), ("unknown", 2)] and count(twice) == [("ok", 28), ("unknown", 2)]


def test_links_formed_in_cells_are_those_of_all_pairs(spark):
    """Also with split cells, and where the later event is the probe; pairs and links pass no shuffle."""
    _, (e, k, s) = crowded(spark, n_spots=6, at_spot=5)
    k = k.withColumn("tt", F.col("tt") + F.col("seq") % 7 / 5.0)     # some links are outliers, and t1 differs from t2
    p = PairParams(max_sep=5.0)
    chosen, first = pairing.pairing_inputs(e, k, p)
    want = pairing.match_picks(pairing.candidate_pairs(chosen, p.max_sep), first, s, p.max_dist)
    for hot_cell in (None, 2):
        got = pairing.candidate_links(chosen, first, s, p.max_sep, p.max_dist, hot_cell=hot_cell)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert {r["status"] for r in got.select("status").distinct().collect()} >= {"ok", "outlier", "unknown"}
        counts = pairing.counts_in_place(got)
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, pairing.pair_counts(want).collect()))
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[: plan.index("Join")] and plan.index("Generate inline") < plan.index("Join")


def test_runs_are_counted_across_batches():
    """A pair whose links end in a later batch has one row."""
    pairs = [1, 1, 1, 2, 2, 2, 2, 2, 3]
    rows = [(p, 10 + p, p, 10 + p, 0.5, 1, i % 2, 1 - i % 2) for i, p in enumerate(pairs)]
    names = ["id1", "id2", "ord1", "ord2", "sep", "n_links", "n_p", "n_s"]
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    for size in (1, 2, 4, 100):
        counted = pa.Table.from_batches(pairing._count_runs(iter(table.to_batches(max_chunksize=size)))).to_pylist()
        assert [(r["id1"], r["n_links"], r["n_p"], r["n_s"]) for r in counted] == [(1, 3, 1, 2), (2, 5, 3, 2), (3, 1, 0, 1)]


def _join_and_exchange(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.index("Join"), plan.index("Exchange")


def test_station_distances_shuffle_no_pair(spark):
    from compare import DATA
    from quakespark.registry import QUERIES

    join, exchange = _join_and_exchange(QUERIES["F7_station_distance"](spark, DATA))
    assert join < exchange      # nothing above the join that forms the pairs


@pytest.mark.parametrize("max_dist", [200.0, 40.0])
def test_neighbour_order_is_that_of_all_pairs(spark, monkeypatch, max_dist):
    """Also with events of one place, unknown stations, outliers, stations too far away or listed twice, and missing times; no pair is shuffled."""
    from pyspark.sql import Window

    monkeypatch.setattr(pairing, "ROWS_AT_ONCE", 10)
    events, picks, stations = catalog(8, 70, 15)
    e, s = spark.createDataFrame(events, EVENTS), spark.createDataFrame(stations + stations[:2], STATIONS)
    k = spark.createDataFrame(picks, PICKS).withColumn("tt", F.when(F.col("seq") % 11 > 0, F.col("tt") + F.col("seq") % 7 / 5.0))
    chosen, first = pairing.pairing_inputs(e, k, PairParams(max_sep=5.0))
    counts = pairing.pair_counts(pairing.match_picks(pairing.candidate_pairs(chosen, 5.0), first, s, max_dist))
    place = F.row_number().over(Window.partitionBy("ev").orderBy("sep", "nb_ord"))
    want = pairing.directed(counts).select("ev", "nb", place.alias("place"))
    got = pairing.neighbour_order(chosen, first, s, 5.0, max_dist)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and "Window" not in plan


def test_candidate_pairs_read_the_chosen_events_from_a_table(spark):
    from compare import DATA
    from quakespark.registry import QUERIES

    plan = QUERIES["J3_candidate_pairs"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "SortMergeJoin" not in plan[: plan.index("ShuffledHashJoin")]


def test_a_sweep_forms_no_pairs_of_dense_regions_and_leaves_no_table(spark, monkeypatch):
    """Every run searches as if alone; runs that differ in the links of a pair only share their pairs."""
    import pathlib

    from quakespark import session
    from quakespark.plans import workflows

    rows, (e, k, s) = crowded(spark, n_spots=4, at_spot=20)
    monkeypatch.setattr(pairing, "DIRECT_PAIRS", 100)
    direct = pairing.candidate_pairs
    monkeypatch.setattr(pairing, "candidate_pairs", lambda events, *a: direct(events, *a) if events.isEmpty() else pytest.fail("all pairs are formed"))
    p = PairParams(max_sep=5.0, max_neighbours=3)
    cut = PairParams(max_sep=5.0, max_neighbours=3, max_obs=2)
    folder = pathlib.Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {f.name for f in folder.iterdir()}
    found = {r.run_id: r for r in workflows.sweep_pairing(e, k, s, {"a": p, "cut": cut, "none": PairParams(min_obs=2000)}).collect()}
    assert {f.name for f in folder.iterdir()} == before
    pairs = walk(*rows, p)
    assert (found["a"].n_pairs, found["a"].n_links) == (len(pairs), sum(pairs.values()))
    assert found["cut"].n_pairs == len(pairs) and 2 * len(pairs) <= found["cut"].n_links < found["a"].n_links
    assert tuple(found["none"]) == ("none", 0, 0, None)
