"""Event pairing: neighbour search, common picks, neighbour selection and differential times.

Tables
    events    id, ord, lat, lon, depth_km       (``ord`` is the catalog order)
    picks     id, seq, sta, phase, tt, weight    (``seq`` is the order inside an event)
    stations  sta, lat, lon, elev_km
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.functions import geo
from quakespark.params import PairParams
from quakespark.session import checkpointed

# Outlier line of a differential time, slack in s and slowest speeds in km/s.
OUTLIER_SLACK_S = 0.5
OUTLIER_SPEED = {"P": 4.0, "S": 2.3}

HOT_CELL = 4096          # events in one grid cell above which the cell is split
HOT_PLACES = 1 << 16     # the same where events bring their place only
PIECES = 4               # tasks of one cell where links are formed in place
SHARES = 2               # tasks of one cell where its events meet all events around
ROWS_AT_ONCE = 1 << 17   # rows given back together
DIRECT_PAIRS = 1 << 20   # candidate pairs, seen from both sides, up to which W1 forms all of them
HALVINGS = 12            # finest first radius of the staged search: the limit halved so often
MAX_LAT = 89.9


# ---------------------------------------------------------------------------------------------
# filters in front of pairing


def usable_picks(picks: DataFrame, min_weight: float) -> DataFrame:
    """drop picks with 0 <= weight < min_weight; negative weights mark important picks and stay."""
    return picks.filter((F.col("weight") < 0) | (F.col("weight") >= min_weight))


def select_events(events: DataFrame, picks: DataFrame, min_obs: int, ids: DataFrame | None = None) -> DataFrame:
    """events with at least ``min_obs`` picks, and on the id list if one is given."""
    counts = picks.groupBy("id").agg(F.count(F.lit(1)).alias("n_picks"))
    kept = events.join(counts.filter(F.col("n_picks") >= min_obs), "id")
    if ids is not None:
        kept = kept.join(ids.select("id"), "id", "left_semi")
    return kept


def first_picks(picks: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The first pick of every (event, station, phase), within each run that ``keys`` tell apart."""
    return picks.groupBy(*keys, "id", "sta", "phase").agg(
        F.min_by(F.struct("tt", "weight"), "seq").alias("p")
    ).select(*keys, "id", "sta", "phase", "p.tt", "p.weight")


# ---------------------------------------------------------------------------------------------
# Blocked distance join


def _with_cells(events: DataFrame, radius: float, km_per_deg: float) -> DataFrame:
    """Grid cell of every event. The longitude width of a cell depends on its latitude band."""
    band = F.floor(F.col("lat") * (km_per_deg / radius))
    return (
        events.withColumn("_b", band)
        .withColumn("_x", F.floor(F.col("lon") / _lon_width(F.col("_b"), radius, km_per_deg)))
        .withColumn("_z", F.floor(F.col("depth_km") / radius))
    )


def _lon_width(band, radius: float, km_per_deg: float):
    middle = (band + 0.5) * (radius / km_per_deg)
    return radius / (km_per_deg * F.greatest(F.cos(F.radians(middle)), F.lit(0.01)))


def _probes(events: DataFrame, radius: float, km_per_deg: float, both_sides: bool) -> DataFrame:
    """Every grid cell that can hold a neighbour; with ``both_sides`` off one of any two cells probes the other."""
    cells = _with_cells(events, radius, km_per_deg)
    reach = radius / (
        km_per_deg
        * F.cos(F.radians(F.least(F.abs(F.col("lat")) + radius / km_per_deg, F.lit(MAX_LAT))))
    )
    low = F.col("_b") - (1 if both_sides else 0)
    probes = (
        cells.withColumn("_reach", reach)
        .withColumn("_own", F.struct(*CELL))
        .withColumn("_b", F.explode(F.sequence(low, F.col("_b") + 1)))
        .withColumn("_w", _lon_width(F.col("_b"), radius, km_per_deg))
        .withColumn(
            "_x",
            F.explode(
                F.sequence(
                    F.floor((F.col("lon") - F.col("_reach")) / F.col("_w")),
                    F.floor((F.col("lon") + F.col("_reach")) / F.col("_w")),
                )
            ),
        )
        .withColumn("_z", F.explode(F.sequence(F.col("_z") - 1, F.col("_z") + 1)))
        .drop("_reach", "_w")
    )
    cell = F.struct(*CELL)
    onwards = probes if both_sides else probes.filter(cell >= F.col("_own"))
    return onwards.withColumn("_own", cell == F.col("_own"))


CELL = ["_b", "_x", "_z"]


def _blocked(probe: DataFrame, resident: DataFrame, hot_cell: int | None, pieces: int = 0) -> DataFrame:
    """Equi-join on the cell; cells with more than ``hot_cell`` residents are split by a salt.

    Probes are spread over all shuffle partitions first: few rows go in, many pairs come out, and every
    later step of a pair runs where the pair was formed. Where rows are wide and pairs stay where they are, ``pieces``
    deals the probes of a cell to so many tasks, with its residents in a hash table in each.
    """
    spark = probe.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [*CELL]
    if hot_cell is not None:
        probe, resident = _salted(probe, resident, hot_cell)
        keys.append("_salt")
    if pieces:
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(pieces - 1).cast("bigint"))
        probe = probe.withColumn("_piece", F.pmod(F.xxhash64("p_ord"), F.lit(pieces)))
        resident = resident.withColumn("_piece", F.explode(every)).hint("shuffle_hash")
        keys.append("_piece")
        n *= pieces
    return probe.repartition(n, *keys).join(resident, keys)


def _salted(probe: DataFrame, resident: DataFrame, hot_cell: int) -> tuple[DataFrame, DataFrame]:
    """Residents dealt to salts of their cell, ``hot_cell`` to each, and probes copied to every salt."""
    fans = (
        resident.groupBy(*CELL)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_cell)
        .select(*CELL, F.ceil(F.col("_n") / hot_cell).alias("_fan"))
    )
    fan = F.coalesce(F.col("_fan"), F.lit(1))
    salted = resident.join(fans, CELL, "left").withColumn(
        "_salt", F.pmod(F.xxhash64("r_ord"), fan)
    ).drop("_fan")
    spread = probe.join(fans, CELL, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), fan - 1))
    ).drop("_fan")
    return spread, salted


def _prefixed(df: DataFrame, prefix: str, extra: tuple[str, ...] = ()) -> DataFrame:
    names = ["id", "ord", "lat", "lon", "depth_km", *extra]
    return df.select(*[F.col(n).alias(prefix + n) for n in names], *CELL, *(["_own"] if "_own" in df.columns else []))


def _oriented_separation(km_per_deg: float):
    """Separation on the plane at the earlier event of (p, r)."""
    first = F.col("p_ord") < F.col("r_ord")
    lat = F.when(first, F.col("p_lat")).otherwise(F.col("r_lat"))
    north = (F.col("p_lat") - F.col("r_lat")) * km_per_deg
    east = (F.col("p_lon") - F.col("r_lon")) * F.cos(F.radians(lat)) * km_per_deg
    down = F.col("p_depth_km") - F.col("r_depth_km")
    return F.sqrt(north * north + east * east + down * down)


def candidate_pairs(
    events: DataFrame, max_sep: float, km_per_deg: float = geo.KM_PER_DEG_PAIRING, hot_cell: int | None = HOT_PLACES
) -> DataFrame:
    """Every unordered pair of events within ``max_sep`` km, earlier event first.

    Cells are dealt to ``PIECES`` tasks with a hash table of their events: nothing is sorted, and events are not copied to
    the salts of a cell before that table is large.
    """
    probe = _prefixed(_probes(events, max_sep, km_per_deg, both_sides=False), "p_")
    resident = _prefixed(_with_cells(events, max_sep, km_per_deg), "r_")
    return _near_pairs(_blocked(probe, resident, hot_cell, PIECES), max_sep, km_per_deg)


def _near_pairs(joined: DataFrame, max_sep: float, km_per_deg: float, extra: tuple[str, ...] = ()) -> DataFrame:
    """Pairs within ``max_sep`` of events that met in a cell, earlier event first; ``extra`` columns stay."""
    met = joined.filter(~F.col("_own") | (F.col("p_ord") < F.col("r_ord")))
    near = met.withColumn("sep", _oriented_separation(km_per_deg)).filter(F.col("sep") <= max_sep)
    first = F.col("p_ord") < F.col("r_ord")

    def pick(name: str, earlier: bool):
        a, b = ("p_", "r_") if earlier else ("r_", "p_")
        return F.when(first, F.col(a + name)).otherwise(F.col(b + name))

    return near.select(
        pick("id", True).alias("id1"),
        pick("id", False).alias("id2"),
        pick("ord", True).alias("ord1"),
        pick("ord", False).alias("ord2"),
        "sep",
        ((F.col("p_lat") + F.col("r_lat")) / 2).alias("mid_lat"),
        ((F.col("p_lon") + F.col("r_lon")) / 2).alias("mid_lon"),
        *extra,
    )


# ---------------------------------------------------------------------------------------------
# Common picks of a pair


def _named(first: DataFrame) -> DataFrame:
    return first.filter(F.col("sta").isNotNull() & F.col("phase").isNotNull())


def _pick_lists(first: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The picks of every event as one list."""
    return _named(first).groupBy(*keys, "id").agg(F.collect_list(F.struct("sta", "phase", "tt", "weight")).alias("_list"))


def _pick_maps(first: DataFrame, stations: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The picks of every event as one map from (sta, phase), with the places of their station."""
    places = stations.select("sta", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    return (
        _named(first).join(places, "sta", "left")
        .groupBy(*keys, "id", "sta", "phase")
        .agg(F.collect_list(F.struct("tt", "weight", "s_lat", "s_lon")).alias("_hits"))
        .groupBy(*keys, "id")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.struct("sta", "phase"), "_hits"))).alias("_map"))
    )


def _common(pairs: DataFrame, columns: list[str], a: str, b: str) -> DataFrame:
    """A row for each pick of list ``a`` that map ``b`` has too: t1, w1 of the one and t2, w2 of the other."""
    return pairs.select(*columns, b, F.inline(a).alias("sta", "phase", "t1", "w1")).select(
        *columns, "sta", "phase", "t1", "w1",
        F.inline(F.try_element_at(b, F.struct("sta", "phase"))).alias("t2", "w2", "s_lat", "s_lon"))


def match_picks(
    pairs: DataFrame, first: DataFrame, stations: DataFrame, max_dist, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Common (station, phase) of both events of a pair, with the outcome of J5, F7 and F8.

    ``first`` are the first picks of every (event, station, phase), see ``first_picks``. ``max_dist`` is a number or
    a column of ``pairs``; ``keys`` tell runs apart in both tables.

    ``status`` is 'ok', 'unknown' (station not in the list), 'far' or 'outlier'.
    """
    # an event's picks travel as one row, so that pairs are shuffled and their links never are
    a = _pick_lists(first, keys).withColumnRenamed("id", "id1")
    b = _pick_maps(first, stations, keys).withColumnRenamed("id", "id2")
    met = pairs.join(a.hint("shuffle_hash"), [*keys, "id1"]).join(b.hint("shuffle_hash"), [*keys, "id2"])
    return _judged(_common(met, pairs.columns, "_list", "_map"), max_dist)


def candidate_links(
    events: DataFrame, first: DataFrame, stations: DataFrame, max_sep: float, max_dist: float,
    km_per_deg: float = geo.KM_PER_DEG_PAIRING, hot_cell: int | None = HOT_CELL,
) -> DataFrame:
    """J3 and J4 in one: ``match_picks`` of all ``candidate_pairs``, where neither pairs nor links are shuffled or sorted.

    Events take their picks along into the grid cells, so what is shuffled grows with the events. Pairs and links are formed
    one after another behind that shuffle; the links of a pair lie together, as ``counts_in_place`` needs them.
    """
    cells = _with_cells(events, max_sep, km_per_deg)
    probes = _probes(events, max_sep, km_per_deg, both_sides=False)
    probes = probes.join(cells.select(*CELL).distinct(), CELL, "left_semi")     # before the picks join, which are copied
    probe = _prefixed(probes.join(_pick_lists(first), "id"), "p_", ("_list",))
    resident = _prefixed(cells.join(_pick_maps(first, stations), "id"), "r_", ("_map",))
    joined = _blocked(probe, resident, hot_cell, PIECES)
    carried = ("p__list", "r__map", (F.col("p_ord") < F.col("r_ord")).alias("_onwards"))
    pairs = _near_pairs(joined, max_sep, km_per_deg, carried)
    names = [c for c in pairs.columns if c not in ("p__list", "r__map")]
    rows = _common(pairs, names, "p__list", "r__map")
    t1, t2 = F.col("t1"), F.col("t2")
    turned = {"t1": F.when(F.col("_onwards"), t1).otherwise(t2), "t2": F.when(F.col("_onwards"), t2).otherwise(t1)}
    return _judged(rows.withColumns(turned).drop("_onwards"), max_dist)


def _judged(rows: DataFrame, max_dist) -> DataFrame:
    """Distance, status, importance and quality of links."""
    dist = geo.distance_km("s_lat", "s_lon", "mid_lat", "mid_lon", "pairing")
    speed = F.when(F.col("phase") == "P", OUTLIER_SPEED["P"]).otherwise(OUTLIER_SPEED["S"])
    limit = F.col("sep") / speed + OUTLIER_SLACK_S
    return (
        rows.withColumn("dist", dist)
        .withColumn(
            "status",
            F.when(F.col("s_lat").isNull(), "unknown")
            .when(F.col("dist") > max_dist, "far")
            .when(F.abs(F.col("t1") - F.col("t2")) > limit, "outlier")
            .otherwise("ok"),
        )
        .withColumn("important", (F.col("w1") < 0) | (F.col("w2") < 0))
        .withColumn("qual", (F.abs("w1") + F.abs("w2")) / 2)
        .drop("s_lat", "s_lon", "w1", "w2", "mid_lat", "mid_lon")
    )


def unknown_stations(picks: DataFrame, stations: DataFrame) -> DataFrame:
    """Picks per station that is not in the station list."""
    return (
        picks.join(stations.select("sta"), "sta", "left_anti")
        .groupBy("sta")
        .agg(F.count(F.lit(1)).alias("n_picks"), F.countDistinct("id").alias("n_events"))
    )


def pair_counts(matched: DataFrame) -> DataFrame:
    """A2: observations per pair, in total and by phase."""
    return (
        matched.filter(F.col("status") == "ok")
        .groupBy("id1", "id2", "ord1", "ord2", "sep")
        .agg(
            F.count(F.lit(1)).alias("n_links"),
            F.count_if(F.col("phase") == "P").alias("n_p"),
            F.count_if(F.col("phase") == "S").alias("n_s"),
        )
    )


def counts_in_place(links: DataFrame) -> DataFrame:
    """A2 of ``candidate_links``: the links of a pair lie together, so they are counted as they come, without a shuffle."""
    pair = ["id1", "id2", "ord1", "ord2", "sep"]
    ok = links.filter(F.col("status") == "ok").select(
        *pair, F.lit(1).cast("bigint").alias("n_links"),
        *[F.coalesce((F.col("phase") == p).cast("bigint"), F.lit(0).cast("bigint")).alias(n) for p, n in (("P", "n_p"), ("S", "n_s"))])
    return ok.mapInArrow(_count_runs, ok.schema)


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of equal pairs, its counts summed up; a run may go on in the next batch."""
    held = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = batch if held is None else pa.concat_batches([held, batch])
        changed = np.zeros(batch.num_rows, bool)
        changed[0] = True
        for name in ("ord1", "ord2", "id1", "id2"):
            c = batch.column(name)
            changed[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(changed)
        runs = batch.take(pa.array(starts))
        for name in ("n_links", "n_p", "n_s"):
            sums = np.add.reduceat(batch.column(name).to_numpy(), starts)
            runs = runs.set_column(runs.schema.get_field_index(name), runs.schema.field(name), pa.array(sums))
        if len(runs) > 1:
            yield runs.slice(0, len(runs) - 1)
        held = runs.slice(len(runs) - 1)
    if held is not None:
        yield held


# ---------------------------------------------------------------------------------------------
# A2, L1: counts where all neighbours of an event are at hand


def _around(events: DataFrame, first: DataFrame, stations: DataFrame, max_sep: float, km_per_deg: float) -> DataFrame:
    """The events of every cell (``own``) behind copies of all events that can be near them, sorted by cell.

    Copies take along their picks at known stations, which alone can be links. The rows of a cell are dealt to
    ``SHARES`` tasks by their own events; what is shuffled grows with the events.
    """
    radius, placed = max_sep, events.withColumn("_cos", F.cos(F.radians("lat")))
    cells, hits = _with_cells(placed, radius, km_per_deg), _named(first).join(
        stations.select("sta", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon")), "sta").filter(F.col("s_lat").isNotNull())
    none = F.lit(None).cast("double")

    def lists(rows: DataFrame, lat, lon) -> DataFrame:
        entry = F.struct("sta", "phase", "tt", lat.alias("s_lat"), lon.alias("s_lon"))
        return rows.groupBy("id").agg(F.collect_list(entry).alias("picks"))

    names = [F.col(c) for c in (*CELL, "_share", "own", "id", "ord", "lat", "lon", "depth_km", "_cos", "picks")]
    share = F.pmod(F.xxhash64("ord"), F.lit(SHARES))
    own = cells.join(lists(_named(first), none, none), "id").withColumn("own", F.lit(True)).withColumn("_share", share)
    copies = _probes(placed, radius, km_per_deg, both_sides=True).drop("_own").join(cells.select(*CELL).distinct(), CELL, "left_semi")
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(SHARES - 1).cast("bigint"))
    copies = copies.join(lists(hits, F.col("s_lat"), F.col("s_lon")), "id").withColumn("own", F.lit(False)).withColumn("_share", F.explode(every))
    spark = events.sparkSession
    n = PIECES * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [*CELL, "_share"]
    return copies.select(*names).unionByName(own.select(*names)).repartition(n, *keys).sortWithinPartitions(*keys, "own")


def _distances(lat1, lon1, lat2, lon2) -> np.ndarray:
    """``geo.distance_km`` of the variant 'pairing' on arrays."""
    rule = geo.RADIUS_RULES["pairing"]
    a, b = (geo.HALF_PI - np.arctan(geo.GEOCENTRIC_FACTOR * np.tan(x * geo.RAD_PER_DEG)) for x in (lat1, lat2))
    cosine = np.sin(a) * np.sin(b) * np.cos((lon2 - lon1) * geo.RAD_PER_DEG) + np.cos(a) * np.cos(b)
    middle = np.cos(geo.HALF_PI - (lat1 + lat2) * (geo.RAD_PER_DEG / 2))
    return np.arccos(np.clip(cosine, -1.0, 1.0)) * (rule.equatorial * (1.0 + rule.flattening * (rule.offset - middle * middle)))


class _Picks:
    """Numbers for (station, phase), the same in all batches of a task."""

    def __init__(self):
        self.stations, self.phases, self.kinds, self.speeds = {}, {}, {}, []

    def numbered(self, column: pa.Array, known: dict) -> np.ndarray:
        encoded = column.dictionary_encode()
        return np.array([known.setdefault(v, len(known)) for v in encoded.dictionary.to_pylist()], np.int64)[encoded.indices.to_numpy()]

    def codes(self, sta: pa.Array, phase: pa.Array) -> np.ndarray:
        if not len(sta):
            return np.zeros(0, np.int64)
        kinds, place = np.unique(self.numbered(sta, self.stations) << 20 | self.numbered(phase, self.phases), return_inverse=True)
        phases = list(self.phases)
        for kind in kinds.tolist():
            if kind not in self.kinds:
                self.kinds[kind] = len(self.kinds)
                self.speeds.append({"P": 0, "S": 1}.get(phases[kind & (1 << 20) - 1], 2))
        return np.array([self.kinds[k] for k in kinds.tolist()], np.int64)[place]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


def _neighbourhoods(batches: Iterator[pa.RecordBatch], max_sep: float, max_dist: float, km_per_deg: float, later: bool) -> Iterator[tuple]:
    """For each event of the rows of ``_around``, its neighbours with a link: (id, ord, ids, ords, sep, n_links, n_p, n_s).

    With ``later`` only neighbours that come later in the catalog are looked at. Separations and outlier lines are worked
    out by the same steps as in ``match_picks``. Station distances are where some pick of the cell can be too far.
    """
    picks, key, parts, met, table = _Picks(), None, [], None, np.zeros(0, np.int64)
    speeds = np.array([OUTLIER_SPEED["P"], OUTLIER_SPEED["S"], OUTLIER_SPEED["S"]])
    for batch in batches:
        if not batch.num_rows:
            continue
        value = lambda name: batch.column(batch.schema.get_field_index(name))
        floats = {c: value(c).to_numpy(zero_copy_only=False).astype(float) for c in ("lat", "lon", "depth_km", "_cos")}
        ids, ords = (value(c).to_numpy(zero_copy_only=False) for c in ("id", "ord"))
        own = value("own").to_numpy(zero_copy_only=False)
        where = np.stack([value(c).to_numpy(zero_copy_only=False) for c in (*CELL, "_share")] + [own.astype(np.int64)], 1)
        lists = value("picks")
        offsets, entries = lists.offsets.to_numpy(), lists.values
        code = picks.codes(entries.field("sta"), entries.field("phase"))
        tt, s_lat, s_lon = (entries.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("tt", "s_lat", "s_lon"))
        kinds = np.array(picks.speeds, np.int64)
        table = np.full(len(kinds), -1, np.int64)
        starts = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]).any(1)]))
        for low, high in zip(starts, np.append(starts[1:], len(ids)), strict=True):
            cell = tuple(where[low, :-1])
            if cell != key:
                key, parts, met = cell, [], None
            if not own[low]:
                span = slice(offsets[low], offsets[high])
                parts.append((ids[low:high], ords[low:high], *(floats[c][low:high] for c in floats), np.diff(offsets[low:high + 1]),
                              code[span], tt[span], s_lat[span], s_lon[span]))
                continue
            if not parts:
                continue
            if met is None:
                met = [np.concatenate(x) for x in zip(*parts, strict=True)]
                ends = np.cumsum(met[6])
                begins = ends - met[6]
                # half way to a neighbour, a station is at most so much farther from the pair than from the event
                far = _distances(np.repeat(met[2], met[6]), np.repeat(met[3], met[6]), met[9], met[10]) + 2 * max_sep > 0.99 * max_dist
                far = bool(far.any()) or bool((np.abs(met[2]) > 80).any()) or not (np.isfinite(met[9]) & np.isfinite(met[10])).all()
            r_id, r_ord, r_lat, r_lon, r_dep, r_cos, r_size, r_code, r_tt, r_slat, r_slon = met
            for i in range(low, high):
                mine = slice(offsets[i], offsets[i + 1])
                north = (floats["lat"][i] - r_lat) * km_per_deg
                east = (floats["lon"][i] - r_lon) * np.where(ords[i] < r_ord, floats["_cos"][i], r_cos) * km_per_deg
                down = floats["depth_km"][i] - r_dep
                sep = np.sqrt(north * north + east * east + down * down)
                near = np.flatnonzero((sep <= max_sep) & (r_ord > ords[i] if later else r_ord != ords[i]))
                if not len(near):
                    continue
                table[code[mine]] = np.arange(mine.start, mine.stop)
                at, pair = _spans(begins[near], r_size[near]), np.repeat(np.arange(len(near)), r_size[near])
                to = table[r_code[at]]
                common = to >= 0
                at, pair, to = at[common], pair[common], to[common]
                table[code[mine]] = -1
                kind = kinds[r_code[at]]
                ok = ~(np.abs(tt[to] - r_tt[at]) > sep[near][pair] / speeds[kind] + OUTLIER_SLACK_S)
                if far:
                    other = near[pair]
                    ok &= ~(_distances(r_slat[at], r_slon[at], (floats["lat"][i] + r_lat[other]) / 2, (floats["lon"][i] + r_lon[other]) / 2) > max_dist)
                n, n_p, n_s = (np.bincount(pair[x], minlength=len(near)) for x in (ok, ok & (kind == 0), ok & (kind == 1)))
                linked = n > 0
                if linked.any():
                    near = near[linked]
                    yield ids[i], ords[i], r_id[near], r_ord[near], sep[near], n[linked], n_p[linked], n_s[linked]


def _batched(rows: Iterator[list[np.ndarray]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns of many events put together to batches."""
    held, size = [], 0
    for columns in rows:
        held.append(columns)
        size += len(columns[0])
        if size >= ROWS_AT_ONCE:
            yield pa.record_batch([np.concatenate(x) for x in zip(*held, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([np.concatenate(x) for x in zip(*held, strict=True)], schema=schema)


def neighbour_order(
    events: DataFrame, first: DataFrame, stations: DataFrame, max_sep: float, max_dist: float, km_per_deg: float = geo.KM_PER_DEG_PAIRING
) -> DataFrame:
    """L1: (ev, nb, place): the neighbours an event shares a link with, by separation and catalog order.

    An event's neighbours meet it in its own cell, so no pair is shuffled or sorted with others'. A task holds the
    events around one cell.
    """
    schema = pa.schema([("ev", pa.int64()), ("nb", pa.int64()), ("place", pa.int64())])

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for ev, _, nb, nb_ord, sep, *_ in _neighbourhoods(batches, max_sep, max_dist, km_per_deg, later=False):
                by = np.lexsort((nb_ord, sep))
                yield [np.full(len(nb), ev), nb[by], np.arange(1, len(nb) + 1)]

        return _batched(rows(), schema)

    return _around(events, first, stations, max_sep, km_per_deg).mapInArrow(order, "ev bigint, nb bigint, place bigint")


# ---------------------------------------------------------------------------------------------
# Neighbour selection


def directed(counts: DataFrame) -> DataFrame:
    """Both views of a pair: (ev, nb) with the order number of the neighbour."""
    def side(ev: int, nb: int):
        return F.struct(
            F.col(f"id{ev}").alias("ev"), F.col(f"id{nb}").alias("nb"), F.col(f"ord{nb}").alias("nb_ord")
        )

    return counts.withColumn("side", F.explode(F.array(side(1, 2), side(2, 1)))).select("*", "side.*").drop("side")


def walked(neighbours: DataFrame, params: PairParams) -> DataFrame:
    """Adds the strong neighbours met before each one when walking outwards from ``ev``."""
    walk = W.partitionBy("ev").orderBy("sep", "nb_ord").rowsBetween(W.unboundedPreceding, -1)
    strong = (F.col("n_links") >= params.min_links).cast("int")
    return neighbours.withColumn("strong_before", F.coalesce(F.sum(strong).over(walk), F.lit(0)))


def _written_pairs(reached: DataFrame, params: PairParams) -> DataFrame:
    return (
        reached.filter(F.col("n_links") >= params.min_obs)
        .groupBy("id1", "id2")
        .agg(
            F.first("sep").alias("sep"),
            F.first("n_links").alias("n_links"),
            F.first("n_p").alias("n_p"),
            F.first("n_s").alias("n_s"),
            F.bool_or(F.col("ev") == F.col("id1")).alias("forward"),
        )
        .withColumn("strong", F.col("n_links") >= params.min_links)
        .select(
            F.when(F.col("forward"), F.col("id1")).otherwise(F.col("id2")).alias("id1"),
            F.when(F.col("forward"), F.col("id2")).otherwise(F.col("id1")).alias("id2"),
            "sep", "n_links", "n_p", "n_s", "strong",
        )
    )


def select_neighbours(counts: DataFrame, params: PairParams) -> DataFrame:
    """W1 on complete counts: pairs written, the first event is the one that reaches the other.

    Event i reaches k when fewer than ``max_neighbours`` strong neighbours are nearer to i; the pair is
    written when either side reaches the other and it has ``min_obs`` observations.
    """
    reached = walked(directed(counts), params).filter(F.col("strong_before") < params.max_neighbours)
    return _written_pairs(reached, params)


def _searches(events: DataFrame, params: PairParams, head: int) -> list[tuple[float, float]]:
    """(radius, expected candidates) of first rounds that take ``head`` events from a location, widest first.

    A cell's own locations are counted as they are, their neighbours as if events were spread evenly around.
    """
    spots = events.groupBy("lat", "lon", "depth_km").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    levels = F.explode(F.array(*[F.lit(params.max_sep / 2**k) for k in range(HALVINGS + 1)]))
    cells = _with_cells(spots.withColumn("_radius", levels), F.col("_radius"), params.km_per_deg)
    taken = F.least(F.col("_n"), F.lit(head + 1.0))
    sums = (
        cells.groupBy("_radius", *CELL)
        .agg(F.sum("_n").alias("_n"), F.sum(taken).alias("_m"), F.sum(F.col("_n") * taken).alias("_own"))
        .groupBy("_radius")
        .agg(F.sum(F.col("_own") + 4 / 3 * math.pi * (F.col("_n") * F.col("_m") - F.col("_own"))).alias("_near"))
    )
    return sorted(((r["_radius"], r["_near"]) for r in sums.collect()), reverse=True)


def _location_heads(events: DataFrame, size: int) -> DataFrame:
    """The first ``size`` events of every location, and one more flagged as the place where it is cut."""
    spot = W.partitionBy("lat", "lon", "depth_km").orderBy("ord")
    return (
        events.withColumn("_rank", F.row_number().over(spot))
        .filter(F.col("_rank") <= size + 1)
        .withColumn("cut", F.col("_rank") > size)
        .drop("_rank")
    )


def _first_head(params: PairParams) -> int:
    return max(3 * params.max_neighbours // 2, 8)


def staged_neighbours(
    events: DataFrame, first: DataFrame, stations: DataFrame, params: PairParams, start_radius: float, hot_cell: int
) -> DataFrame:
    """W1 without forming all pairs of a dense region.

    Rounds widen the search radius and the number of events taken from one location. A candidate is safe
    when it comes before everything the round left out; an event is done when its safe candidates hold
    enough strong neighbours or when nothing was left out. The result equals ``select_neighbours``.
    """
    return _written_pairs(_staged(events, first, stations, params, start_radius, hot_cell), params)


def _staged(
    events: DataFrame, first: DataFrame, stations: DataFrame, params: PairParams, start_radius: float, hot_cell: int
) -> DataFrame:
    """The pairs that ``staged_neighbours`` reaches, seen from their event ``ev``."""
    radius, head = min(start_radius, params.max_sep), _first_head(params)
    pending, found = events, None
    while True:
        last_radius = radius >= params.max_sep
        heads = _location_heads(events, head)
        probe = _prefixed(_probes(pending, radius, params.km_per_deg, both_sides=True), "p_")
        resident = _prefixed(_with_cells(heads, radius, params.km_per_deg), "r_", ("cut",))
        near = (
            _blocked(probe, resident, hot_cell)
            .filter(F.col("p_ord") != F.col("r_ord"))
            .withColumn("sep", _oriented_separation(params.km_per_deg))
            .filter(F.col("sep") <= radius)
        )
        near = checkpointed(
            near.select(
                F.col("p_id").alias("ev"), F.col("r_id").alias("nb"), F.col("r_ord").alias("nb_ord"), "sep",
                F.col("r_cut").alias("cut"),
                F.when(F.col("p_ord") < F.col("r_ord"), F.col("p_id")).otherwise(F.col("r_id")).alias("id1"),
                F.when(F.col("p_ord") < F.col("r_ord"), F.col("r_id")).otherwise(F.col("p_id")).alias("id2"),
                F.least("p_ord", "r_ord").alias("ord1"),
                F.greatest("p_ord", "r_ord").alias("ord2"),
                ((F.col("p_lat") + F.col("r_lat")) / 2).alias("mid_lat"),
                ((F.col("p_lon") + F.col("r_lon")) / 2).alias("mid_lon"),
            )
        )
        edge = near.filter("cut").groupBy("ev").agg(F.min(F.struct("sep", "nb_ord")).alias("edge"))
        safe = (
            near.filter(~F.col("cut"))
            .join(edge, "ev", "left")
            .filter(F.col("edge").isNull() | (F.struct("sep", "nb_ord") < F.col("edge")))
        )
        pairs = safe.select(
            "id1", "id2", "ord1", "ord2", "sep", "mid_lat", "mid_lon"
        ).dropDuplicates(["id1", "id2"])
        counts = pair_counts(match_picks(pairs, first, stations, params.max_dist)).drop("ord1", "ord2", "sep")
        seen = safe.select("ev", "nb", "nb_ord", "id1", "id2", "sep").join(counts, ["id1", "id2"])
        steps = checkpointed(walked(seen, params))
        strong = F.count_if(F.col("n_links") >= params.min_links)
        full = steps.groupBy("ev").agg(strong.alias("n")).filter(F.col("n") >= params.max_neighbours).select("ev")
        if last_radius:
            whole = pending.select(F.col("id").alias("ev")).join(edge, "ev", "left_anti")
            done = full.union(whole).distinct()
        else:
            done = full
        done = checkpointed(done)
        reached = steps.join(done, "ev", "left_semi").filter(F.col("strong_before") < params.max_neighbours)
        found = reached if found is None else found.unionByName(reached)
        pending = checkpointed(pending.join(done, pending["id"] == done["ev"], "left_anti"))
        if pending.isEmpty():
            return found
        radius, head = min(radius * 2, params.max_sep), head * 4


def linked_pairs(
    events: DataFrame, first: DataFrame, stations: DataFrame, params: PairParams, hot_cell: int = HOT_CELL
) -> DataFrame:
    """E2 up to W1: which event pairs are linked, by how many observations.

    Expects events after F5 and first picks after F4. Catalogs with many candidate pairs take the staged search.
    """
    return _written_pairs(reached_neighbours(events, first, stations, params, hot_cell), params)


def reached_neighbours(
    events: DataFrame, first: DataFrame, stations: DataFrame, params: PairParams, hot_cell: int = HOT_CELL
) -> DataFrame:
    """Every pair that W1 looks at, seen from the event ``ev`` that reaches ``nb``.

    The staged search starts where an event may find some three times the neighbours it needs.
    """
    searches = _searches(events, params, _first_head(params))
    if not searches or searches[0][1] <= DIRECT_PAIRS:
        pairs = candidate_pairs(events, params.max_sep, params.km_per_deg)
        counts = pair_counts(match_picks(pairs, first, stations, params.max_dist))
        return walked(directed(counts), params).filter(F.col("strong_before") < params.max_neighbours)
    enough = 3 * params.max_neighbours * events.count()
    radius = next((r for r, near in searches if near <= enough), searches[-1][0])
    return _staged(events, first, stations, params, radius, hot_cell)


def pairing_inputs(
    events: DataFrame, picks: DataFrame, params: PairParams, ids: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Events after F5 and first picks after F4, written once because pairing reads them many times."""
    used = usable_picks(picks, params.min_weight)
    chosen = checkpointed(select_events(events, used, params.min_obs, ids))
    first = checkpointed(first_picks(used.join(chosen.select("id"), "id", "left_semi")))
    return chosen, first


# ---------------------------------------------------------------------------------------------
# Differential times


def differential_times(
    events: DataFrame, picks: DataFrame, stations: DataFrame, params: PairParams, ids: DataFrame | None = None
) -> DataFrame:
    """Catalog links id1, id2, sta, phase, t1, t2, qual, sep of the selected pairs."""
    chosen, first = pairing_inputs(events, picks, params, ids)
    pairs = checkpointed(linked_pairs(chosen, first, stations, params))
    return nearest_links(pairs, chosen, first, stations, params)


def located(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """id1, id2, sep of pairs with the point half way."""
    def place(n: int) -> DataFrame:
        return events.select(
            F.col("id").alias(f"id{n}"), F.col("lat").alias(f"lat{n}"), F.col("lon").alias(f"lon{n}")
        )

    return (
        pairs.select("id1", "id2", "sep")
        .join(place(1), "id1")
        .join(place(2), "id2")
        .select(
            "id1", "id2", "sep",
            ((F.col("lat1") + F.col("lat2")) / 2).alias("mid_lat"),
            ((F.col("lon1") + F.col("lon2")) / 2).alias("mid_lon"),
        )
    )


def nearest_links(
    pairs: DataFrame, events: DataFrame, first: DataFrame, stations: DataFrame, params: PairParams
) -> DataFrame:
    """Per pair the ``max_obs`` links at the nearest stations; important links come first and on top."""
    rows = match_picks(located(pairs, events), first, stations, params.max_dist).filter(F.col("status") == "ok")
    nearest = W.partitionBy("id1", "id2").orderBy("rank_dist", "sta", "phase")
    return (
        rows.withColumn("rank_dist", F.when(F.col("important"), 0.0).otherwise(F.col("dist")))
        .withColumn("rank", F.row_number().over(nearest))
        .withColumn("n_important", F.count_if("important").over(W.partitionBy("id1", "id2")))
        .filter(F.col("rank") <= params.max_obs + F.col("n_important"))
        .select("id1", "id2", "sta", "phase", "t1", "t2", "qual", "sep", "rank")
    )


# ---------------------------------------------------------------------------------------------
# Selection funnel


def selection_funnel(
    events: DataFrame, picks: DataFrame, stations: DataFrame, params: PairParams
) -> DataFrame:
    """One row (metric, value) per stage of pairing."""
    chosen, first = pairing_inputs(events, picks, params)
    reached = checkpointed(reached_neighbours(chosen, first, stations, params))
    pairs = checkpointed(_written_pairs(reached, params))
    looked_at = reached.select("id1", "id2", "sep").dropDuplicates(["id1", "id2"])
    seen = match_picks(located(looked_at, chosen), first, stations, params.max_dist)
    links = nearest_links(pairs, chosen, first, stations, params)
    strong = (
        reached.groupBy("ev").agg(F.count_if(F.col("n_links") >= params.min_links).alias("n"))
        .filter(F.col("n") >= params.max_neighbours)
    )

    def unpivot(df: DataFrame, *names: str) -> DataFrame:
        pairs_ = F.array(*[
            F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
        ])
        return df.select(F.explode(pairs_).alias("m")).select("m.*")

    stages = [
        unpivot(events.agg(F.count(F.lit(1)).alias("events_total")), "events_total"),
        unpivot(
            chosen.agg(F.count(F.lit(1)).alias("events_selected"), F.sum("n_picks").alias("picks_selected")),
            "events_selected", "picks_selected",
        ),
        unpivot(
            seen.agg(
                F.count_if(F.col("phase") == "P").alias("p_pairs_total"),
                F.count_if(F.col("phase") == "S").alias("s_pairs_total"),
                F.count_if(F.col("status") == "outlier").alias("outliers"),
                F.count_if(F.col("status") == "unknown").alias("unknown_station"),
                F.count_if(F.col("status") == "far").alias("too_far"),
            ),
            "p_pairs_total", "s_pairs_total", "outliers", "unknown_station", "too_far",
        ),
        unpivot(
            links.agg(
                F.count_if(F.col("phase") == "P").alias("p_pairs_selected"),
                F.count_if(F.col("phase") == "S").alias("s_pairs_selected"),
            ),
            "p_pairs_selected", "s_pairs_selected",
        ),
        unpivot(
            pairs.agg(
                F.count(F.lit(1)).alias("linked_pairs"),
                F.avg("sep").alias("mean_sep"),
                F.avg(F.when(F.col("strong"), F.col("sep"))).alias("mean_sep_strong"),
                F.max(F.when(F.col("strong"), F.col("sep"))).alias("max_sep_strong"),
            ),
            "linked_pairs", "mean_sep", "mean_sep_strong", "max_sep_strong",
        ),
        unpivot(
            chosen.join(strong, chosen["id"] == strong["ev"], "left_anti").agg(
                F.count(F.lit(1)).alias("weakly_linked_events")
            ),
            "weakly_linked_events",
        ),
    ]
    out = stages[0]
    for stage in stages[1:]:
        out = out.unionByName(stage)
    return out


def used_stations(links: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations with at least one link (input of K6)."""
    return stations.join(links.select("sta").distinct(), "sta", "left_semi")
