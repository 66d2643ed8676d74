"""Travel times, take-off angles and their spatial derivatives for used (station, source) pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark.functions import geo

# Degrees per radian and pi as used in take-off angles.
DEG_PER_RAD = 57.2958
PI = 3.141593
BOUNDARY_TOLERANCE, BOUNDARY_STEP = 0.0001, 0.001

TT_COLUMNS = ["tt_p", "tt_s", "px", "py", "pz", "sx", "sy", "sz"]


def velocity_model(top, vp, ratio=None, vs=None, model_id: int = 1) -> list[tuple]:
    """Rows (model_id, top, vp, vs) of one model; G9: Vs = Vp / ratio."""
    if vs is None:
        vs = [p / r for p, r in zip(vp, ratio)]
    return [(int(model_id), float(t), float(p), float(s)) for t, p, s in zip(top, vp, vs)]


MODEL_SCHEMA = "model_id int, top double, vp double, vs double"


def speed_ratio(model: DataFrame) -> DataFrame:
    """Vp/Vs of every layer."""
    return model.withColumn("vp_vs", F.col("vp") / F.col("vs"))


def model_of_station(stations: DataFrame, model: DataFrame) -> DataFrame:
    """The station's own model if it exists, else model 1."""
    known = model.select("model_id").distinct().withColumn("_known", F.lit(True))
    own = F.when(F.col("_known"), F.col("model_id")).otherwise(F.lit(1))
    return stations.join(known, "model_id", "left").withColumn("model_id", own).drop("_known")


def used_paths(links: DataFrame) -> DataFrame:
    """Distinct (station, event) pairs that a link uses."""
    return links.select("sta", F.explode(F.array("id1", "id2")).alias("id")).distinct()


def path_geometry(paths: DataFrame, sources: DataFrame, stations: DataFrame) -> DataFrame:
    """Paths with epicentral distance and azimuth from source to station."""
    src = sources.select("id", F.col("lat").alias("_elat"), F.col("lon").alias("_elon"), "depth_km")
    keep = ["sta", F.col("lat").alias("_slat"), F.col("lon").alias("_slon"), "elev_km"]
    if "model_id" in stations.columns:
        keep.append("model_id")
    joined = paths.join(src, "id").join(stations.select(*keep), "sta")
    return (
        joined.withColumn("dist", geo.distance_km("_elat", "_elon", "_slat", "_slon", "rays"))
        .withColumn("az", geo.azimuth_deg("_elat", "_elon", "_slat", "_slon"))
        .drop("_elat", "_elon", "_slat", "_slon")
    )


def _slowness(angle: Column, speed: Column | float, sign: Column | float = 1.0) -> list[Column]:
    """Derivatives along x (east), y (north) and z (down) of a ray leaving at ``angle`` from nadir."""
    a = angle * (PI / 180.0)
    azimuth = F.col("az")
    return [
        F.sin(a) * F.cos((azimuth - 90.0) * (PI / 180.0)) / speed,
        F.sin(a) * F.cos(azimuth * (PI / 180.0)) / speed,
        F.cos(a) / speed * sign,
    ]


def straight_rays(paths: DataFrame, vp: float, vs: float) -> DataFrame:
    """Constant speed; the station may lie below the source."""
    height = F.col("depth_km") + F.col("elev_km")
    length = F.sqrt(F.col("dist") * F.col("dist") + height * height)
    steep = F.atan2(F.col("dist"), F.abs(height)) * DEG_PER_RAD
    below = height < 0
    angle = F.when(below, steep).otherwise(180.0 - steep)
    sign = F.when(below, -1.0).otherwise(1.0)
    p, s = _slowness(angle, vp, sign), _slowness(angle, vs, sign)
    values = [length / vp, length / vs, *p, *s]
    return paths.select(
        "sta", "id", "dist", "az", angle.alias("angle_p"), angle.alias("angle_s"),
        *[v.alias(n) for v, n in zip(values, TT_COLUMNS)],
    )


# ---------------------------------------------------------------------------------------------
# layered models: vectorised helpers on the rows of one Arrow batch


def _layer_of(depth: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Index of the layer that holds each depth; a depth on a boundary belongs to the layer above."""
    return np.clip((top < depth[:, None]).sum(axis=1) - 1, 0, top.shape[1] - 1)


def head_waves(delta, inside, thickness, layer: int, v) -> tuple[np.ndarray, np.ndarray]:
    """Fastest head wave for sources ``inside`` km below the top of ``layer``: (time, sine at source).

    ``thickness`` is (rows, layers - 1). A deeper layer carries a head wave when it is faster than every
    layer above it and the critical distance is not larger than ``delta``.
    """
    best = np.full(len(delta), np.inf)
    sine = np.zeros(len(delta))
    for m in range(layer + 1, len(v)):
        if v[m] <= v[:m].max():
            continue
        legs = np.where(np.arange(m) < layer, 1.0, 2.0)       # the source layer and below are crossed twice
        slow = np.sqrt(v[m] ** 2 - v[:m] ** 2)
        intercept = thickness[:, :m] @ (legs * slow / (v[:m] * v[m]))
        critical = thickness[:, :m] @ (legs * v[:m] / slow)
        intercept = intercept - inside * slow[layer] / (v[m] * v[layer])
        critical = critical - inside * v[layer] / slow[layer]
        time = np.where(critical <= delta, intercept + delta / v[m], np.inf)
        faster = time < best
        best = np.where(faster, time, best)
        sine = np.where(faster, v[layer] / v[m], sine)
    return best, sine


def direct_rays(delta, inside, thickness, layer: int, v, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Direct upgoing ray: (time, sine of the take-off angle at the source).

    The unknown is the tangent s of the ray in the fastest layer it crosses. The distance reached grows
    with s and is concave, so Newton steps from s = 0 approach the root from below.
    """
    legs = np.concatenate([thickness[:, :layer], inside[:, None]], axis=1)
    speed = v[: layer + 1]
    rel = speed / speed.max()
    s = np.zeros(len(delta))
    for _ in range(steps):
        root = np.sqrt(1.0 + s[:, None] ** 2 * (1.0 - rel**2))
        reached = (legs * rel * s[:, None] / root).sum(axis=1)
        slope = (legs * rel / root**3).sum(axis=1)
        step = (delta - reached) / np.maximum(slope, 1e-300)
        s = s + step
        if np.all(np.abs(delta - reached) < 1e-9):
            break
    stretch = np.sqrt(1.0 + s**2)
    # cosines from the tangent: a nearly level ray keeps its digits
    cosine = np.sqrt(1.0 + s[:, None] ** 2 * (1.0 - rel**2)) / stretch[:, None]
    return (legs / (speed * cosine)).sum(axis=1), rel[layer] * s / stretch


def first_arrivals(delta, depth, elev, top, v) -> tuple[np.ndarray, np.ndarray]:
    """Time and take-off angle (degrees from nadir) of the first arrival per row.

    Depths count from the station: every layer but the first is shifted by the station elevation.
    """
    shifted = top[None, :] + elev[:, None]
    shifted[:, 0] = 0.0
    below = depth + elev
    layer = _layer_of(below, shifted)
    time, angle = np.empty(len(delta)), np.empty(len(delta))
    for k in np.unique(layer):
        rows = layer == k
        tops = shifted[rows]
        thickness = np.diff(tops, axis=1)
        inside = below[rows] - tops[:, k]
        t_direct, u_direct = direct_rays(delta[rows], inside, thickness, k, v)
        t_head, u_head = head_waves(delta[rows], inside, thickness, k, v)
        direct = t_direct <= t_head
        time[rows] = np.where(direct, t_direct, t_head)
        up = 180.0 - np.arcsin(np.clip(u_direct, -1.0, 1.0)) * DEG_PER_RAD
        down = np.arcsin(np.clip(u_head, -1.0, 1.0)) * DEG_PER_RAD
        angle[rows] = np.where(direct, up, down)
    return time, angle


def off_boundaries(depth, top) -> np.ndarray:
    """Sources on a layer boundary are lifted off it."""
    on = (np.abs(depth[:, None] - top[None, :]) < BOUNDARY_TOLERANCE).any(axis=1)
    return np.where(on, depth - BOUNDARY_STEP, depth)


def _trace(pdf: pd.DataFrame, models: dict) -> pd.DataFrame:
    out = pdf[["sta", "id", "dist", "az"]].copy()
    for name in ("angle_p", "angle_s", *TT_COLUMNS):
        out[name] = np.nan
    which = pdf["model_id"].to_numpy()
    for model_id in np.unique(which):
        top, vp, vs = models[int(model_id)]
        rows = np.flatnonzero(which == model_id)
        delta, elev, az = (pdf[c].to_numpy(dtype=float)[rows] for c in ("dist", "elev_km", "az"))
        depth = off_boundaries(pdf["depth_km"].to_numpy(dtype=float)[rows], top)
        at = np.clip(np.searchsorted(top, depth, side="left") - 1, 0, len(top) - 1)
        for low, v in (("p", vp), ("s", vs)):
            time, angle = first_arrivals(delta, depth, elev, top, v)
            a = angle * PI / 180.0
            values = {
                f"tt_{low}": time,
                f"angle_{low}": angle,
                f"{low}x": np.sin(a) * np.cos((az - 90.0) * PI / 180.0) / v[at],
                f"{low}y": np.sin(a) * np.cos(az * PI / 180.0) / v[at],
                f"{low}z": np.cos(a) / v[at],
            }
            for name, value in values.items():
                out.iloc[rows, out.columns.get_loc(name)] = value
    return out


def layered_rays(paths: DataFrame, model: list[tuple]) -> DataFrame:
    """First arrivals in layered models; ``model`` rows are (model_id, top, vp, vs)."""
    models = {}
    for model_id in sorted({row[0] for row in model}):
        rows = sorted(row[1:] for row in model if row[0] == model_id)
        models[model_id] = tuple(np.array(c) for c in zip(*rows))
    if "model_id" not in paths.columns:
        paths = paths.withColumn("model_id", F.lit(next(iter(models))))
    paths = paths.select("sta", "id", "dist", "az", "depth_km", "elev_km", "model_id")

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield _trace(pdf, models)

    kind = dict(paths.dtypes)["id"]
    doubles = ", ".join(f"{c} double" for c in ("dist", "az", "angle_p", "angle_s", *TT_COLUMNS))
    return paths.mapInPandas(batches, f"sta string, id {kind}, {doubles}")


def travel_times(paths: DataFrame, model: list[tuple], mode: str = "layered") -> DataFrame:
    """R3, R6 or R7 for paths with geometry. Mode: 'straight', 'layered' or 'station'."""
    if mode == "straight":
        _, _, vp, vs = model[0]
        return straight_rays(paths, vp, vs)
    if mode == "layered" and "model_id" in paths.columns:
        paths = paths.drop("model_id")
    return layered_rays(paths, model)
