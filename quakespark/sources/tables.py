"""Delimited sources: detections, stations, catalogs, id mappings, arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark import schemas
from quakespark.functions import timefn
from quakespark.sources.text import _ordered


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections with phase picks."""
    raw = _ordered(spark.read.csv(path, header=True, schema=schemas.DETECTION_CSV))
    return raw.select(
        "event_id", "template_id",
        timefn.parse_iso("origin_time").alias("origin_time"),
        F.col("station").alias("sta"),
        F.col("src").alias("row_id"),
        F.col("travel_time_p").alias("tt_p"), F.col("travel_time_s").alias("tt_s"),
        F.col("lag_time_p").alias("lag_p"), F.col("lag_time_s").alias("lag_s"),
        "cc_p", "cc_s",
    )


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV; elevation in metres in the file, in km in the table."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        F.col("station").cast("string").alias("sta"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        (F.col("elevation").cast("double") / 1000.0).alias("elev_km"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """S3: catalog CSV; missing uncertainties become 0."""
    raw = spark.read.csv(path, header=True)

    def optional(name: str):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in raw.columns else F.lit(0.0)

    return raw.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        F.col("depth").cast("double").alias("depth_km"),
        F.col("magnitude").cast("double").alias("mag"),
        optional("uncertainty_x").alias("eh"),
        optional("uncertainty_z").alias("ez"),
    )


def mapping_columns(columns: list[str]) -> tuple[str, str] | None:
    """(integer id, original id) columns of an id mapping, None when neither naming fits.

    Older files name them synthetic_id and original_id. Newer ones have two columns, event_id for the original and one
    that ends in _id for the integer; a file with more columns, or with template_id, is no mapping unless the caller
    names the columns.
    """
    if {"synthetic_id", "original_id"} <= set(columns):
        return "synthetic_id", "original_id"
    others = [c for c in columns if c != "event_id"]
    fits = len(columns) == 2 and len(others) == 1 and others[0].endswith("_id") and others[0] != "template_id"
    return (others[0], "event_id") if fits else None


def read_id_mapping(spark: SparkSession, path: str, number: str | None = None, original: str | None = None) -> DataFrame:
    """Id mapping as original_id, synthetic_id; empty for files without one.

    ``number`` and ``original`` name the columns of the integer and of the original id; without them both column
    namings are tried. A column that is named but missing fails.
    """
    raw = spark.read.csv(path, header=True)
    found = mapping_columns(raw.columns)
    if number is not None or original is not None:
        found = (number or "synthetic_id", original or "event_id")
        if missing := set(found) - set(raw.columns):
            raise ValueError(f"no column {', '.join(sorted(missing))} in {path}")
    if found is None:
        return spark.createDataFrame([], "original_id string, synthetic_id bigint")
    return raw.select(
        F.col(found[1]).cast("string").alias("original_id"), F.col(found[0]).cast("bigint").alias("synthetic_id")
    )


def read_station_list(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated station list with network codes."""
    raw = _ordered(spark.read.csv(path, header=True, sep="|"))
    return raw.select(
        F.col("Network").alias("network"), F.col("Station").alias("sta"),
        F.col("Latitude").cast("double").alias("lat"), F.col("Longitude").cast("double").alias("lon"),
        F.col("src"),
    )


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """Arrival CSV with absolute times: event, station, phase, time."""
    raw = _ordered(spark.read.csv(path, header=True))
    return raw.select(
        F.col("event").cast("bigint").alias("id"), F.col("station").alias("sta"), "phase",
        timefn.parse_iso(F.regexp_replace("time", " ", "T")).alias("arrival_time"), "src",
    )
