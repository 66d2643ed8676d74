"""Whitespace text sources. Every reader keeps the file order in a sortable ``src`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark import schemas
from quakespark.functions import timefn

_LOCAL_INDEX = (1 << 33) - 1


def _ordered(df: DataFrame) -> DataFrame:
    """File, offset of the split, and index inside the task: sorts like the lines of the input."""
    local = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_INDEX))
    return df.withColumn(
        "src",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            local.alias("line"),
        ),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``src`` and the whitespace tokens ``tok``; empty lines are left out."""
    lines = _ordered(spark.read.text(path))
    return lines.withColumn("tok", tokens(F.col("value"))).filter(F.size("tok") > 0)


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(text, "[\\t\\r]", " ")), " +"), lambda t: t != "")


def number(tok: Column, kind: str = "double") -> Column:
    return tok.try_cast(kind)


def required(tok: Column, kind: str, what: str) -> Column:
    """Cast that fails the job on unreadable text."""
    cast = tok.try_cast(kind)
    return F.coalesce(cast, F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(tok, F.lit("nothing")))).cast(kind))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Header/detail files: one row per ``#`` header with header tokens ``head`` and detail lines ``body``."""
    raw = _ordered(spark.read.option("lineSep", "\n#").text(path))
    lines = F.split(F.regexp_replace(F.col("value"), "^#", ""), "\r?\n")
    return (
        raw.withColumn("_lines", lines)
        .withColumn("head", tokens(F.element_at("_lines", 1)))
        .withColumn("body", F.slice("_lines", 2, F.size("_lines")))
        .drop("value", "_lines")
        .filter(F.size("head") > 0)
    )


def _details(records: DataFrame, *keep: str) -> DataFrame:
    return (
        records.select("src", *keep, F.posexplode("body").alias("pos", "line"))
        .withColumn("tok", tokens(F.col("line")))
        .filter(F.size("tok") > 0)
        .withColumn("seq", F.col("pos").cast("bigint"))
    )


def read_phase_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, picks) of a phase file: ``#`` lines with 14 values, pick lines with 4."""
    records = read_records(spark, path)
    bad = F.raise_error(F.concat(F.lit("bad event line: "), F.concat_ws(" ", "head")))
    records = records.withColumn("head", F.when(F.size("head") >= 14, F.col("head")).otherwise(bad))
    h = [F.get("head", F.lit(i)) for i in range(14)]
    event_id = required(h[13], "bigint", "event id")
    events = records.select(
        event_id.alias("id"),
        F.col("src").alias("ord"),
        timefn.from_parts(
            h[0].cast("int"), h[1].cast("int"), h[2].cast("int"), h[3].cast("int"), h[4].cast("int"),
            h[5].cast("double"),
        ).alias("origin_time"),
        *[required(h[i], "double", "event line").alias(n)
          for i, n in ((6, "lat"), (7, "lon"), (8, "depth_km"), (9, "mag"), (10, "eh"), (11, "ez"), (12, "rms"))],
    )
    detail = _details(records.withColumn("id", event_id), "id")
    t = [F.get("tok", F.lit(i)) for i in range(4)]
    picks = detail.select(
        "id", "seq", t[0].alias("sta"), t[3].alias("phase"),
        required(t[1], "double", "pick line").alias("tt"), required(t[2], "double", "pick line").alias("weight"),
    )
    return events, picks


def _read_links(spark: SparkSession, path: str, head_values: int, columns) -> DataFrame:
    records = read_records(spark, path)
    bad = F.raise_error(F.concat(F.lit("bad pair line: "), F.concat_ws(" ", "head")))
    records = records.withColumn("head", F.when(F.size("head") >= head_values, F.col("head")).otherwise(bad))
    h = [F.get("head", F.lit(i)) for i in range(3)]
    records = records.withColumn("id1", required(h[0], "bigint", "id")).withColumn("id2", required(h[1], "bigint", "id"))
    if head_values > 2:
        records = records.withColumn("otc", required(h[2], "double", "origin time correction"))
        detail = _details(records, "id1", "id2", "otc")
    else:
        detail = _details(records, "id1", "id2")
    t = [F.get("tok", F.lit(i)) for i in range(5)]
    return detail.select(*[c for c in detail.columns if c in ("id1", "id2", "otc")], "seq", t[0].alias("sta"), *columns(t))


def read_correlation_links(spark: SparkSession, path: str) -> DataFrame:
    """id1, id2, otc, sta, dt, qual, phase of a correlation link file."""
    return _read_links(spark, path, 3, lambda t: [
        required(t[1], "double", "link").alias("dt"), required(t[2], "double", "link").alias("qual"), t[3].alias("phase"),
    ])


def read_catalog_links(spark: SparkSession, path: str) -> DataFrame:
    """id1, id2, sta, t1, t2, qual, phase of a catalog link file."""
    return _read_links(spark, path, 2, lambda t: [
        required(t[1], "double", "link").alias("t1"), required(t[2], "double", "link").alias("t2"),
        required(t[3], "double", "link").alias("qual"), t[4].alias("phase"),
    ])


def read_station_file(spark: SparkSession, path: str) -> DataFrame:
    """Station file with 3, 4 or 5 columns; the first line sets their number."""
    lines = read_lines(spark, path)
    first = lines.orderBy("src").select(F.size("tok").alias("n")).head(1)
    n = first[0]["n"] if first else 3
    if n not in (3, 4, 5):
        raise ValueError(f"bad station line: {n} columns")
    t = [F.get("tok", F.lit(i)) for i in range(5)]
    short = F.raise_error(F.concat(F.lit("bad station line: "), F.col("value")))
    lines = lines.withColumn("tok", F.when(F.size("tok") >= n, F.col("tok")).otherwise(short))
    return lines.select(
        t[0].alias("sta"),
        required(t[1], "double", "station line").alias("lat"),
        required(t[2], "double", "station line").alias("lon"),
        (required(t[3], "double", "station line") if n >= 4 else F.lit(0.0)).alias("elev_m"),
        (required(t[4], "int", "station line") if n == 5 else F.lit(0)).alias("model_id"),
        "src",
    )


def read_event_list(spark: SparkSession, path: str) -> DataFrame:
    """Event list with 10 or 11 columns (the last one is the fix code)."""
    lines = read_lines(spark, path)
    short = F.raise_error(F.concat(F.lit("bad event line: "), F.col("value")))
    lines = lines.withColumn("tok", F.when(F.size("tok").isin(10, 11), F.col("tok")).otherwise(short))
    t = [F.get("tok", F.lit(i)) for i in range(11)]
    names = ["lat", "lon", "depth_km", "mag", "eh", "ez", "rms"]
    return lines.select(
        required(t[9], "bigint", "event id").alias("id"),
        F.col("src").alias("ord"),
        required(t[0], "int", "date").alias("date"),
        required(t[1], "int", "time").alias("time"),
        *[required(t[2 + i], "double", "event line").alias(n) for i, n in enumerate(names)],
        F.coalesce(number(t[10], "int"), F.lit(0)).alias("fix"),
    )


def read_relocations(spark: SparkSession, path: str, min_tokens: int = 24) -> DataFrame:
    """Relocation lines with at least ``min_tokens`` values; shorter lines are dropped.

    With 24 values all columns are read, otherwise id, lat, lon and depth only.
    """
    lines = read_lines(spark, path).filter(F.size("tok") >= min_tokens)
    fields = schemas.RELOCATION.fields if min_tokens >= 24 else schemas.RELOCATION.fields[:4]
    return lines.select(*[
        required(F.get("tok", F.lit(i)), f.dataType.simpleString(), "relocation line").alias(f.name)
        for i, f in enumerate(fields)
    ])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One event id per line, for selection or for the list of bad events."""
    lines = read_lines(spark, path)
    return lines.select(required(F.get("tok", F.lit(0)), "bigint", "event id").alias("id"))


def read_velocity_table(spark: SparkSession, path: str, skip_lines: int = 1) -> DataFrame:
    """One model as depth, Vp, Vs lines after a title; adds the layer number and Vp/Vs."""
    lines = read_lines(spark, path)
    t = [number(F.get("tok", F.lit(i))) for i in range(3)]
    table = lines.select("src", t[0].alias("top"), t[1].alias("vp"), t[2].alias("vs"))
    if skip_lines:
        titles = table.orderBy("src").limit(skip_lines).select("src")
        table = table.join(titles, "src", "left_anti")
    return table.filter(F.col("top").isNotNull()).select(
        F.lit(1).alias("model_id"), "top", "vp", "vs", (F.col("vp") / F.col("vs")).alias("vp_vs")
    )


def read_station_models(spark: SparkSession, path: str) -> DataFrame:
    """Models per station: lines ``id n`` followed by n lines of top, Vp, Vs."""
    lines = read_lines(spark, path).withColumn("_n", F.size("tok"))
    down = W.partitionBy("src.file").orderBy("src").rowsBetween(W.unboundedPreceding, 0)
    head = F.when(F.col("_n") == 2, F.get("tok", F.lit(0)).cast("int"))
    t = [required(F.get("tok", F.lit(i)), "double", "layer of a model") for i in range(3)]
    return (
        lines.withColumn("model_id", F.last(head, ignorenulls=True).over(down))
        .filter(F.col("_n") >= 3)
        .select("model_id", t[0].alias("top"), t[1].alias("vp"), t[2].alias("vs"))
    )


def read_station_results(spark: SparkSession, path: str) -> DataFrame:
    """Station results read back."""
    lines = read_lines(spark, path)
    return lines.select(*[
        required(F.get("tok", F.lit(i)), f.dataType.simpleString(), "station result").alias(f.name)
        for i, f in enumerate(schemas.STATION_RESULT.fields)
    ])
