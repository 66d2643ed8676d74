"""Text and CSV sinks. Lines are formatted by Spark and written by many tasks in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark import schemas
from quakespark.functions import timefn


def _line(template: str, *columns: Column) -> Column:
    return F.format_string(template, *columns)


def write_lines(df: DataFrame, order: list, path: str) -> None:
    """Write column ``line``; the part files in name order hold the lines in ``order``."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode("overwrite").text(path)


def write_header_detail(headers: DataFrame, details: DataFrame, path: str) -> None:
    """Write header lines (key, line), each followed by its detail lines (key, seq, line).

    Rows are ranged by key, so a record never spans two part files and no record is gathered in memory.
    """
    body = details.select("key", F.lit(1).alias("kind"), "seq", "line")
    no_seq = F.lit(None).cast(details.schema["seq"].dataType)
    head = headers.select("key", F.lit(0).alias("kind"), no_seq.alias("seq"), "line")
    (
        head.unionByName(body)
        .repartitionByRange("key")
        .sortWithinPartitions("key", "kind", "seq")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def station_lines(stations: DataFrame) -> DataFrame:
    """K1: station lines, elevation in metres."""
    return stations.withColumn(
        "line", _line("%-7s %9.5f %10.5f %6.1f", F.col("sta"), F.col("lat"), F.col("lon"), F.col("elev_km") * 1000.0)
    )


def write_stations(stations: DataFrame, path: str, order: str = "sta") -> None:
    """K1: station text file."""
    write_lines(station_lines(stations), [order], path)


def phase_header_lines(events: DataFrame) -> DataFrame:
    """K2: header line per event."""
    p = timefn.timestamp_parts("origin_time")
    zero = F.lit(0.0)
    extra = [F.coalesce(F.col(c), zero) if c in events.columns else zero for c in ("mag", "eh", "ez", "rms")]
    return events.withColumn(
        "line",
        _line(
            "#%5d %2d %2d %2d %2d %5.2f %8.4f %9.4f %7.2f%6.2f%6.2f%6.2f%6.2f %10d",
            p["yr"], p["mo"], p["dy"], p["hr"], p["mi"], p["sc"],
            F.col("lat"), F.col("lon"), F.col("depth_km"), *extra, F.col("id"),
        ),
    )


def phase_pick_lines(picks: DataFrame) -> DataFrame:
    return picks.withColumn(
        "line", _line("%-7s %8.3f %6.3f %s", F.col("sta"), F.col("tt"), F.col("weight"), F.col("phase"))
    )


def write_phases(events: DataFrame, picks: DataFrame, path: str, order: str = "id") -> None:
    """K2: phase text file, events by ``order`` and picks by ``seq``."""
    keys = events.select("id", F.col(order).alias("key"))
    write_header_detail(
        phase_header_lines(events).withColumn("key", F.col(order)),
        phase_pick_lines(picks).join(keys, "id"),
        path,
    )


def correlation_lines(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    key = F.struct("id1", "id2")
    heads = links.select("id1", "id2").distinct().select(
        key.alias("key"), _line("# %9d %9d %8.6f", F.col("id1"), F.col("id2"), F.lit(0.0)).alias("line")
    )
    body = links.select(
        key.alias("key"), "seq",
        _line("%-7s %9.6f %5.3f %s", F.col("sta"), F.col("dt"), F.col("qual"), F.col("phase")).alias("line"),
    )
    return heads, body


def write_correlation_links(links: DataFrame, path: str) -> None:
    """K3: correlation link file; a pair without a link has no header."""
    write_header_detail(*correlation_lines(links), path)


def catalog_link_lines(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    key = F.struct("id1", "id2")
    heads = links.select("id1", "id2").distinct().select(
        key.alias("key"), _line("# %9d %9d", F.col("id1"), F.col("id2")).alias("line")
    )
    body = links.select(
        key.alias("key"), F.col("rank").alias("seq"),
        _line("%-7s %7.3f %7.3f %6.4f %s", F.col("sta"), F.col("t1"), F.col("t2"), F.col("qual"), F.col("phase")).alias("line"),
    )
    return heads, body


def write_catalog_links(links: DataFrame, path: str) -> None:
    """K4: catalog link file, links of a pair by rank."""
    write_header_detail(*catalog_link_lines(links), path)


def event_lines(events: DataFrame) -> DataFrame:
    """K5: event list lines."""
    zero = F.lit(0.0)
    extra = [F.coalesce(F.col(c), zero) if c in events.columns else zero for c in ("mag", "eh", "ez", "rms")]
    return events.withColumn(
        "line",
        _line(
            "%8d  %8d  %8.4f  %9.4f  %9.3f  %5.2f  %6.2f  %6.2f  %5.2f %10d",
            timefn.date_int("origin_time"), timefn.time_int("origin_time"),
            F.col("lat"), F.col("lon"), F.col("depth_km"), *extra, F.col("id"),
        ),
    )


def write_events(events: DataFrame, path: str, order: str = "id") -> None:
    """K5: event list."""
    write_lines(event_lines(events), [order], path)


def write_used_stations(stations: DataFrame, path: str, order: str = "sta") -> None:
    """K6: stations with at least one link."""
    lines = stations.withColumn(
        "line", _line("%-7s%13.6f%13.6f%10.1f", F.col("sta"), F.col("lat"), F.col("lon"), F.col("elev_km") * 1000.0)
    )
    write_lines(lines, [order], path)


def relocation_lines(reloc: DataFrame) -> DataFrame:
    """K7: the 24 values of a relocation; missing rms is written as the sentinel."""
    c = F.col
    gone = F.lit(schemas.NO_RMS)
    return reloc.withColumn(
        "line",
        _line(
            "%9d %10.6f %11.6f %9.3f %10.1f %10.1f %10.1f %8.1f %8.1f %8.1f %4d %2d %2d %2d %2d %6.3f %5.2f"
            " %5d %5d %5d %5d %6.3f %6.3f %3d",
            *[c(n) for n in ("id", "lat", "lon", "depth_km", "x_m", "y_m", "z_m", "ex_m", "ey_m", "ez_m",
                             "yr", "mo", "dy", "hr", "mi", "sc", "mag", "n_cc_p", "n_cc_s", "n_ct_p", "n_ct_s")],
            F.coalesce(c("rms_cc"), gone), F.coalesce(c("rms_ct"), gone), c("cluster_id"),
        ),
    )


def write_relocations(reloc: DataFrame, path: str) -> None:
    write_lines(relocation_lines(reloc), ["cluster_id", "id"], path)


def residual_lines(links: DataFrame) -> DataFrame:
    """K7: residuals in ms, separations in m."""
    c = F.col
    return links.withColumn(
        "line",
        _line(
            "%-7s %12.7f %9d %9d %1d %9.4f %12.6f %11.6f %8.1f",
            c("sta"), c("dt"), c("id1"), c("id2"), c("idx"), c("qual"), c("res") * 1000.0, c("wt"), c("offs_m"),
        ),
    )


def station_result_lines(stations: DataFrame) -> DataFrame:
    """K7: station results; distance and azimuth are not defined for a whole run and print as 0."""
    c = F.col
    zero = F.lit(0.0)
    return stations.withColumn(
        "line",
        _line(
            "%-7s %9.4f %9.4f %9.4f %9.4f %7d %7d %7d %7d %9.4f %9.4f %3d",
            c("sta"), c("lat"), c("lon"), zero, zero, c("n_cc_p"), c("n_cc_s"), c("n_ct_p"), c("n_ct_s"),
            F.coalesce(c("rms_cc"), zero), F.coalesce(c("rms_ct"), zero), c("cluster_id"),
        ),
    )


def write_results(df: DataFrame, path: str, *partition: str) -> None:
    """K7: any result table as Parquet, split by cluster and iteration."""
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K8: CSV with a header."""
    df.write.mode("overwrite").csv(path, header=True)
