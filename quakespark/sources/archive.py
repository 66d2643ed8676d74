"""Fixed-column archives: phase archive (two layouts) and station list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark.functions import timefn
from quakespark.sources.text import _ordered, required

# 1-based first and last column and implied decimals of every field, per layout.
HEADER_COLUMNS = {
    "short": {
        "date": (1, 6, 0), "mo": (3, 4, 0), "dy": (5, 6, 0), "hr": (7, 8, 0), "mi": (9, 10, 0), "sc": (11, 14, 2),
        "lat_deg": (15, 16, 0), "lat_min": (18, 21, 2), "lon_deg": (22, 24, 0), "lon_min": (26, 29, 2),
        "depth": (30, 34, 2), "mag": (68, 69, 1), "rms": (46, 49, 2), "eh": (81, 84, 2), "ez": (85, 88, 2),
        "id": (129, 138, 0),
    },
    "long": {
        "date": (1, 8, 0), "mo": (5, 6, 0), "dy": (7, 8, 0), "hr": (9, 10, 0), "mi": (11, 12, 0), "sc": (13, 16, 2),
        "lat_deg": (17, 18, 0), "lat_min": (20, 23, 2), "lon_deg": (24, 26, 0), "lon_min": (28, 31, 2),
        "depth": (32, 36, 2), "mag": (148, 150, 2), "rms": (49, 52, 2), "eh": (86, 89, 2), "ez": (90, 93, 2),
        "id": (137, 146, 0),
    },
}
PICK_COLUMNS = {
    "short": {
        "site4": (4, 4), "component": (98, 98), "p_label": (5, 6), "s_label": (37, 38),
        "p_quality": (8, 8), "s_quality": (40, 40), "minute": (18, 19), "p_sec": (20, 24), "s_sec": (32, 36),
        "p_importance": (83, 86), "s_importance": (87, 90), "network": (99, 100),
    },
    "long": {
        "site4": (4, 4), "component": (12, 12), "p_label": (14, 15), "s_label": (47, 48),
        "p_quality": (17, 17), "s_quality": (50, 50), "minute": (28, 29), "p_sec": (30, 34), "s_sec": (42, 46),
        "p_importance": (101, 104), "s_importance": (105, 108), "network": (6, 7), "hand": (109, 109),
    },
}
# Weight of an assigned quality code; code 4 and above is not used.
QUALITY_WEIGHT = {0: 1.0, 1: 0.5, 2: 0.2, 3: 0.1}
IMPORTANT = 0.5
HAND_TIMED_BEFORE = 1954


def fixed(line, first: int, last: int) -> Column:
    return F.substring(line, first, last - first + 1)


def fixed_number(line, first: int, last: int, decimals: int = 0) -> Column:
    """Number in fixed columns: blanks are zero, a missing point stands before ``decimals`` digits; other text fails the job."""
    text = F.replace(fixed(line, first, last), F.lit(" "), F.lit(""))
    value = F.when(text == "", F.lit(0.0)).otherwise(required(text, "double", "number in fixed columns"))
    return F.when(F.contains(text, F.lit(".")), value).otherwise(value / float(10**decimals))


def degrees(deg, minutes, hemisphere=None, negative: str = "") -> Column:
    """Degrees and minutes to signed degrees; hemispheres listed in ``negative`` turn the sign."""
    value = deg + minutes / 60.0
    if hemisphere is None:
        return value
    return F.when(F.upper(hemisphere).isin(*negative.upper()), -value).otherwise(value)


def station_code(network, site, width: int = 7) -> Column:
    """Network and site code in one padded label."""
    return F.rpad(F.concat(network, site), width, " ")


@dataclass(frozen=True)
class ArchiveRules:
    """``site_vertical``: verticals carry a V as 4th letter of the site instead of component Z."""

    site_vertical: bool = False


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per event with its header ``head`` and pick lines ``body``.

    An event ends at a line that starts with three blanks, so that is the record separator and a file is
    read by many tasks. Shadow lines (``$``) are skipped.
    """
    raw = _ordered(spark.read.option("lineSep", "\n   ").text(path))
    lines = F.filter(F.split("value", "\r?\n"), lambda t: ~F.startswith(t, F.lit("$")))
    # every record but the first of a file begins with the rest of the line that ended the event before
    begins = F.rlike(F.get(lines, F.lit(0)), F.lit("^[0-9][0-9]"))
    lines = F.when(begins, lines).otherwise(F.slice(lines, 2, F.size(lines)))
    return (
        raw.withColumn("_lines", lines)
        .filter(F.size("_lines") > 0)
        .select("src", F.element_at("_lines", 1).alias("head"), F.slice("_lines", 2, F.size("_lines")).alias("body"))
        .filter(F.trim("head") != "")
    )


def _layout(head) -> Column:
    return F.when(fixed(head, 1, 2).isin("19", "20"), "long").otherwise("short")


def _by_layout(head, make) -> Column:
    return F.when(_layout(head) == "long", make("long")).otherwise(make("short"))


def archive_events(records: DataFrame) -> DataFrame:
    """Event headers of the archive."""
    head = F.col("head")

    def value(name: str) -> Column:
        return _by_layout(head, lambda k: fixed_number(head, *HEADER_COLUMNS[k][name]))

    date = value("date").cast("int")
    date = F.when(_layout(head) == "short", date + 19_000_000).otherwise(date)
    return records.select(
        value("id").cast("bigint").alias("id"),
        F.col("src").alias("ord"),
        timefn.from_parts(
            F.floor(date / 10_000).cast("int"), value("mo").cast("int"), value("dy").cast("int"),
            value("hr").cast("int"), value("mi").cast("int"), value("sc"),
        ).alias("origin_time"),
        degrees(value("lat_deg"), value("lat_min")).alias("lat"),
        (-degrees(value("lon_deg"), value("lon_min"))).alias("lon"),
        value("depth").alias("depth_km"), value("mag").alias("mag"),
        value("eh").alias("eh"), value("ez").alias("ez"), value("rms").alias("rms"),
    )


def archive_picks(records: DataFrame, rules: ArchiveRules = ArchiveRules()) -> DataFrame:
    """weighted P picks on vertical and S picks on horizontal components."""
    rows = records.select("head", F.posexplode("body").alias("n", "line")).filter(F.trim("line") != "")
    line, head = F.col("line"), F.col("head")

    def text(name: str) -> Column:
        return _by_layout(head, lambda k: fixed(line, *PICK_COLUMNS[k][name]))

    def number(name: str, decimals: int = 0) -> Column:
        return _by_layout(head, lambda k: fixed_number(line, *PICK_COLUMNS[k][name], decimals))

    def head_number(name: str) -> Column:
        return _by_layout(head, lambda k: fixed_number(head, *HEADER_COLUMNS[k][name]))

    site = F.when(_layout(head) == "long", fixed(line, 1, 5)).otherwise(F.concat(fixed(line, 1, 4), fixed(line, 95, 95)))
    vertical = (text("site4") == "V") if rules.site_vertical else (text("component") == "Z")
    hand = (_layout(head) == "long") & (fixed(line, *PICK_COLUMNS["long"]["hand"]) == "H")
    year = F.when(_layout(head) == "long", fixed(head, 1, 4).try_cast("int")).otherwise(
        F.lit(1900) + fixed(head, 1, 2).try_cast("int")
    )
    kept = rows.filter(~(hand & (year < HAND_TIMED_BEFORE)))

    weight_of = F.create_map(*[F.lit(x) for item in QUALITY_WEIGHT.items() for x in item])

    def phase(name: str, low: str, on_component: Column) -> Column:
        quality = number(f"{low}_quality").cast("int")
        plain = F.try_element_at(weight_of, quality)
        weight = F.when(number(f"{low}_importance", 3) >= IMPORTANT, -plain).otherwise(plain)
        tt = timefn.travel_time_over_hour(
            number("minute"), number(f"{low}_sec", 2), head_number("mi"), head_number("sc")
        )
        valid = (quality < 4) & (F.trim(text(f"{low}_label")) != "") & on_component
        return F.when(valid, F.struct(F.lit(name).alias("phase"), tt.alias("tt"), weight.alias("weight")))

    return (
        kept.select(
            head_number("id").cast("bigint").alias("id"),
            F.col("n").cast("bigint").alias("n"),
            F.trim(station_code(text("network"), site)).alias("sta"),
            F.explode(F.array_compact(F.array(phase("P", "p", vertical), phase("S", "s", ~vertical)))).alias("p"),
        )
        .select("id", (F.col("n") * 2 + (F.col("p.phase") == "S").cast("int")).alias("seq"), "sta", "p.phase", "p.tt", "p.weight")
    )


def read_station_archive(spark: SparkSession, path: str) -> DataFrame:
    """Fixed-column station list; T6 and T7 give label and signed degrees."""
    line = F.col("value")
    raw = _ordered(spark.read.text(path))
    return raw.select(
        "src",
        station_code(fixed(line, 7, 8), fixed(line, 1, 5)).alias("sta"),
        degrees(fixed_number(line, 16, 17), fixed_number(line, 19, 25, 4), fixed(line, 26, 26), "S").alias("lat"),
        (-degrees(fixed_number(line, 27, 29), fixed_number(line, 31, 37, 4), fixed(line, 38, 38), "E")).alias("lon"),
    )
