"""Residuals and weights of links."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.params import IterationParams
from quakespark.session import checkpointed

# MAD of Gaussian noise, and the weight below which residuals are not weighted.
MAD_SCALE = 0.67449
NEGLIGIBLE_WEIGHT = 1e-6



def is_cc() -> Column:
    return F.col("idx") <= 2


def is_p() -> Column:
    return F.col("idx").isin(1, 3)


def with_travel_times(links: DataFrame, tt: DataFrame) -> DataFrame:
    """Travel time and derivatives of the link's phase at its station for both events."""
    names = {"p": ("tt_p", "px", "py", "pz"), "s": ("tt_s", "sx", "sy", "sz")}

    def side(n: int) -> DataFrame:
        both = [F.col(c).alias(f"_{c}{n}") for phase in names.values() for c in phase]
        return tt.select("sta", F.col("id").alias(f"id{n}"), *both)

    def ray(n: int) -> Column:
        # number by number, so that what nobody reads is not carried through the joins
        parts = zip(("tt", "x", "y", "z"), *names.values(), strict=True)
        return F.struct(*[F.when(is_p(), F.col(f"_{p}{n}")).otherwise(F.col(f"_{s}{n}")).alias(c) for c, p, s in parts])

    for n in (1, 2):
        given = links.columns
        links = links.join(side(n), ["sta", f"id{n}"]).select(*given, ray(n).alias(f"ray{n}"))
    return links


def residuals(links: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Observed minus calculated differential time in s; ``sources`` carries time shifts t in ms."""
    calc = F.col("ray1.tt") - F.col("ray2.tt")
    if sources is None:
        return links.withColumn("res", F.col("dt") - calc)
    for n in (1, 2):
        links = links.join(sources.select(F.col("id").alias(f"id{n}"), F.col("t").alias(f"_t{n}")), f"id{n}")
    calc = calc - (F.col("_t1") - F.col("_t2")) / 1000.0
    return links.withColumn("res", F.col("dt") - calc).drop("_t1", "_t2")


def as_struct(p: IterationParams) -> Column:
    """A row of the schedule as a column; limits that are not active are NULL."""
    return F.struct(*[F.lit(v).cast("double").alias(n) for n, v in asdict(p).items() if n != "last"])


def prior_weight(p: IterationParams | Column) -> Column:
    """R2: type weight times quality; ``p`` is a row of the schedule, or a column of such rows."""
    p = as_struct(p) if isinstance(p, IterationParams) else p
    return F.element_at(F.array(*[p[n] for n in ("w_ccp", "w_ccs", "w_ctp", "w_cts")]), F.col("idx")) * F.col("qual")


def distance_factor(offset_m: Column, p: IterationParams | Column) -> Column:
    """Weight by separation, fifth powers for correlation and cubes for catalog links."""
    p = as_struct(p) if isinstance(p, IterationParams) else p

    def factor(limit_km: Column, power: float) -> Column:
        near = F.pow(1.0 - F.pow(offset_m / (limit_km * 1000.0), F.lit(power)), F.lit(power))
        return F.when(limit_km.isNull(), 1.0).otherwise(near)

    return F.when(is_cc(), factor(p["dist_cc"], 5.0)).otherwise(factor(p["dist_ct"], 3.0))


def residual_factor(cutoff: Column) -> Column:
    """Weight by residual; negative beyond the cutoff."""
    return F.pow(1.0 - F.pow(F.abs(F.col("res")) / cutoff, F.lit(3.0)), F.lit(3.0))


# ---------------------------------------------------------------------------------------------
# Median and MAD


def exact_median(df: DataFrame, keys: list[str], value: str, name: str, accuracy: int = 10000, few: bool = False) -> DataFrame:
    """Exact median per group for groups of any size; ``few`` groups are broadcast, so that ``df`` is not shuffled.

    A bounded sketch brackets the median, the values below the bracket are only counted, and the ranks
    are found among the few distinct values inside it. A bracket that misses fails the job.
    """
    low, high = 0.5 - 2.0 / accuracy, 0.5 + 2.0 / accuracy
    cuts = F.percentile_approx(value, F.array(F.lit(low), F.lit(high)), F.lit(accuracy))
    bracket = df.groupBy(*keys).agg(cuts.alias("_q"), F.count(value).alias("_n"))
    placed = df.filter(F.col(value).isNotNull()).join(F.broadcast(bracket) if few else bracket, keys)
    at = (
        placed.filter(F.col(value) <= F.col("_q")[1])
        .withColumn("_v", F.when(F.col(value) >= F.col("_q")[0], F.col(value)))
        .groupBy(*keys, "_v")
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    )
    upto = W.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    ranked = at.withColumn("_to", F.sum("_c").over(upto)).withColumn("_from", F.col("_to") - F.col("_c"))
    lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("_from") < rank) & (rank <= F.col("_to")), F.col("_v")))

    found = ranked.groupBy(*keys).agg(at_rank(lower).alias("_lo"), at_rank(upper).alias("_hi"))
    middle = (F.col("_lo") + F.col("_hi")) / 2
    checked = F.coalesce(middle, F.raise_error(F.lit("median bracket missed")).cast("double"))
    return found.select(*keys, checked.alias(name))


def spreads(links: DataFrame, keys: list[str]) -> DataFrame:
    """Median and scaled MAD of the residuals, separately for correlation and catalog links."""
    typed = links.select(*keys, is_cc().alias("cc"), "res")
    by = [*keys, "cc"]
    few = not keys      # two groups; a shuffle by them would deal all links to two tasks
    med = exact_median(typed, by, "res", "med", few=few)
    dev = typed.join(F.broadcast(med) if few else med, by).withColumn("dev", F.abs(F.col("res") - F.col("med")))
    mad = exact_median(dev, by, "dev", "mad", few=few).withColumn("mad", F.col("mad") / MAD_SCALE)
    return med.join(mad, by)


def needs_spread(p: IterationParams) -> bool:
    """Whether a residual cutoff is a multiple of the MAD (limits of 1 and more)."""
    return any(c is not None and c >= 1 for c in (p.res_cc, p.res_ct))


def weights(links: DataFrame, p: IterationParams | Column, keys: list[str] | None = None, spread: bool | None = None) -> DataFrame:
    """Column ``wt``. Needs idx, qual, res and offs_m.

    ``p`` is a row of the schedule, or a column that holds the row valid for each link; ``spread`` then says whether
    any cutoff among them is a multiple of the MAD.
    """
    keys = keys or []
    if isinstance(p, IterationParams):
        p, spread = as_struct(p), needs_spread(p)
    if spread:
        links = checkpointed(links)     # read for the medians, the deviations and the weights
    wt = links.withColumn("wt", prior_weight(p) * distance_factor(F.col("offs_m"), p))
    if spread:
        by_type = spreads(links, keys).select(*keys, F.col("cc").alias("_cc"), "mad")
        if not keys:
            by_type = F.broadcast(checkpointed(by_type))     # two rows, found once
        for k in keys:
            by_type = by_type.withColumnRenamed(k, f"_{k}")
        condition = is_cc().eqNullSafe(F.col("_cc"))
        for k in keys:
            condition = condition & (F.col(k) == F.col(f"_{k}"))
        wt = wt.join(by_type, condition).drop("_cc", *[f"_{k}" for k in keys])
    else:
        wt = wt.withColumn("mad", F.lit(None).cast("double"))
    limit = F.when(is_cc(), p["res_cc"]).otherwise(p["res_ct"])
    cut = F.when(limit >= 1, limit * F.col("mad")).when(limit > 0, limit)
    apply = (F.col("wt") > NEGLIGIBLE_WEIGHT) & cut.isNotNull()
    return wt.withColumn("wt", F.when(apply, F.col("wt") * residual_factor(cut)).otherwise(F.col("wt"))).drop("mad")


def zero_air_quakes(links: DataFrame, air: DataFrame) -> DataFrame:
    """Links that touch an air quake get weight 0."""
    marks = air.select("id").distinct()
    for n in (1, 2):
        links = links.join(marks.select(F.col("id").alias(f"id{n}"), F.lit(True).alias(f"_air{n}")), f"id{n}", "left")
    hit = F.coalesce("_air1", F.lit(False)) | F.coalesce("_air2", F.lit(False))
    return links.withColumn("wt", F.when(hit, 0.0).otherwise(F.col("wt"))).drop("_air1", "_air2")


def usable_links(links: DataFrame, min_weight: float = 1e-5) -> DataFrame:
    """links with at least the minimum weight."""
    return links.filter(F.col("wt") >= min_weight)
