"""Intermediate tables shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakespark.operators import links as lnk
from quakespark.operators import pairing, prepare, raytrace, weights
from quakespark.params import IterationParams, LinkParams
from quakespark.registry.core import PAIRING, Tables
from quakespark.session import checkpointed

# Constant-speed model of the checks, and the weights of one iteration.
VP, VS = 6.0, 6.0 / 1.73
STRAIGHT = [(1, 0.0, VP, VS)]
STEP = IterationParams(
    last=1, w_ccp=1.0, w_ccs=0.5, w_ctp=0.8, w_cts=0.4, res_cc=6.0, res_ct=0.05, dist_cc=30.0, dist_ct=6.0, damp=20.0)


def used_picks(t: Tables) -> DataFrame:
    return pairing.first_picks(pairing.usable_picks(t("v_pick"), PAIRING.min_weight))


def chosen_events(t: Tables) -> DataFrame:
    return pairing.select_events(t("v_event"), pairing.usable_picks(t("v_pick"), PAIRING.min_weight), PAIRING.min_obs)


def matched(t: Tables) -> DataFrame:
    chosen, first = pairing.pairing_inputs(t("v_event"), t("v_pick"), PAIRING)
    return pairing.match_picks(pairing.candidate_pairs(chosen, PAIRING.max_sep), first, t("v_station"), PAIRING.max_dist)


def matched_in_place(t: Tables, max_dist: float = PAIRING.max_dist) -> DataFrame:
    """The same rows, formed where events meet with their picks; for queries that return every pair."""
    chosen, first = pairing.pairing_inputs(t("v_event"), t("v_pick"), PAIRING)
    return pairing.candidate_links(chosen, first, t("v_station"), PAIRING.max_sep, max_dist)


def linked_pairs(t: Tables) -> DataFrame:
    chosen, first = pairing.pairing_inputs(t("v_event"), t("v_pick"), PAIRING)
    return pairing.linked_pairs(chosen, first, t("v_station"), PAIRING)


def catalog_links(t: Tables) -> DataFrame:
    return pairing.differential_times(t("v_event"), t("v_pick"), t("v_station"), PAIRING)


def own_ids(t: Tables) -> DataFrame:
    return t("v_event").select(F.col("id").cast("string").alias("original_id"), F.col("id").alias("synthetic_id"))


def correlation_links(t: Tables, min_cc: float = 0.0) -> DataFrame:
    return prepare.correlation_links(t("v_detection"), own_ids(t), min_cc)


def all_links(t: Tables) -> DataFrame:
    """v_link: correlation and catalog links in one table, written once because most queries read it several times."""
    return t.once("v_link", lambda: checkpointed(lnk.one_table(correlation_links(t), catalog_links(t))))


def with_offsets(t: Tables, links: DataFrame) -> DataFrame:
    return lnk.with_separation(links, t("v_event")).withColumn("offs_m", F.col("sep_km") * 1000.0)


def rays(t: Tables, links: DataFrame) -> DataFrame:
    paths = raytrace.path_geometry(raytrace.used_paths(links), t("v_event"), t("v_station"))
    return raytrace.straight_rays(paths, VP, VS)


def residual_links(t: Tables) -> DataFrame:
    links = with_offsets(t, all_links(t))
    return weights.residuals(weights.with_travel_times(links, rays(t, links)))


def weighted_links(t: Tables, rays: bool = False) -> DataFrame:
    """Links with residuals and weights; with ``rays`` also the rays that residuals were formed from."""
    links = residual_links(t)
    return weights.weights(links if rays else links.drop("ray1", "ray2"), STEP, [])   # formed from a written table


LOADER = LinkParams(
    max_station_dist=90.0, min_pair_dist=5.0, max_pair_dist=80.0, max_gap=250.0, max_sep_cc=8.0, max_sep_ct=4.5)
