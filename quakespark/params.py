"""Parameter sets of pairing, link loading and relocation."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PairParams:
    """Pairing limits. Distances in km, weights as in the pick table."""

    min_weight: float = 0.0
    max_dist: float = 200.0
    max_sep: float = 10.0
    max_neighbours: int = 10
    min_links: int = 8
    min_obs: int = 8
    max_obs: int = 50
    km_per_deg: float = 111.1949266


@dataclass(frozen=True)
class LinkParams:
    """Limits of the link loader; ``None`` means not active."""

    data: str = "both"          # 'cc', 'ct' or 'both'
    phases: str = "both"        # 'P', 'S' or 'both'
    max_station_dist: float = 200.0
    min_pair_dist: float | None = None
    max_pair_dist: float | None = None
    max_gap: float | None = None
    max_sep_cc: float | None = None
    max_sep_ct: float | None = None
    straight_rays: bool = False
    km_per_deg: float = 111.0
    limit_catalog: bool = True  # before clusters are known, keep to stations near the mean of all epicentres, as stored runs did


@dataclass(frozen=True)
class IterationParams:
    """One row of the relocation schedule; ``last`` is the last iteration it is valid for."""

    last: int
    w_ccp: float = 1.0
    w_ccs: float = 0.5
    w_ctp: float = 1.0
    w_cts: float = 0.5
    res_cc: float | None = None
    res_ct: float | None = None
    dist_cc: float | None = None
    dist_ct: float | None = None
    damp: float = 0.0

    @property
    def reweights(self) -> bool:
        return any(v is not None for v in (self.res_cc, self.res_ct, self.dist_cc, self.dist_ct))


@dataclass(frozen=True)
class RelocationParams:
    """A whole relocation run."""

    schedule: tuple[IterationParams, ...] = field(default_factory=lambda: (IterationParams(last=1),))
    start: str = "catalog"            # 'catalog' or 'centroid'
    min_cc: int = 0
    min_ct: int = 0
    remove_air_quakes: bool = True
    cluster: int | None = None
    min_weight: float = 1e-5
    mode: str = "layered"             # 'layered', 'straight' or 'station'
    errors: bool = True               # probe the errors of clusters of several solver blocks in last steps

    @property
    def n_iterations(self) -> int:
        return self.schedule[-1].last


def params_for(schedule, iteration: int):
    """The schedule row valid for ``iteration`` (step function of the iteration number)."""
    for row in schedule:
        if iteration <= row.last:
            return row
    return schedule[-1]
