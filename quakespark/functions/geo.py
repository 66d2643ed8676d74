"""Geodesy as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEG_PAIRING = 111.1949266
KM_PER_DEG_LOADER = 111.0

# Geocentric distance constants and the three earth-radius rules.
HALF_PI = 1.570796
RAD_PER_DEG = 1.745329e-02
GEOCENTRIC_FACTOR = 0.993231


@dataclass(frozen=True)
class RadiusRule:
    equatorial: float
    flattening: float
    offset: float


RADIUS_RULES = {
    "pairing": RadiusRule(6378.163, 3.35278e-3, 1.0 / 3.0),
    "stations": RadiusRule(6371.227, 3.37853e-3, 0.0),
    "rays": RadiusRule(6378.140, 3.37853e-3, 0.0),
}

# Ellipsoid of the local frame (WGS72).
FRAME_RAD = 0.017453292
FRAME_RADIUS = 6378.135
FRAME_FLATTENING = 298.26
# Origin used when no origin is given (latitude north, longitude).
DEFAULT_ORIGIN = (46.95240, -7.439583)


def _c(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


def separation_km(lat1, lon1, dep1, lat2, lon2, dep2, km_per_deg: float = KM_PER_DEG_PAIRING) -> Column:
    """G1: distance of two hypocentres on the plane tangent at the first one."""
    lat1, lon1, dep1, lat2, lon2, dep2 = map(_c, (lat1, lon1, dep1, lat2, lon2, dep2))
    north = (lat1 - lat2) * km_per_deg
    east = (lon1 - lon2) * F.cos(F.radians(lat1)) * km_per_deg
    down = dep1 - dep2
    return F.sqrt(north * north + east * east + down * down)


def _colatitude(lat: Column) -> Column:
    return HALF_PI - F.atan(GEOCENTRIC_FACTOR * F.tan(lat * RAD_PER_DEG))


def central_angle(lat1, lon1, lat2, lon2) -> Column:
    """Angle between two points in radians, on geocentric latitudes."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a, b = _colatitude(lat1), _colatitude(lat2)
    dlon = (lon2 - lon1) * RAD_PER_DEG
    cosine = F.sin(a) * F.sin(b) * F.cos(dlon) + F.cos(a) * F.cos(b)
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def distance_km(lat1, lon1, lat2, lon2, variant: str = "pairing") -> Column:
    """Distance in km with the earth radius of ``variant``."""
    rule = RADIUS_RULES[variant]
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    mean_colatitude = HALF_PI - (lat1 + lat2) * (RAD_PER_DEG / 2)
    cosine = F.cos(mean_colatitude)
    radius = rule.equatorial * (1.0 + rule.flattening * (rule.offset - cosine * cosine))
    return central_angle(lat1, lon1, lat2, lon2) * radius


def azimuth_deg(lat1, lon1, lat2, lon2) -> Column:
    """Azimuth from the first to the second point, clockwise from north, in [0, 360)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a, b = _colatitude(lat1), _colatitude(lat2)
    dlon = (lon2 - lon1) * RAD_PER_DEG
    angle = F.atan2(F.sin(dlon), F.sin(a) / F.tan(b) - F.cos(a) * F.cos(dlon)) / RAD_PER_DEG
    return F.when(angle < 0, angle + 360.0).otherwise(angle)


class LocalFrame:
    """Short-distance conversion around an origin: x east, y north, in km."""

    def __init__(self, origin_lat, origin_lon, rotation_deg: float = 0.0):
        self.lat0, self.lon0 = _c(origin_lat), _c(origin_lon)
        unset = (self.lat0 == 0) & (self.lon0 == 0)
        self.lat0, self.lon0 = (
            F.when(unset, F.lit(DEFAULT_ORIGIN[0])).otherwise(self.lat0),
            F.when(unset, F.lit(DEFAULT_ORIGIN[1])).otherwise(self.lon0),
        )
        self.rotation = 0.0 if rotation_deg is None else float(rotation_deg)
        phi = self.lat0 * FRAME_RAD
        self.ratio = F.tan(phi - F.sin(phi * 2) / FRAME_FLATTENING) / F.tan(phi)
        here = self._geocentric(self.lat0)
        radius = FRAME_RADIUS * (1.0 - F.sin(here) * F.sin(here) / FRAME_FLATTENING)
        minute = F.acos(
            F.sin(here) * F.sin(here) + F.cos(F.lit(FRAME_RAD / 60.0)) * F.cos(here) * F.cos(here)
        )
        self.km_per_min_lat = radius * (self._geocentric(self.lat0 + 1.0 / 60.0) - here)
        self.km_per_min_lon = radius * minute / F.cos(here)
        self.here = here

    def _geocentric(self, lat: Column) -> Column:
        return F.atan(self.ratio * F.tan(lat * FRAME_RAD))

    def _rotation(self) -> tuple[Column, Column]:
        angle = self.rotation * FRAME_RAD
        return F.cos(F.lit(angle)), F.sin(F.lit(angle))

    def to_local(self, lat, lon) -> tuple[Column, Column]:
        """(x, y) in km."""
        lat, lon = _c(lat), _c(lon)
        middle = (self._geocentric(lat) + self.here) / 2
        north = (lat - self.lat0) * 60.0 * self.km_per_min_lat
        east = (lon - self.lon0) * 60.0 * self.km_per_min_lon * F.cos(middle)
        if self.rotation == 0.0:
            return east, north
        return rotate_axes(east, north, self.rotation)

    def to_geographic(self, x, y) -> tuple[Column, Column]:
        """(lat, lon) of local coordinates in km."""
        x, y = _c(x), _c(y)
        if self.rotation != 0.0:
            x, y = rotate_axes(x, y, -self.rotation)
        lat = self.lat0 + y / self.km_per_min_lat / 60.0
        middle = (self._geocentric(lat) + self.here) / 2
        lon = self.lon0 + x / (self.km_per_min_lon * F.cos(middle)) / 60.0
        return lat, lon


def rotate_axes(x, y, degrees: float) -> tuple[Column, Column]:
    """Coordinates in axes turned anticlockwise by ``degrees``."""
    x, y = _c(x), _c(y)
    angle = F.lit(float(degrees) * FRAME_RAD)
    return F.cos(angle) * x - F.sin(angle) * y, F.cos(angle) * y + F.sin(angle) * x


def rotate_points(x, y, radians: float) -> tuple[Column, Column]:
    """Points turned anticlockwise by ``radians`` about the origin."""
    x, y = _c(x), _c(y)
    c, s = F.cos(F.lit(float(radians))), F.sin(F.lit(float(radians)))
    return x * c - y * s, x * s + y * c


def difference_m(lat1, lon1, dep1, lat2, lon2, dep2) -> dict[str, Column]:
    """North, east and depth differences and their norms in metres."""
    lat1, lon1, dep1, lat2, lon2, dep2 = map(_c, (lat1, lon1, dep1, lat2, lon2, dep2))
    metres = KM_PER_DEG_LOADER * 1000.0
    dlat = (lat2 - lat1) * metres
    dlon = (lon2 - lon1) * metres * F.cos(F.radians(lat1))
    ddep = (dep2 - dep1) * 1000.0
    return {
        "dlat_m": dlat,
        "dlon_m": dlon,
        "ddepth_m": ddep,
        "horizontal_m": F.sqrt(dlat * dlat + dlon * dlon),
        "total_m": F.sqrt(dlat * dlat + dlon * dlon + ddep * ddep),
    }


def profile_coordinates(x, y, strike_deg: float, x0: float = 0.0, y0: float = 0.0) -> tuple[Column, Column]:
    """(along, across) coordinates of a profile through (x0, y0) with the given strike."""
    x, y = _c(x) - x0, _c(y) - y0
    along_angle = F.radians(F.lit(float(strike_deg) - 90.0))
    across_angle = F.radians(F.lit(float(strike_deg) - 180.0))
    along = x * F.cos(along_angle) - y * F.sin(along_angle)
    across = x * F.cos(across_angle) - y * F.sin(across_angle)
    return along, across


def source_radius_m(magnitude, stress_drop_bar: float = 30.0) -> Column:
    """Radius of a circular constant-stress-drop source."""
    moment = F.pow(F.lit(10.0), 1.5 * _c(magnitude) + 16.0)
    return F.pow(7.0 * moment / (16.0e6 * float(stress_drop_bar)), F.lit(1.0 / 3.0)) / 100.0
