"""The two map projections of the pipeline, and distances, as Column expressions.

Formulas follow Snyder, *Map Projections: A Working Manual* (1987).  Each
formula is written once: ``m`` is either ``pyspark.sql.functions`` (columns) or
``math`` (plain numbers, used for the handful of values that describe a grid).
Latitudes pass between sphere and ellipsoid unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PolarStereographic:
    """North polar stereographic projection of a sphere, true to scale at ``lat_ts``."""

    radius: float
    lon_0: float
    lat_ts: float

    @property
    def _scale(self) -> float:
        return self.radius * (1.0 + math.sin(math.radians(self.lat_ts)))

    @property
    def name(self) -> str:
        return (
            f"+proj=stere +units=m +a={self.radius} +b={self.radius} "
            f"+lat_0=90.0 +lon_0={self.lon_0:g} +lat_ts={self.lat_ts:g}"
        )

    def forward(self, lon, lat, m=F):
        """Longitude and latitude in degrees to metres in the plane."""
        rho = self._scale * m.tan(math.pi / 4 - m.radians(lat) / 2)
        angle = m.radians(lon - self.lon_0)
        return rho * m.sin(angle), -rho * m.cos(angle)

    def inverse(self, x, y, m=F):
        """Metres in the plane to longitude and latitude in degrees."""
        lat = 90.0 - m.degrees(2 * m.atan(m.sqrt(x * x + y * y) / self._scale))
        return self.lon_0 + m.degrees(m.atan2(x, -y)), lat


def _wrap(degrees):
    """An angle brought to [-180, 180); works for columns and for numbers."""
    if isinstance(degrees, Column):
        return F.pmod(degrees + 180.0, F.lit(360.0)) - 180.0
    return (degrees + 180.0) % 360.0 - 180.0


@dataclass(frozen=True)
class AlbersEqualArea:
    """Albers equal-area conic projection of an ellipsoid (semi-major axis ``a``, squared eccentricity ``e2``)."""

    name: str
    a: float
    e2: float
    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float

    def _q(self, sin_lat, m):
        e = math.sqrt(self.e2)
        es = e * sin_lat
        return (1 - self.e2) * (sin_lat / (1 - es * es) - m.log((1 - es) / (1 + es)) / (2 * e))

    def _cone(self) -> tuple[float, float, float]:
        """The constants n, C and rho at the origin latitude."""

        def scale(lat: float) -> float:
            return math.cos(math.radians(lat)) / math.sqrt(1 - self.e2 * math.sin(math.radians(lat)) ** 2)

        q0, q1, q2 = (self._q(math.sin(math.radians(lat)), math) for lat in (self.lat_0, self.lat_1, self.lat_2))
        n = (scale(self.lat_1) ** 2 - scale(self.lat_2) ** 2) / (q2 - q1)
        c = scale(self.lat_1) ** 2 + n * q1
        return n, c, self.a * math.sqrt(c - n * q0) / n

    def forward(self, lon, lat, m=F):
        """Longitude and latitude in degrees to metres in the plane."""
        n, c, rho_0 = self._cone()
        rho = self.a * m.sqrt(c - n * self._q(m.sin(m.radians(lat)), m)) / n
        theta = m.radians(n * _wrap(lon - self.lon_0))
        return rho * m.sin(theta), rho_0 - rho * m.cos(theta)

    def inverse(self, x, y, m=F):
        """Metres in the plane to longitude and latitude in degrees (series in the authalic latitude)."""
        n, c, rho_0 = self._cone()
        e2 = self.e2
        rise = rho_0 - y
        q = (c - (x * x + rise * rise) * (n / self.a) ** 2) / n
        beta = m.asin(q / self._q(1.0, math))
        lat = (
            beta
            + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * m.sin(2 * beta)
            + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * m.sin(4 * beta)
            + (761 * e2**3 / 45360) * m.sin(6 * beta)
        )
        return _wrap(self.lon_0 + m.degrees(m.atan2(x, rise)) / n), m.degrees(lat)


# The plane of the hourly model grid.
SOURCE_PLANE = PolarStereographic(radius=6370000.0, lon_0=-152.0, lat_ts=64.0)

# Alaska Albers on the GRS80 ellipsoid, as published in the EPSG registry.
ALASKA_ALBERS = AlbersEqualArea(
    name="EPSG:3338",
    a=6378137.0,
    e2=0.006694380022900787,
    lat_1=55.0,
    lat_2=65.0,
    lat_0=50.0,
    lon_0=-154.0,
)


def planar_km(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Straight-line distance between two points of the plane: metres in, kilometres out, 3 decimals."""
    return F.bround(F.hypot(x2 - x1, y2 - y1) / 1000.0, 3)


def sphere_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = 6370.0) -> Column:
    """Great-circle distance on the model's sphere in kilometres, 3 decimals."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.bround(2 * radius_km * F.asin(F.least(F.lit(1.0), F.sqrt(h))), 3)
