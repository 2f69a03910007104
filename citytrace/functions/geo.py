"""Great-circle distance and the inverse of a two-parallel Lambert conformal projection."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
MILES_PER_KM = 0.621371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle kilometres in the two-argument arctangent form."""
    half_lat = F.radians(lat2 - lat1) / 2.0
    half_lon = F.radians(lon2 - lon1) / 2.0
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_lon) * F.sin(half_lon)
    return F.atan2(F.sqrt(chord), F.sqrt(1.0 - chord)) * (2.0 * EARTH_RADIUS_KM)


def km_to_miles(km: Column) -> Column:
    return km * MILES_PER_KM


@dataclass(frozen=True)
class ConicProjection:
    """Two-parallel Lambert conformal conic.

    Fixed values of the Long Island state plane zone (NAD83, US survey feet).
    """

    semi_major_m: float = 6378137.0
    inverse_flattening: float = 298.257222101
    central_meridian: float = -74.0
    origin_latitude: float = 40.1666666666667
    parallel_1: float = 41.0333333333333
    parallel_2: float = 40.6666666666667
    false_easting: float = 984250.0
    false_northing: float = 0.0
    unit_m: float = 0.304800609601219

    @property
    def eccentricity(self) -> float:
        flattening = 1.0 / self.inverse_flattening
        return math.sqrt(2.0 * flattening - flattening * flattening)

    def _m(self, degrees: float) -> float:
        phi = math.radians(degrees)
        return math.cos(phi) / math.sqrt(1.0 - (self.eccentricity * math.sin(phi)) ** 2)

    def _t(self, degrees: float) -> float:
        phi, e = math.radians(degrees), self.eccentricity
        shrink = ((1.0 - e * math.sin(phi)) / (1.0 + e * math.sin(phi))) ** (e / 2.0)
        return math.tan(math.pi / 4.0 - phi / 2.0) / shrink

    @property
    def cone(self) -> float:
        return (math.log(self._m(self.parallel_1)) - math.log(self._m(self.parallel_2))) / (
            math.log(self._t(self.parallel_1)) - math.log(self._t(self.parallel_2))
        )

    @property
    def scale(self) -> float:
        return self._m(self.parallel_1) / (self.cone * self._t(self.parallel_1) ** self.cone)

    def radius(self, degrees: float) -> float:
        return self.semi_major_m * self.scale * self._t(degrees) ** self.cone

    def forward(self, lat: float, long: float) -> tuple[float, float]:
        """Map units of one coordinate, for fixtures."""
        r, r0 = self.radius(lat), self.radius(self.origin_latitude)
        theta = self.cone * math.radians(long - self.central_meridian)
        east = r * math.sin(theta) / self.unit_m + self.false_easting
        north = (r0 - r * math.cos(theta)) / self.unit_m + self.false_northing
        return east, north

    def inverse(self, x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
        """(lat, long) columns of map coordinates; the latitude series settles within six rounds."""
        e, n = self.eccentricity, self.cone
        east = (x - self.false_easting) * self.unit_m
        north = F.lit(self.radius(self.origin_latitude)) - (y - self.false_northing) * self.unit_m
        r = F.sqrt(east * east + north * north)
        t = F.pow(r / (self.semi_major_m * self.scale), F.lit(1.0 / n))
        phi = F.lit(math.pi / 2.0) - F.atan(t) * 2.0
        for _ in range(rounds):
            sine = F.sin(phi) * e
            phi = F.lit(math.pi / 2.0) - F.atan(t * F.pow((1.0 - sine) / (1.0 + sine), F.lit(e / 2.0))) * 2.0
        return F.degrees(phi), F.degrees(F.atan2(east, north) / n) + self.central_meridian
