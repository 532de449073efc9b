"""Map projections and geometry measures as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: GRS80, the national metric grid (2180), the European equal-area grid (3035), the spherical map radius
A, FLAT = 6378137.0, 1 / 298.257222101
LON0, K0, FE, FN = 19.0, 0.9993, 500000.0, -5300000.0
LAEA_LAT, LAEA_LON, LAEA_FE, LAEA_FN = 52.0, 10.0, 4321000.0, 3210000.0

N = FLAT / (2 - FLAT)
E2 = FLAT * (2 - FLAT)
E1 = math.sqrt(E2)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = [
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
]
BETA = [N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280]
DELTA = [
    2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45,
    7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45,
    56 * N**3 / 15 - 136 * N**4 / 35,
    4279 * N**4 / 630,
]


def _series(weights: list[float], one) -> Column:
    total = F.lit(0.0)
    for j, w in enumerate(weights, 1):
        total = total + w * one(2 * j)
    return total


def to_metric(lat: Column, lon: Column) -> tuple[Column, Column]:
    """WGS84 degrees to easting and northing in metres (Krüger's series)."""
    phi, lam = F.radians(lat), F.radians(lon - LON0)
    t = F.sinh(F.atanh(F.sin(phi)) - E1 * F.atanh(E1 * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = FE + K0 * RADIUS * (eta + _series(ALPHA, lambda k: F.cos(k * xi) * F.sinh(k * eta)))
    north = FN + K0 * RADIUS * (xi + _series(ALPHA, lambda k: F.sin(k * xi) * F.cosh(k * eta)))
    return east, north


def to_degrees(east: Column, north: Column) -> tuple[Column, Column]:
    """Metres back to latitude and longitude."""
    x, y = (north - FN) / (K0 * RADIUS), (east - FE) / (K0 * RADIUS)
    xi = x - _series(BETA, lambda k: F.sin(k * x) * F.cosh(k * y))
    eta = y - _series(BETA, lambda k: F.cos(k * x) * F.sinh(k * y))
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    return F.degrees(chi + _series(DELTA, lambda k: F.sin(k * chi))), LON0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))


def _authalic(sine):
    """q of the authalic latitude; works on numbers and columns."""
    if isinstance(sine, Column):
        return (1 - E2) * (sine / (1 - E2 * sine * sine) - F.log((1 - E1 * sine) / (1 + E1 * sine)) / (2 * E1))
    return (1 - E2) * (sine / (1 - E2 * sine * sine) - math.log((1 - E1 * sine) / (1 + E1 * sine)) / (2 * E1))


QP = _authalic(1.0)
RQ = A * math.sqrt(QP / 2)
_S1 = math.sin(math.radians(LAEA_LAT))
BETA1 = math.asin(_authalic(_S1) / QP)
D1 = A * math.cos(math.radians(LAEA_LAT)) / math.sqrt(1 - E2 * _S1 * _S1) / (RQ * math.cos(BETA1))


def to_equal_area(lat: Column, lon: Column) -> tuple[Column, Column]:
    """WGS84 degrees to the Lambert azimuthal equal-area grid."""
    beta, lam = F.asin(_authalic(F.sin(F.radians(lat))) / QP), F.radians(lon - LAEA_LON)
    b = RQ * F.sqrt(2 / (1 + math.sin(BETA1) * F.sin(beta) + math.cos(BETA1) * F.cos(beta) * F.cos(lam)))
    x = LAEA_FE + b * D1 * F.cos(beta) * F.sin(lam)
    y = LAEA_FN + b / D1 * (math.cos(BETA1) * F.sin(beta) - math.sin(BETA1) * F.cos(beta) * F.cos(lam))
    return x, y


def metric_to_equal_area(east: Column, north: Column) -> tuple[Column, Column]:
    return to_equal_area(*to_degrees(east, north))


def web_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Spherical Mercator metres to latitude and longitude."""
    return F.degrees(2 * F.atan(F.exp(y / A)) - math.pi / 2), F.degrees(x / A)


def web_to_metric(x: Column, y: Column) -> tuple[Column, Column]:
    return to_metric(*web_to_degrees(x, y))


def ring_area(ring: Column) -> Column:
    """Shoelace area of a closed ring of (x, y)."""
    n = F.size(ring)
    pairs = F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)) / 2


def line_length(line: Column) -> Column:
    n = F.size(line)
    parts = F.zip_with(F.slice(line, F.lit(1), n - 1), F.slice(line, F.lit(2), n - 1), lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))
    return F.aggregate(parts, F.lit(0.0), lambda s, v: s + v)


def box_distance(x: Column, y: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """Distance of a point from a box, 0 inside."""
    dx = F.greatest(xmin - x, F.lit(0), x - xmax)
    dy = F.greatest(ymin - y, F.lit(0), y - ymax)
    return F.sqrt((dx * dx + dy * dy).cast("double"))
