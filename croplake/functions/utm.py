"""Transverse Mercator and polar stereographic formulas on WGS 84 (Krüger series, n to the 4th).

The formulas take ``m``, the module of elementary functions, so the same text serves Column
expressions (``pyspark.sql.functions``) and numpy arrays (:class:`NumpyMath`).
"""

from __future__ import annotations

import math

import numpy as np

# ---- fixed values: ellipsoid, projection constants, series coefficients ----------------------
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
POLAR_SCALE = 0.994
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0
POLAR_FALSE = 2000000.0
_N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = 2 * math.sqrt(_N) / (1 + _N)
RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)
POLAR_RADIUS = (
    2 * SEMI_MAJOR * POLAR_SCALE
    / math.sqrt((1 + ECCENTRICITY) ** (1 + ECCENTRICITY) * (1 - ECCENTRICITY) ** (1 - ECCENTRICITY))
)
# ---------------------------------------------------------------------------------------------


class NumpyMath:
    sin, cos, sinh, cosh = np.sin, np.cos, np.sinh, np.cosh
    atanh, atan2, asin, sqrt = np.arctanh, np.arctan2, np.arcsin, np.sqrt
    radians, degrees, exp, atan = np.radians, np.degrees, np.exp, np.arctan


def conformal(lat_rad, m):
    """Tangent of the conformal latitude."""
    s = m.sin(lat_rad)
    return m.sinh(m.atanh(s) - m.atanh(s * ECCENTRICITY) * ECCENTRICITY)


def spherical(lon_rad, t, m):
    """Gauss-Schreiber coordinates of a longitude from the central meridian and ``t``."""
    xi = m.atan2(t, m.cos(lon_rad))
    eta = m.atanh(m.sin(lon_rad) / m.sqrt(t * t + 1))
    return xi, eta


def easting(xi, eta, m):
    total = eta
    for j, a in enumerate(ALPHA, start=1):
        total = total + m.cos(xi * (2 * j)) * m.sinh(eta * (2 * j)) * a
    return total * RADIUS + FALSE_EASTING


def northing(xi, eta, m):
    """Northing from the equator, without the false northing of the south."""
    total = xi
    for j, a in enumerate(ALPHA, start=1):
        total = total + m.sin(xi * (2 * j)) * m.cosh(eta * (2 * j)) * a
    return total * RADIUS


def unproject(east, north, m):
    """Spherical coordinates (xi', eta') of a point of the plane."""
    x, y = north / RADIUS, (east - FALSE_EASTING) / RADIUS
    xi, eta = x, y
    for j, b in enumerate(BETA, start=1):
        xi = xi - m.sin(x * (2 * j)) * m.cosh(y * (2 * j)) * b
        eta = eta - m.cos(x * (2 * j)) * m.sinh(y * (2 * j)) * b
    return xi, eta


def latitude(chi, m):
    """Latitude (radians) from conformal latitude."""
    total = chi
    for j, d in enumerate(DELTA, start=1):
        total = total + m.sin(chi * (2 * j)) * d
    return total


def forward(lon_rel_deg, lat_deg, m=NumpyMath):
    """(easting, northing from the equator) of degrees from the central meridian and latitude."""
    t = conformal(m.radians(lat_deg), m)
    xi, eta = spherical(m.radians(lon_rel_deg), t, m)
    return easting(xi, eta, m), northing(xi, eta, m)


def polar_rho(abs_lat_deg, m):
    """Distance from the pole in the polar plane; ``abs_lat_deg`` is the latitude's size."""
    s = m.sin(m.radians(abs_lat_deg))
    psi = m.atanh(s) - m.atanh(s * ECCENTRICITY) * ECCENTRICITY
    return m.exp(psi * -1.0) * POLAR_RADIUS


def polar_chi(rho, m):
    """Conformal latitude (radians, positive) of a distance from the pole."""
    return math.pi / 2 - m.atan(rho / POLAR_RADIUS) * 2
