"""WGS-84 conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.rotation import _cols

# WGS-84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1.0 / 298.257223563
ECC2 = FLATTENING * (2.0 - FLATTENING)


def geodetic_to_ecef(lat, lon, alt) -> tuple[Column, Column, Column]:
    lat, lon, alt = _cols((lat, lon, alt))
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(SEMI_MAJOR) / F.sqrt(1.0 - ECC2 * F.sin(phi) * F.sin(phi))
    return (
        (n + alt) * F.cos(phi) * F.cos(lam),
        (n + alt) * F.cos(phi) * F.sin(lam),
        (n * (1.0 - ECC2) + alt) * F.sin(phi),
    )


def local_axes(lat, lon) -> list[Column]:
    """Row-major matrix applied to a local (x, y, z) row vector before adding the origin."""
    lat, lon = _cols((lat, lon))
    sl, cl = F.sin(F.radians(lat)), F.cos(F.radians(lat))
    so, co = F.sin(F.radians(lon)), F.cos(F.radians(lon))
    zero = F.lit(0.0)
    return [-so, co, zero, -sl * co, -sl * so, cl, cl * co, cl * so, sl]
