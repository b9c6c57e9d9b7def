"""Integer cells, file-stem times and time units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.rotation import _cols

NS_PER_S = 1_000_000_000


def cell(c, size, origin=0.0) -> Column:
    (c,) = _cols((c,))
    o = origin if isinstance(origin, Column) else F.lit(float(origin))
    return F.floor((c - o) / size).cast("long")


def cell_trunc(c, size, origin) -> Column:
    """Cell by truncation toward zero, as raster indices are taken."""
    (c, o) = _cols((c, origin))
    return ((c - o) / size).cast("long")


def cell_center(k, size, origin) -> Column:
    k, o = _cols((k, origin))
    return o + (k + 0.5) * size


def ns_to_s(ns) -> Column:
    (ns,) = _cols((ns,))
    return ns * 1e-9


def s_to_ns(seconds: float) -> int:
    return int(seconds * 1e9)


def stem_ts(stem, offset: float = 0.0) -> Column:
    """Seconds from a `sec-nanosec` file stem; a stem without that shape is read as one number."""
    (s,) = _cols((stem,))
    parts = F.split(s, "-")
    sec = F.get(parts, F.lit(0)).try_cast("double")
    nano = F.get(parts, F.lit(1)).try_cast("double")
    return F.coalesce(sec + nano * 1e-9, s.try_cast("double")) + F.lit(float(offset))


def frame_mode(frame_id, override: str = "auto") -> Column:
    """`global` for the fixed frames odom/map/world, else `local`, unless overridden."""
    if override in ("global", "local"):
        return F.lit(override)
    (f,) = _cols((frame_id,))
    name = F.lower(F.regexp_replace(F.trim(F.coalesce(f, F.lit(""))), "^/+", ""))
    return F.when(name.isin("odom", "map", "world"), F.lit("global")).otherwise(F.lit("local"))
