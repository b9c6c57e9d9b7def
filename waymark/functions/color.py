"""Colour rules as column expressions; channels are doubles in [0, 1] unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.rotation import _cols, clipped

# Placeholder colour and the bounds that recognise it after averaging.
FALLBACK_GRAY = 0.5
GRAY_MAX_STD = 0.08
GRAY_MAX_SHIFT = 0.15

COLORMAPS = ("jet", "hot", "cool", "gray")


def is_gray(r, g, b) -> Column:
    r, g, b = _cols((r, g, b))
    mean = (r + g + b) / 3.0
    variance = ((r - mean) ** 2 + (g - mean) ** 2 + (b - mean) ** 2) / 3.0
    return (F.sqrt(variance) < GRAY_MAX_STD) & (F.abs(mean - 0.5) < GRAY_MAX_SHIFT)


def byte_channel(c) -> Column:
    (c,) = _cols((c,))
    return (clipped(c, 0.0, 1.0) * 255).cast("int")


def colormap(value: Column, name: str = "jet") -> tuple[Column, Column, Column]:
    if name not in COLORMAPS:
        raise ValueError(f"unknown colormap {name!r}; choose one of {COLORMAPS}")
    v = clipped(value, 0.0, 1.0)
    if name == "jet":
        return tuple(clipped(1.5 - F.abs(4.0 * v - peak), 0.0, 1.0) for peak in (3.0, 2.0, 1.0))
    if name == "hot":
        return tuple(clipped(v * 3.0 - shift, 0.0, 1.0) for shift in (0.0, 1.0, 2.0))
    if name == "cool":
        return v, 1.0 - v, F.lit(1.0)
    return v, v, v


def lightness(r, g, b) -> Column:
    """CIE L* of 8-bit sRGB, scaled to 0..255."""

    def linear(c: Column) -> Column:
        s = c / 255.0
        return F.when(s > 0.04045, F.pow((s + 0.055) / 1.055, F.lit(2.4))).otherwise(s / 12.92)

    r, g, b = (linear(c) for c in _cols((r, g, b)))
    y = 0.212671 * r + 0.715160 * g + 0.072169 * b
    star = F.when(y > 0.008856, 116.0 * F.cbrt(y) - 16.0).otherwise(903.3 * y)
    return star * 255.0 / 100.0
