"""Text formats written by many tasks: ASCII PLY points and meshes, STL facets, PGM rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.color import byte_channel
from waymark.session import cut


def ply_lines(points: DataFrame, color: bool = False, axes=("x", "y", "z")) -> DataFrame:
    fmt, args = "%.6f %.6f %.6f", list(axes)
    if color:
        fmt += " %d %d %d"
        args += [byte_channel(c) for c in "rgb"]
    return points.select(*[c for c in ("bag_id",) if c in points.columns], F.format_string(fmt, *args).alias("line"))


def ply_header(count: int, color: bool = False, kind: str = "double") -> str:
    rows = ["ply", "format ascii 1.0", f"element vertex {count}"]
    rows += [f"property {kind} {a}" for a in "xyz"]
    if color:
        rows += [f"property uchar {c}" for c in ("red", "green", "blue")]
    return "\n".join([*rows, "end_header"])


def write_ply(points: DataFrame, path: str, color: bool = False, axes=("x", "y", "z")) -> None:
    """Body as text parts under `path`/body, header (needs the count) as `path`/header."""
    lines = cut(ply_lines(points, color, axes))  # read for the count and for the body
    count = lines.count()
    lines.select("line").write.mode("overwrite").text(f"{path}/body")
    spark = points.sparkSession
    head = spark.range(1).select(F.lit(ply_header(count, color)).alias("line")).coalesce(1)
    head.write.mode("overwrite").text(f"{path}/header")
