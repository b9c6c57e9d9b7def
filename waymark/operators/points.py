"""Point tables: transforms, voxel means, rays, extents, gray fill, levels of detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.color import FALLBACK_GRAY, is_gray
from waymark.functions.geodesy import geodetic_to_ecef, local_axes
from waymark.functions.grid import cell
from waymark.operators.spacejoin import radius_anti
from waymark.operators.timejoin import nearest_time

VOXEL = ("vx", "vy", "vz")


def finite_points(points: DataFrame) -> DataFrame:
    ok = F.lit(True)
    for a in "xyz":
        ok = ok & F.col(a).isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))
    return points.filter(ok)


def min_frame_points(points: DataFrame, n: int) -> DataFrame:
    """Points of scans that hold at least `n` of them."""
    big = points.groupBy("bag_id", "ts_ns").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= n)
    return points.join(big.select("bag_id", "ts_ns"), ["bag_id", "ts_ns"], "left_semi")


def transform_points(points: DataFrame, poses: DataFrame, rays: bool = False) -> DataFrame:
    """World coordinates of points whose scan has a pose; others drop out.

    The matrix is made once per pose, or taken from r00.. columns. With `rays`, (vx, vy, vz) points from each point to the sensor.
    """
    m = {n: F.col(n) for n in rot.MATRIX} if "r00" in poses.columns else rot.quat_to_matrix()
    p = poses.select("bag_id", "ts_ns", *rot.POSITION, *[c.alias(n) for n, c in m.items()])
    joined = points.join(p, ["bag_id", "ts_ns"])
    moved = rot.rotate(list(rot.MATRIX), ("x", "y", "z"))
    rest = [c for c in points.columns if c not in ("x", "y", "z")]
    out = joined.select(*rest, *[(v + F.col(t)).alias(a) for v, t, a in zip(moved, rot.POSITION, "xyz")], *rot.POSITION)
    if rays:
        out = out.select(*rest, "x", "y", "z", *[(F.col(f"p{a}") - F.col(a)).alias(f"v{a}") for a in "xyz"])
    return out.drop(*rot.POSITION)


def attach_view_rays(points: DataFrame, poses: DataFrame) -> DataFrame:
    """Ray from each point to the sensor of its scan, null where the scan has no pose."""
    origin = poses.select("bag_id", "ts_ns", *rot.POSITION)
    joined = points.join(origin, ["bag_id", "ts_ns"], "left")
    return joined.select(*points.columns, *[(F.col(f"p{a}") - F.col(a)).alias(f"v{a}") for a in "xyz"])


def orient_by_rays(points: DataFrame, normal=("nx", "ny", "nz"), ray=("vx", "vy", "vz")) -> DataFrame:
    """Flip normals that look away from their ray; zero or missing rays leave them."""
    flip = F.coalesce((rot.norm3(*ray) > 1e-12) & (rot.dot3(normal, ray) < 0), F.lit(False))
    return points.withColumns({n: F.when(flip, -F.col(n)).otherwise(F.col(n)) for n in normal})


def orient_up(points: DataFrame) -> DataFrame:
    flip = F.col("nz") < 0
    return points.withColumns({n: F.when(flip, -F.col(n)).otherwise(F.col(n)) for n in ("nx", "ny", "nz")})


def orient_to_camera(points: DataFrame, trajectory: DataFrame, bucket_ns: int) -> DataFrame:
    """Flip normals away from the camera position nearest in time.

    The match is made once per scan time; points only join its result.
    """
    times = points.select("bag_id", "ts_ns").distinct()
    cam = nearest_time(times, trajectory, rot.POSITION, bucket_ns=bucket_ns, name="m")
    cam = cam.select("bag_id", "ts_ns", *[f"m.{c}" for c in rot.POSITION])
    joined = points.join(cam, ["bag_id", "ts_ns"])
    away = rot.dot3([F.col(f"p{a}") - F.col(a) for a in "xyz"], ("nx", "ny", "nz")) < 0
    flipped = {n: F.when(away, -F.col(n)).otherwise(F.col(n)).alias(n) for n in ("nx", "ny", "nz")}
    return joined.select(*[flipped.get(c, F.col(c)) for c in points.columns])


def _origins(points: DataFrame, size: float, by) -> DataFrame:
    """Grid origin half a voxel below the smallest coordinate of each group."""
    return points.groupBy(*by).agg(*[(F.min(a) - size / 2.0).alias(f"_o{a}") for a in "xyz"])


def voxel_keys(points: DataFrame, size: float, by=("bag_id",), origin: str = "fixed") -> DataFrame:
    if origin == "extent":
        points = points.join(_origins(points, size, by), list(by))
        keyed = points.withColumns({k: cell(a, size, F.col(f"_o{a}")) for k, a in zip(VOXEL, "xyz")})
        return keyed.drop("_ox", "_oy", "_oz")
    return points.withColumns({k: cell(a, size) for k, a in zip(VOXEL, "xyz")})


def voxel_downsample(points: DataFrame, size: float, by=("bag_id",), means=(), weight: str | None = None,
                     origin: str = "fixed", extra=()) -> DataFrame:
    """One mean point per voxel and group, with the mean of further columns and the point count `n`.

    Order-free, so merging any number of scans is this one aggregation. `origin` is `fixed` (0,0,0) or
    `extent` (half a voxel below the group's smallest coordinates). `weight` names a point-count column
    of already reduced input.
    """
    keyed = voxel_keys(points, size, by, origin)
    cols = ["x", "y", "z", *means]
    if weight:
        total = F.sum(weight)
        aggs = [(F.sum(F.col(c) * F.col(weight)) / total).alias(c) for c in cols] + [total.alias("n")]
    else:
        aggs = [F.avg(c).alias(c) for c in cols] + [F.count(F.lit(1)).alias("n")]
    return keyed.groupBy(*by, *VOXEL).agg(*aggs, *extra)


def voxel_id() -> Column:
    """Voxel key packed in one long, 21 bits an axis; a voxel beyond them is an error, never another voxel's id."""
    off = 1 << 20
    held = reduce(lambda a, b: a & b, [F.col(v).between(-off, off - 1) for v in VOXEL])
    return F.when(~held, F.raise_error(F.lit("voxel beyond 21 bits an axis: subtract the log's smallest voxel first")).cast("long")).otherwise(((F.col("vx") + off) * (1 << 42) + (F.col("vy") + off) * (1 << 21) + (F.col("vz") + off)).cast("long"))


def merge_frames(points: DataFrame, size: float, means=()) -> DataFrame:
    """Voxel means per scan first, then over all scans of a log (every scan's voxel counts once)."""
    per_frame = voxel_downsample(points, size, ("bag_id", "ts_ns"), means)
    return voxel_downsample(per_frame.drop("n", *VOXEL), size, ("bag_id",), means)


def voxel_first(points: DataFrame, size: float, carried: list[str], by=("bag_id",), origin: str = "fixed") -> DataFrame:
    """Voxel means that carry columns of their first point (smallest time, then index)."""
    keyed = voxel_keys(points, size, by, origin)
    first = F.min_by(F.struct(*carried), F.struct("ts_ns", "point_idx"))
    out = keyed.groupBy(*by, *VOXEL).agg(*[F.avg(a).alias(a) for a in "xyz"], first.alias("_f"))
    return out.select(*by, *VOXEL, "x", "y", "z", *[F.col(f"_f.{c}").alias(c) for c in carried])


def extent(points: DataFrame, resolution: float, by=("bag_id",)) -> DataFrame:
    """Bounds per log and the raster size that covers them (at least one cell)."""
    box = points.groupBy(*by).agg(*[F.min(a).alias(f"min_{a}") for a in "xyz"], *[F.max(a).alias(f"max_{a}") for a in "xyz"])
    size = lambda a: F.greatest(F.lit(1), F.ceil((F.col(f"max_{a}") - F.col(f"min_{a}")) / resolution).cast("int"))
    return box.withColumns({"x_size": size("x"), "y_size": size("y")})


def fill_gray(points: DataFrame) -> DataFrame:
    return points.withColumns({c: F.coalesce(c, F.lit(FALLBACK_GRAY)) for c in "rgb"})


def drop_gray_near_color(points: DataFrame, radius: float) -> DataFrame:
    """Drop placeholder-coloured points that have a truly coloured point within `radius`."""
    if radius <= 0:
        return points
    gray = is_gray("r", "g", "b")
    coloured = points.filter(~gray)
    return coloured.unionByName(radius_anti(points.filter(gray), coloured, radius))


def concat_clouds(clouds: list[DataFrame]) -> DataFrame:
    """Union of clouds: colours always present, normals only if every cloud has them."""
    keep_normals = all("nx" in c.columns for c in clouds)
    ready = []
    for c in clouds:
        if "r" not in c.columns:
            c = c.withColumns({k: F.lit(None).cast("double") for k in "rgb"})
        ready.append(fill_gray(c) if keep_normals else fill_gray(c).drop("nx", "ny", "nz"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ready)


def to_ecef(points: DataFrame, origins: DataFrame) -> DataFrame:
    """Earth-fixed coordinates (ex, ey, ez) of local points, per log origin (lat0, lon0, alt0).

    Row vectors are multiplied with the transposed axes matrix, as the reference results are.
    """
    o = origins.select("bag_id", *[c.alias(f"_o{i}") for i, c in enumerate(geodetic_to_ecef("lat0", "lon0", "alt0"))],
                       *[c.alias(f"_m{i}") for i, c in enumerate(local_axes("lat0", "lon0"))])
    joined = points.join(o, "bag_id")
    turned = rot.rotate([f"_m{i}" for i in range(9)], ("x", "y", "z"))
    return joined.select(*points.columns, *[(t + F.col(f"_o{i}")).alias(n) for i, (t, n) in enumerate(zip(turned, ("ex", "ey", "ez")))])


LOD_LEVELS = (("coarse", 4.0), ("medium", 2.0), ("fine", 1.0))


def lod_pyramid(points: DataFrame, base_size: float, levels=LOD_LEVELS, means=()) -> DataFrame:
    """Levels of detail in one table; a multiplier of at most one takes the points as they are."""
    layers = []
    for name, mult in levels:
        layer = points if mult <= 1.0 else voxel_downsample(points, base_size * mult, means=means)
        layers.append(layer.select("bag_id", F.lit(name).alias("lod"), "x", "y", "z", *means))
    return reduce(DataFrame.unionByName, layers)


def tile_manifest(layers: DataFrame, tile: float) -> DataFrame:
    """Bounds and point count per level and square tile."""
    keyed = layers.withColumns({"tile_x": cell("x", tile), "tile_y": cell("y", tile)})
    return keyed.groupBy("bag_id", "lod", "tile_x", "tile_y").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(a).alias(f"min_{a}") for a in "xyz"], *[F.max(a).alias(f"max_{a}") for a in "xyz"])
