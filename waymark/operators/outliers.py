"""Outlier and noise removal, spacing statistics, surface normals."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.eigen import least_direction
from waymark.operators.points import voxel_downsample, voxel_id
from waymark.operators.spacejoin import nearest, neighbours_within, radius_semi
from waymark.session import cut

BY = ("bag_id",)


def radius_outlier(points: DataFrame, count: int, radius: float, by=BY) -> DataFrame:
    """Keep points with more than `count` points (themselves included) within `radius`."""
    return neighbours_within(points, points, radius, count + 1, by, "_keep").filter("_keep").drop("_keep")


def mean_distances(points: DataFrame, k: int, spacing: float, by=BY, copies: bool = True) -> DataFrame:
    """Mean distance to the k nearest points, the point itself among them."""
    near = nearest(points, points, k, spacing, by, copies=copies)
    mean = F.aggregate("neighbours", F.lit(0.0), lambda acc, n: acc + F.sqrt(n["d2"])) / F.size("neighbours")
    return near.withColumn("mean_d", mean).drop("neighbours")


def statistical_outlier(points: DataFrame, k: int, ratio: float, spacing: float, by=BY, copies: bool = True) -> DataFrame:
    """Keep points whose mean neighbour distance is under mean + ratio·deviation of their group.

    Points with a zero mean distance (buried in copies) count towards the divisor and are dropped.
    """
    # read twice, for the group statistics and for the filter
    dist = cut(mean_distances(points, k, spacing, by, copies))
    positive = F.when(F.col("mean_d") > 0, F.col("mean_d"))
    sums = dist.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.count(positive).alias("_np"), F.sum(positive).alias("_sum"),
        F.var_pop(positive).alias("_var"), F.avg(positive).alias("_avg"))
    mean = F.col("_sum") / F.col("_n")
    spread = F.col("_np") * (F.col("_var") + (F.col("_avg") - mean) * (F.col("_avg") - mean))
    limit = mean + ratio * F.sqrt(spread / (F.col("_n") - 1))
    limits = sums.select(*by, F.when(F.col("_n") > 1, limit).alias("_limit"))
    kept = dist.join(limits, list(by)).filter((F.col("mean_d") > 0) & (F.col("mean_d") < F.col("_limit")))
    return kept.select(*points.columns)


def density_noise_filter(points: DataFrame, eps: float, min_points: int, by=BY) -> DataFrame:
    """Keep core points (at least `min_points` within `eps`) and everything within `eps` of one.

    These are the points a density clustering would label; no clusters need to be formed.
    """
    flagged = cut(neighbours_within(points, points, eps, min_points, by, "_core"))
    core = flagged.filter("_core").drop("_core")
    edge = radius_semi(flagged.filter("not _core").drop("_core"), core, eps, by)
    return core.unionByName(edge)


def keep_if_any(before: DataFrame, after: DataFrame, by=BY) -> DataFrame:
    """`after`, but logs it left empty keep `before`. `after` should be materialised."""
    lost = before.join(after.select(*by).distinct(), list(by), "left_anti")
    return after.unionByName(lost)


def clean_points(points: DataFrame, voxel: float, downsample: bool = True, means=()) -> DataFrame:
    """Voxel means, radius outliers (12 within 3 voxels), statistical outliers (20, 2.0), noise (30 within 4 voxels).

    Input without `downsample` must be voxelised already and carry `point_idx`. Each stage falls back
    to its input for a log it would empty, which needs its result twice: it is written once.
    """
    cloud = points
    if downsample:
        cloud = voxel_downsample(points, voxel, means=means).withColumn("point_idx", voxel_id())
        cloud = cloud.select("bag_id", "point_idx", "x", "y", "z", *means)
    cloud = cut(cloud)
    stages = (
        lambda c: radius_outlier(c, 12, voxel * 3.0),
        lambda c: statistical_outlier(c, 20, 2.0, voxel * 2.0, copies=False),
        lambda c: density_noise_filter(c, voxel * 4.0, 30),
    )
    for stage in stages:
        cloud = cut(keep_if_any(cloud, cut(stage(cloud))))
    return cloud


# Fixed values: (from metres, to metres, radius multiplier, ratio multiplier).
RANGE_BINS = ((0.0, 5.0, 0.6, 0.75), (5.0, 15.0, 1.0, 1.0), (15.0, float("inf"), 1.8, 1.4))


def range_bucket(distance: str):
    d = F.col(distance)
    return reduce(lambda acc, ib: F.when(d >= ib[1][0], F.lit(ib[0])).otherwise(acc), list(enumerate(RANGE_BINS))[1:], F.lit(0))


def sensor_distance(points: DataFrame, trajectory: DataFrame, spacing: float) -> DataFrame:
    """Distance of each point to the nearest trajectory position of its log."""
    track = trajectory.select("bag_id", F.col("ts_ns").alias("point_idx"), *[F.col(f"p{a}").alias(a) for a in "xyz"])
    near = nearest(points, track, 1, spacing)
    return near.withColumn("range_m", F.sqrt(F.get("neighbours", F.lit(0))["d2"])).drop("neighbours")


def range_adaptive_outliers(points: DataFrame, trajectory: DataFrame, spacing: float, radius: float = 0.0,
                            count: int = 10, k: int = 20, ratio: float = 2.0, track_spacing: float = 8.0) -> DataFrame:
    """Outlier removal within range buckets (near, middle, far) with thresholds scaled per bucket."""
    ranged = cut(sensor_distance(points, trajectory, track_spacing).withColumn("_bucket", range_bucket("range_m")))
    kept = []
    for index, (_, _, r_mult, s_mult) in enumerate(RANGE_BINS):
        part = ranged.filter(F.col("_bucket") == index).drop("_bucket")
        if radius > 0 and count > 0:
            part = cut(radius_outlier(part, count, radius * r_mult))
        if k > 0 and ratio > 0:
            part = statistical_outlier(part, k, ratio * s_mult, spacing)
        kept.append(part)
    return reduce(DataFrame.unionByName, kept).select(*points.columns)


def estimate_normals(points: DataFrame, radius: float | None, max_nn: int, spacing: float, by=BY,
                     copies: bool = True) -> DataFrame:
    """Unit normal (nx, ny, nz): direction of least spread of up to `max_nn` neighbours within `radius`.

    Fewer than three neighbours give +z. Signs are arbitrary; orient afterwards. Of several directions of equal spread the one closest to vertical is taken.
    """
    near = nearest(points, points, max_nn, spacing, by, max_radius=radius, copies=copies)
    axes = ("x", "y", "z")
    near = near.withColumn("_n", F.size("neighbours"))
    def total(*names: str):
        """Sum over the neighbours of products of their offsets from the point."""
        def add(acc, n):
            term = F.lit(1.0)
            for name in names:
                term = term * (n[name] - F.col(name))
            return acc + term

        return F.aggregate("neighbours", F.lit(0.0), add)

    near = near.withColumns({f"_m{a}": total(a) / F.col("_n") for a in axes})
    near = near.withColumns({
        f"_c{a}{b}": total(a, b) / F.col("_n") - F.col(f"_m{a}") * F.col(f"_m{b}")
        for i, a in enumerate(axes) for b in axes[i:]})

    found = least_direction(near, tuple(f"_c{ab}" for ab in ("xx", "xy", "xz", "yy", "yz", "zz")))
    few = F.col("_n") < 3
    return found.select(*points.columns, *[F.when(few, F.lit(1.0 if a == "nz" else 0.0)).otherwise(F.col(a)).alias(a) for a in ("nx", "ny", "nz")])


def split_ground(points: DataFrame, slope_deg: float) -> DataFrame:
    """`ground` where the normal is within `slope_deg` of vertical."""
    angle = F.acos(rot.clipped(F.abs("nz"), -1.0, 1.0))
    return points.withColumn("ground", angle <= math.radians(slope_deg))


def borrow_normals(points: DataFrame, cloud: DataFrame, spacing: float) -> DataFrame:
    """Normal of the nearest point of a (reduced) cloud that carries normals."""
    near = nearest(points, cloud, 1, spacing).withColumn("_id", F.get("neighbours", F.lit(0))["id"]).drop("neighbours")
    source = cloud.select("bag_id", F.col("point_idx").cast("long").alias("_id"), "nx", "ny", "nz")
    return near.join(source, ["bag_id", "_id"]).drop("_id")


def evenly_spaced(points: DataFrame, sample: int, by=BY) -> DataFrame:
    """Rows at evenly spaced positions (both ends included) of each group in `point_idx` order.

    Positions come from counts per index slot and ranks inside a slot, whose number grows with the group, so no group is sorted whole.
    """
    span = points.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("point_idx").alias("_lo"), F.max("point_idx").alias("_hi"))
    slotted = points.join(span, list(by)).withColumn(
        "_slot", F.floor((F.col("point_idx") - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo") + 1) * F.ceil(F.col("_n") / 2048)).cast("long"))
    # slots are ascending in point_idx, so (slot, index) order equals index order
    numbered = _ranked(slotted, by)
    pos = F.col("_rn") - 1
    step = (F.col("_n") - 1) / F.lit(float(max(1, sample - 1)))
    j = F.ceil(pos / step - 1e-12)
    chosen = (F.col("_n") <= sample) | (F.floor(j * step + 1e-9) == pos) & (j <= sample - 1)
    return numbered.filter(chosen).select(*points.columns)


def _ranked(slotted: DataFrame, by) -> DataFrame:
    sizes = slotted.groupBy(*by, "_slot").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*by, "_slot", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy(*by, "_slot").orderBy("point_idx"))
    return slotted.withColumn("_in", inner).join(sizes, [*by, "_slot"]).withColumn("_rn", F.col("_in") + F.col("_before"))


def mean_spacing(points: DataFrame, spacing: float, sample: int | None = None, by=BY) -> DataFrame:
    """Mean distance to the nearest other point; zero for fewer than ten points. All points are asked unless `sample`
    bounds how many, evenly spaced, are."""
    picked = points if sample is None else evenly_spaced(points, sample, by)
    near = nearest(picked, points, 2, spacing, by)
    d = F.sqrt(F.get("neighbours", F.lit(1))["d2"])
    stats = near.withColumn("_d", d).groupBy(*by).agg(F.avg(F.when(F.col("_d") > 0, F.col("_d"))).alias("_s"))
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(stats, list(by), "left").select(
        *by, "n", F.when(F.col("n") < 10, 0.0).otherwise(F.coalesce("_s", F.lit(0.0))).alias("spacing"))


def suggest_depth(points: DataFrame, spacing: float, lowest: int = 6, highest: int = 11, sample: int | None = None) -> DataFrame:
    """Octree depth that matches extent and spacing; nine without a spacing, the lowest for a flat extent."""
    s = mean_spacing(points, spacing, sample)
    box = points.groupBy("bag_id").agg(*[(F.max(a) - F.min(a)).alias(f"d{a}") for a in "xyz"])
    diag = rot.norm3("dx", "dy", "dz")
    depth = F.greatest(F.lit(lowest), F.least(F.lit(highest), F.rint(F.log2(F.col("diag") / F.col("spacing"))).cast("int")))
    joined = s.join(box, "bag_id").withColumn("diag", diag)
    return joined.select("bag_id", "spacing", "diag", F.when(F.col("spacing") <= 0, F.lit(min(9, highest))).when(
        F.col("diag") <= 0, F.lit(lowest)).otherwise(depth).alias("depth"))
