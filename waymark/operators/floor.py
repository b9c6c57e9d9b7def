"""Floor levelling: a robust plane per log, turned to face up."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.eigen import least_direction
from waymark.session import cut


def candidate_planes(points: DataFrame, iterations: int, seed: int) -> DataFrame:
    """`iterations` planes per log through three points each, drawn with replacement whatever the log's size.

    A draw is a hash of (log, plane, corner, seed) and picks the point whose own hash follows it on the circle of hashes. Points and draws
    are dealt to as many arcs of that circle as a log has thousands of points, so no task sorts a log.
    """
    circle = 1 << 30
    own = F.pmod(F.xxhash64("point_idx", F.lit(seed)), F.lit(circle))
    sizes = points.groupBy("bag_id").agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / 1000)).alias("_arcs"))
    spots = points.select("bag_id", "point_idx", "x", "y", "z", own.alias("_h")).join(sizes, "bag_id")
    draws = sizes.withColumn("plane", F.explode(F.sequence(F.lit(0), F.lit(iterations - 1)))).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    draws = draws.withColumn("_h", F.pmod(F.xxhash64("bag_id", "plane", "_k", F.lit(seed)), F.lit(circle)))
    arc = F.floor(F.col("_h") * F.col("_arcs") / circle).cast("long")
    spots, draws = spots.withColumn("_arc", arc), draws.withColumn("_arc", arc)
    follows = F.struct(F.pmod(F.col("p._h") - F.col("d._h"), F.lit(circle)).alias("gap"), F.col("p.point_idx").alias("i"))
    drawn = draws.alias("d").join(spots.alias("p"), (F.col("d.bag_id") == F.col("p.bag_id")) & (F.col("d._arc") == F.col("p._arc"))).groupBy(
        F.col("d.bag_id").alias("bag_id"), F.col("d.plane").alias("plane"), F.col("d._k").alias("_k")).agg(
        F.min_by(F.struct("p.x", "p.y", "p.z"), follows).alias("_p")).select("bag_id", "plane", "_k", "_p.*")
    at = lambda a, k: F.max(F.when(F.col("_k") == k, F.col(a))).alias(f"{a}{k}")
    tri = drawn.groupBy("bag_id", "plane").agg(*[at(a, k) for a in "xyz" for k in range(3)], F.count(F.lit(1)).alias("_n")).filter("_n = 3")
    e1 = [F.col(f"{a}1") - F.col(f"{a}0") for a in "xyz"]
    e2 = [F.col(f"{a}2") - F.col(f"{a}0") for a in "xyz"]
    tri = tri.withColumns({f"_c{a}": c for a, c in zip("xyz", rot.cross3(e1, e2))}).withColumn("_l", rot.norm3("_cx", "_cy", "_cz"))
    tri = tri.filter(F.col("_l") > 1e-12).withColumns({f"a{a}": F.col(f"_c{a}") / F.col("_l") for a in "xyz"})
    return tri.select("bag_id", "plane", "ax", "ay", "az", rot.dot3(("ax", "ay", "az"), ("x0", "y0", "z0")).alias("off"))


def inlier_counts(points: DataFrame, planes: DataFrame, distance: float, block: int = 50_000) -> DataFrame:
    """(bag_id, plane, n): points within `distance` of each plane, counted for blocks of points by one matrix product each."""
    sizes = points.groupBy("bag_id").agg(F.ceil(F.count(F.lit(1)) / block).alias("_blocks"))
    dealt = points.join(sizes, "bag_id").select("bag_id", F.pmod(F.xxhash64("point_idx"), F.col("_blocks")).alias("block"), "x", "y", "z")
    held = planes.join(sizes, "bag_id").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).drop("_blocks")
    bag = points.schema["bag_id"].dataType.simpleString()

    def count(pts: pa.Table, pls: pa.Table) -> pa.Table:
        xyz = np.column_stack([pts[a].to_numpy() for a in "xyz"])
        normal = np.column_stack([pls[f"a{a}"].to_numpy() for a in "xyz"])
        off, total = pls["off"].to_numpy(), np.zeros(len(normal), np.int64)
        for at in range(0, len(xyz), 2000):
            total += (np.abs(xyz[at:at + 2000] @ normal.T - off) <= distance).sum(0)
        return pa.table({"bag_id": pls["bag_id"], "plane": pls["plane"], "n": total})

    counted = dealt.groupBy("bag_id", "block").cogroup(held.groupBy("bag_id", "block")).applyInArrow(count, f"bag_id {bag}, plane int, n long")
    return counted.groupBy("bag_id", "plane").agg(F.sum("n").alias("n"))


def floor_rotations(points: DataFrame, distance: float = 0.02, iterations: int = 1000, seed: int = 7) -> DataFrame:
    """Per log: rotation matrix that turns the best plane's normal to +z, where it has at least ten inliers."""
    planes = cut(candidate_planes(points, iterations, seed))
    best = planes.join(inlier_counts(points, planes, distance), ["bag_id", "plane"]).groupBy("bag_id").agg(
        F.max_by(F.struct("ax", "ay", "az", "off"), F.struct("n", -F.col("plane"))).alias("b")).select("bag_id", "b.*")
    near = F.abs(F.col("ax") * F.col("x") + F.col("ay") * F.col("y") + F.col("az") * F.col("z") - F.col("off")) <= distance
    best = points.select("bag_id", "x", "y", "z").join(best, "bag_id").filter(near).groupBy("bag_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.covar_pop(a, b).alias(a + b) for a, b in ("xx", "xy", "xz", "yy", "yz", "zz")])

    n = least_direction(best.filter("n >= 10"), ("xx", "xy", "xz", "yy", "yz", "zz"))
    n = n.select("bag_id", *[F.when(F.col("nz") < 0, -F.col(a)).otherwise(F.col(a)).alias(a) for a in ("nx", "ny", "nz")])
    # rotation about normal × z; (1 − cos) / sin² = 1 / (1 + cos)
    nx, ny, nz = F.col("nx"), F.col("ny"), F.col("nz")
    k = 1.0 / (1.0 + nz)
    entries = [1.0 - k * nx * nx, -k * nx * ny, -nx, -k * nx * ny, 1.0 - k * ny * ny, -ny, nx, ny, nz]
    return n.select("bag_id", *[e.alias(m) for e, m in zip(entries, rot.MATRIX)])


def level_floor(points: DataFrame, distance: float = 0.02, iterations: int = 1000, seed: int = 7) -> DataFrame:
    """Points (and normals, if any) turned so that the floor is level; logs without a plane stay."""
    turn = floor_rotations(points, distance, iterations, seed)
    joined = points.join(turn, "bag_id", "left")
    moved = {}
    for names in (("x", "y", "z"), ("nx", "ny", "nz")):
        if names[0] in points.columns:
            for name, c in zip(names, rot.rotate(list(rot.MATRIX), names)):
                moved[name] = F.coalesce(c, F.col(name)).alias(name)
    return joined.select(*[moved.get(c, F.col(c)) for c in points.columns])
