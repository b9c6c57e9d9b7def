"""Camera colours for points and photometric work on pixel tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import camera, rotation as rot
from waymark.functions.color import FALLBACK_GRAY, lightness
from waymark.operators.timejoin import nearest_time
from waymark.session import cut
from waymark.sources.messages import decode_image, image_problems

INTRINSICS = ("fx", "fy", "cx", "cy", "width", "height")


def match_images(frames: DataFrame, images: DataFrame, max_dt_ns: int, bucket_ns: int, strict: bool = False) -> DataFrame:
    """Frames with `image_ts_ns` of the nearest image within the tolerance, null if there is none."""
    m = nearest_time(frames, images, tol_ns=max_dt_ns, strict=strict, bucket_ns=bucket_ns)
    return m.select(*frames.columns, F.col("match.ts").alias("image_ts_ns"))


def project_points(points: DataFrame, views: DataFrame, min_depth: float = 0.1, max_depth: float | None = None) -> DataFrame:
    """Pixel (u, v) of each point in the image its scan is matched with, null if it is not seen.

    `views` has one row per scan: camera pose, intrinsics, image_ts_ns (nullable). The depth bounds
    apply to the distance from the camera, not to the depth along its axis.
    """
    m = rot.quat_to_matrix()
    v = views.select("bag_id", "ts_ns", "image_ts_ns", *[F.col(c).alias(f"_{c}") for c in rot.POSITION],
                     *[c.alias(f"_{n}") for n, c in m.items()], *[F.col(c).alias(f"_{c}") for c in INTRINSICS])
    joined = points.join(v, ["bag_id", "ts_ns"])
    body = camera.world_to_body([f"_{n}" for n in rot.MATRIX], [f"_{c}" for c in rot.POSITION], ("x", "y", "z"))
    joined = joined.withColumns({f"_b{a}": b for a, b in zip("xyz", body)})
    ox, oy, oz = camera.body_to_optical(("_bx", "_by", "_bz"))
    dist = rot.norm3("_bx", "_by", "_bz")
    safe = F.when(oz > 1e-6, oz).otherwise(F.lit(1e-6))
    joined = joined.withColumns({
        "_u": F.col("_fx") * ox / safe + F.col("_cx"), "_v": F.col("_fy") * oy / safe + F.col("_cy"), "_d": dist})
    valid = (F.col("_bx") > 1e-6) & (F.col("_d") >= min_depth) & camera.in_image(F.col("_u"), F.col("_v"), "_width", "_height")
    if max_depth is not None:
        valid = valid & (F.col("_d") <= max_depth)
    valid = valid & F.col("image_ts_ns").isNotNull()
    return joined.select(
        *points.columns, "image_ts_ns",
        F.when(valid, F.col("_u").cast("int")).alias("u"), F.when(valid, F.col("_v").cast("int")).alias("v"))


def sample_images(projected: DataFrame, images: DataFrame) -> DataFrame:
    """Colours in [0, 1] of projected points; points without a pixel get the placeholder gray.

    Images stay images: the distinct pixels asked of an image, no more than it has, meet its bytes once, and only their colours
    are joined back to the points. They are written first: as long as they are few, the points need no shuffle. Points without a pixel
    ask for one of many that no image has, since the join would gather them all under one null key.
    """
    seen = projected.filter(F.col("u").isNotNull())
    key = ["bag_id", "image_ts_ns", "v", "u"]
    asked = seen.select(*key).distinct().groupBy("bag_id", "image_ts_ns").agg(F.collect_list(F.struct("v", "u")).alias("spots"))
    good = image_problems(images).filter(F.col("bad_reason").isNull())
    held = asked.join(good.select("bag_id", F.col("ts_ns").alias("image_ts_ns"), "height", "width", "encoding", "data"), ["bag_id", "image_ts_ns"]).select(
        "bag_id", "image_ts_ns", "spots", "height", "width", "encoding", "data")
    bag_type = projected.schema["bag_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                spots = row.column(2).flatten()
                v, u = (spots.field(n).to_numpy(zero_copy_only=False) for n in ("v", "u"))
                rgb = decode_image(row.column(6)[0].as_py(), row.column(3)[0].as_py(), row.column(4)[0].as_py(), row.column(5)[0].as_py())
                inside = (v >= 0) & (u >= 0) & (v < rgb.shape[0]) & (u < rgb.shape[1])
                v, u = v[inside], u[inside]
                tint = rgb[v, u].astype(np.float64) / 255.0
                one = np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0).take(pa.array(one)), row.column(1).take(pa.array(one)), pa.array(v.astype(np.int32)), pa.array(u.astype(np.int32)),
                     *(pa.array(np.ascontiguousarray(tint[:, c])) for c in range(3))], [*key, "r", "g", "b"])

    tints = cut(held.mapInArrow(look, f"bag_id {bag_type}, image_ts_ns long, v int, u int, r double, g double, b double")).withColumnRenamed("u", "_u")
    nowhere = (-1 - F.pmod(F.xxhash64(*projected.columns), F.lit(1024))).cast("int")
    met = projected.withColumn("_u", F.coalesce("u", nowhere)).join(tints, ["bag_id", "image_ts_ns", "v", "_u"], "left")
    return met.select(*projected.columns, *[F.coalesce(c, F.lit(FALLBACK_GRAY)).alias(c) for c in "rgb"])


def match_lightness(pixels: DataFrame, reference: DataFrame) -> DataFrame:
    """Shift and scale each image's lightness (0..255) to the mean and deviation of its log's reference image.

    `reference` names one image per log (bag_id, image_ts_ns). Adds `l` and `l_matched` (truncated to whole levels).
    """
    lit = pixels.withColumn("l", F.floor(lightness("r", "g", "b") + 0.5))
    stats = lit.groupBy("bag_id", "image_ts_ns").agg(F.avg("l").alias("_m"), F.stddev_pop("l").alias("_s"))
    ref = stats.join(reference, ["bag_id", "image_ts_ns"]).select("bag_id", F.col("_m").alias("_rm"), F.col("_s").alias("_rs"))
    both = stats.join(ref, "bag_id")
    joined = lit.join(both, ["bag_id", "image_ts_ns"])
    moved = (F.col("l") - F.col("_m")) * (F.col("_rs") / (F.col("_s") + 1e-5)) + F.col("_rm")
    return joined.select(*pixels.columns, "l", F.floor(rot.clipped(moved, 0.0, 255.0)).cast("int").alias("l_matched"))


def mip_levels(pixels: DataFrame, levels: int, by=("bag_id", "image_ts_ns"), channels=("r", "g", "b")) -> DataFrame:
    """Chained 2x2 area means; level 0 is the input."""
    out = [pixels.select(*by, F.lit(0).alias("level"), "v", "u", *[F.col(c).cast("double").alias(c) for c in channels])]
    for level in range(1, levels + 1):
        prev = out[-1]
        out.append(prev.groupBy(*by, (F.lit(level)).alias("level"), F.expr("v div 2").cast("int").alias("v"),
                                F.expr("u div 2").cast("int").alias("u")).agg(*[F.avg(c).alias(c) for c in channels]))
    return reduce(DataFrame.unionByName, out)


