"""Structured Streaming forms of the stateful steps. All run with `trigger(availableNow=True)` too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.gating import keyframe_step, motion_step
from waymark.operators.odometry import loss_step
from waymark.operators.timejoin import POSE
from waymark.streaming.ordered import ordered_steps


def event_time(df: DataFrame, ts: str = "ts_ns", name: str = "event_time") -> DataFrame:
    """Microsecond timestamp for watermarks; the nanosecond key stays."""
    return df.withColumn(name, F.timestamp_micros(F.expr(f"{ts} div 1000")))


def dispatch(stream: DataFrame, handlers: dict[str, Callable[[DataFrame, int], None]], checkpoint: str):
    """Run each topic's handler on its share of every micro-batch of one message stream."""
    def route(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for topic, handler in handlers.items():
            handler(batch.filter(F.col("topic") == topic), batch_id)
        batch.unpersist()

    wanted = stream.filter(F.col("topic").isin(*handlers))
    return wanted.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def match_images(scans: DataFrame, images: DataFrame, max_dt_us: int, delay: str = "0 seconds") -> DataFrame:
    """Nearest image per scan within the tolerance, or none, once the watermark has passed the scan.

    A stream-stream outer join keeps scans and images only for the tolerance; later arrivals are dropped.
    """
    s = event_time(scans.select("bag_id", "ts_ns")).withWatermark("event_time", delay)
    i = event_time(images.select(F.col("bag_id").alias("i_bag"), F.col("ts_ns").alias("image_ts_ns")), "image_ts_ns", "image_time")
    i = i.withWatermark("image_time", delay)
    span = F.expr(f"interval {int(max_dt_us)} microseconds")
    near = (F.col("bag_id") == F.col("i_bag")) & (F.col("image_time") >= F.col("event_time") - span) & (
        F.col("image_time") <= F.col("event_time") + span)
    joined = s.join(i, near, "leftOuter")
    gap = F.abs(F.col("image_ts_ns") - F.col("ts_ns"))
    return joined.groupBy("bag_id", "event_time", "ts_ns").agg(
        F.min(F.when(F.col("image_ts_ns").isNotNull(), F.struct(gap.alias("gap"), F.col("image_ts_ns")))).alias("m")
    ).select("bag_id", "ts_ns", "m.image_ts_ns")


POSE_DDL = ", ".join(f"{c} double" for c in POSE)


def motion_gate(frames: DataFrame, min_move: float, min_rotation_deg: float, delay_ns: int, idle_ms: int = 0) -> DataFrame:
    """(bag_id, ts_ns, late): motion gate over posed frames that come up to `delay_ns` out of order."""
    return ordered_steps(frames, motion_step(min_move, min_rotation_deg), POSE_DDL, POSE_DDL, "", delay_ns, idle_ms=idle_ms)


def keyframe_gate(images: DataFrame, min_move: float, min_rotation_deg: float, delay_ns: int, idle_ms: int = 0) -> DataFrame:
    """(bag_id, ts_ns, late, sharpness): keyframes among images with a pose and their sharpness."""
    rule = keyframe_step(min_move, min_rotation_deg)

    def step(state, row):
        state, out = rule(state, row)
        return state, out and out[1:]

    return ordered_steps(images, step, f"sharpness double, {POSE_DDL}", POSE_DDL, "sharpness double", delay_ns, idle_ms=idle_ms)


def odom_loss(odom: DataFrame, max_speed: float, max_rate_deg: float, delay_ns: int, idle_ms: int = 0) -> DataFrame:
    """(bag_id, ts_ns, late, prev_ts_ns, speed, rate): samples that the limits tell from the one before, as they become known."""
    return ordered_steps(odom, loss_step(max_speed, max_rate_deg), POSE_DDL, f"ts_ns long, {POSE_DDL}", "prev_ts_ns long, speed double, rate double", delay_ns,
                         order="seq", idle_ms=idle_ms)


CALIBRATION = ("fx", "fy", "cx", "cy", "width", "height")


def calibrated(scans: DataFrame, info: DataFrame, delay_ns: int, idle_ms: int = 0) -> DataFrame:
    """(bag_id, ts_ns, late, calibration) of scans: the last calibration of the log up to the scan, null before the first. Calibrations of a scan's own
    time count. Late calibrations leave with `late` too."""
    ddl = ", ".join(f"{c} double" for c in CALIBRATION)
    none = [F.lit(None).cast("double").alias(c) for c in CALIBRATION]
    both = info.select("bag_id", "ts_ns", "closing", F.lit(0).alias("place"), *[F.col(c).cast("double").alias(c) for c in CALIBRATION]).unionByName(
        scans.select("bag_id", "ts_ns", "closing", F.lit(1).alias("place"), *none))

    def step(state, row):
        return (row[1:], None) if row[1] is not None else (state, state or (None,) * len(CALIBRATION))

    return ordered_steps(both, step, ddl, ddl, ddl, delay_ns, order="place", idle_ms=idle_ms)


def voxel_sums(points: DataFrame, size: float) -> DataFrame:
    """Running point count and coordinate sums per voxel (update mode); order of arrival does not matter."""
    keyed = points.select("bag_id", *[F.floor(F.col(a) / size).cast("long").alias(f"v{a}") for a in "xyz"], "x", "y", "z")
    return keyed.groupBy("bag_id", "vx", "vy", "vz").agg(F.count(F.lit(1)).alias("n"), *[F.sum(a).alias(f"s{a}") for a in "xyz"])


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append every update with its batch number; the highest number of a key is its value."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(path)

    stream.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def latest_updates(saved: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in saved.columns if c not in (*keys, "batch")]
    newest = saved.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v"))
    return newest.select(*keys, "v.*")


def run_append(stream: DataFrame, path: str, checkpoint: str) -> None:
    stream.writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
