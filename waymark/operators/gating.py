"""Motion-gated selection of frames and keyframes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.operators.fold import ordered_fold
from waymark.operators.timejoin import BUCKET_NS, POSE, ordinal


def _angle(a: tuple, b: tuple) -> float:
    dot = sum(p * q for p, q in zip(a, b))
    return 2.0 * math.acos(min(1.0, abs(dot)))


def _unit(q: tuple) -> tuple:
    n = math.sqrt(sum(c * c for c in q))
    return tuple(c / n for c in q)


def motion_step(min_move: float, min_deg: float):
    """Fold step over (ts_ns, pose): a frame without pose is kept and does not become the reference."""
    def step(state, row):
        ts, pose = row[0], row[1:]
        if pose[0] is None or pose[0] != pose[0]:
            return state, (ts,)
        here = (*pose[:3], *_unit(pose[3:]))
        if state is None:
            return here, (ts,)
        moved = math.dist(here[:3], state[:3])
        turned = math.degrees(_angle(here[3:], state[3:]))
        if (min_move > 0 and moved >= min_move) or (min_deg > 0 and turned >= min_deg):
            return here, (ts,)
        return state, None

    return step


def keyframe_step(min_move: float, min_rotation_deg: float):
    """Fold step over (ts_ns, sharpness, pose); both thresholds always count, also at zero."""
    min_rot = math.radians(min_rotation_deg)

    def step(state, row):
        ts, sharp, pose = row[0], row[1], row[2:]
        here = (*pose[:3], *_unit(pose[3:]))
        if state is not None:
            moved = math.dist(here[:3], state[:3])
            if not (moved >= min_move or _angle(here[3:], state[3:]) >= min_rot):
                return state, None
        return here, (ts, sharp)

    return step


def motion_gate(frames: DataFrame, min_move: float, min_rotation_deg: float, cap: int = 0,
                partitions: int | None = None) -> DataFrame:
    """Frames that moved or turned enough since the last frame kept.

    `frames` carries a (nullable) pose. A frame without pose is kept and does not become the
    reference. A threshold of zero switches that half off; both zero keep every frame. The cap
    counts kept frames per log.
    """
    min_move, min_deg = max(0.0, float(min_move)), max(0.0, float(min_rotation_deg))
    if min_move <= 0 and min_deg <= 0:
        kept = frames.select("bag_id", "ts_ns")
    else:
        kept = ordered_fold(frames, ["bag_id"], ["ts_ns"], ["ts_ns", *POSE], motion_step(min_move, min_deg), "ts_ns long", partitions)
    return cap_frames(kept, cap) if cap > 0 else kept


def cap_frames(frames: DataFrame, cap: int, bucket_ns: int = BUCKET_NS) -> DataFrame:
    """First `cap` frames of each log, numbered by time buckets so that no task sorts a log."""
    return ordinal(frames, bucket_ns=bucket_ns, name="_rank").filter(F.col("_rank") <= cap).drop("_rank")


def keyframe_gate(images: DataFrame, min_move: float, min_rotation_deg: float,
                  partitions: int | None = None) -> DataFrame:
    """Keyframes (bag_id, kf_idx, ts_ns, ts_sec, sharpness) among images with a pose.

    Both thresholds always count, also at zero. Rows whose image did not decode must be left out
    before: they neither become keyframes nor the reference.
    """
    posed = images.filter(F.col("px").isNotNull())
    kept = ordered_fold(posed, ["bag_id"], ["ts_ns"], ["ts_ns", "sharpness", *POSE], keyframe_step(min_move, min_rotation_deg),
                        "ts_ns long, sharpness double", partitions)
    numbered = ordinal(kept, name="kf_idx")
    return numbered.select(
        "bag_id", (F.col("kf_idx") - 1).cast("int").alias("kf_idx"), "ts_ns",
        (F.col("ts_ns") * 1e-9).alias("ts_sec"), "sharpness")


def stride_frames(frames: DataFrame, every: int, max_frames: int = 0) -> DataFrame:
    """Every n-th frame of a log, the first included; then a cap on the frames selected."""
    every = max(1, int(every))
    numbered = ordinal(frames).filter((F.col("rn") - 1) % every == 0)
    if max_frames > 0:
        numbered = numbered.filter((F.col("rn") - 1) / every < max_frames)
    return numbered.drop("rn")


def identity_poses(frames: DataFrame) -> DataFrame:
    """Unit pose per frame, for clouds already in a fixed frame."""
    values = {c: F.lit(1.0 if c == "qw" else 0.0) for c in POSE}
    return frames.select("bag_id", "ts_ns", *[v.alias(c) for c, v in values.items()])


__all__ = ["motion_gate", "keyframe_gate", "stride_frames", "identity_poses", "cap_frames", "rot"]
