"""Row formats and writers for trajectories, keyframes and point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trajectory_rows(odom: DataFrame) -> DataFrame:
    """Canonical trajectory columns, time in seconds."""
    pose = [F.col(f"p{a}").alias(f"pos.{a}") for a in "xyz"] + [F.col(f"q{a}").alias(f"orient.{a}") for a in "xyzw"]
    return odom.select("bag_id", (F.col("ts_ns") / 1e9).alias("timestamp"), *pose)


def write_trajectory(odom: DataFrame, path: str) -> None:
    """One folder of CSV parts per log, sorted by time over the parts."""
    rows = trajectory_rows(odom)
    rows.repartitionByRange("bag_id", "timestamp").sortWithinPartitions("bag_id", "timestamp").write.partitionBy(
        "bag_id").mode("overwrite").csv(path, header=True)


def keyframe_lines(keyframes: DataFrame) -> DataFrame:
    """Image name, seconds to the nanosecond and sharpness, halves to even."""
    second = 1_000_000_000
    return keyframes.select(F.format_string("%d-0.png,%d.%09d,%.2f", "ts_ns", F.expr(f"ts_ns div {second}L"), F.expr(f"ts_ns % {second}L"),
                                            F.bround("sharpness", 2)).alias("line"))


def write_keyframes(keyframes: DataFrame, path: str) -> None:
    keyframe_lines(keyframes.repartitionByRange("bag_id", "ts_ns").sortWithinPartitions("bag_id", "ts_ns")).write.mode(
        "overwrite").text(path)


def write_points(points: DataFrame, path: str, partition: tuple[str, ...] = ("bag_id",)) -> None:
    points.write.partitionBy(*partition).mode("overwrite").parquet(path)
