"""Coverage counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage_report(stages: dict[str, DataFrame]) -> DataFrame:
    """Frames per log and stage; a stage that lost all frames of a log has no row for it."""
    counts = [
        df.groupBy("bag_id").agg(F.count(F.lit(1)).alias("frames")).select("bag_id", F.lit(name).alias("stage"), "frames")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def colour_coverage(frames: DataFrame, matched: str) -> DataFrame:
    """Frames per log with and without a camera image."""
    has = F.col(matched).isNotNull()
    return frames.groupBy("bag_id").agg(
        F.count(F.lit(1)).alias("merged"), F.count_if(has).alias("camera_coloured"), F.count_if(~has).alias("fallback_gray"))
