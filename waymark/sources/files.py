"""Files: trajectory tables, image folders, cloud folders and meshes."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions.grid import stem_ts

# Accepted column spellings, in order of preference.
TIMESTAMP_PAIRS = (
    ("pose_timestamp_sec", "pose_timestamp_nanosec"),
    ("msg_timestamp_sec", "msg_timestamp_nanosec"),
    ("timestamp", None),
    ("msg.timestamp.sec", "msg.timestamp.nanosec"),
    ("sec", "nanosec"),
)
CANONICAL = ("timestamp", "pos.x", "pos.y", "pos.z", "orient.x", "orient.y", "orient.z", "orient.w")


def normalize_trajectory(raw: DataFrame) -> DataFrame:
    """Canonical trajectory columns from any accepted spelling; extra columns are dropped."""
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    have = set(raw.columns)
    col = lambda c: F.col(f"`{c}`").cast("double")
    for sec, nano in TIMESTAMP_PAIRS:
        if sec in have and (nano is None or nano in have):
            ts = col(sec) if nano is None else col(sec) + col(nano) * 1e-9
            break
    else:
        raise ValueError("trajectory has no recognisable timestamp columns")
    picked, missing = [ts.alias("timestamp")], []
    for group, axes in (("pos", "xyz"), ("orient", "xyzw")):
        sep = "." if f"{group}.x" in have else "_"
        for axis in axes:
            name = f"{group}{sep}{axis}"
            if name in have:
                picked.append(col(name).alias(f"{group}.{axis}"))
            else:
                missing.append(f"{group}.{axis}")
    if missing:
        raise ValueError(f"trajectory lacks columns {missing}")
    carried = [F.col("bag_id")] if "bag_id" in have else []
    return raw.select(*carried, *picked)


def trajectory_odometry(traj: DataFrame, bag_id=None) -> DataFrame:
    """Trajectory rows as odometry (nanosecond times)."""
    ts = F.floor(F.col("timestamp") * 1e9 + 0.5).cast("long").alias("ts_ns")
    bag = F.col("bag_id") if bag_id is None else F.lit(bag_id).alias("bag_id")
    pose = [F.col(f"`pos.{a}`").alias(f"p{a}") for a in "xyz"] + [F.col(f"`orient.{a}`").alias(f"q{a}") for a in "xyzw"]
    return traj.select(bag, ts, *pose)


def read_trajectory(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return normalize_trajectory(raw).orderBy("timestamp")


def file_stem(path):
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def read_image_folder(spark: SparkSession, path: str, offset: float = 0.0) -> DataFrame:
    """PNG and JPEG files decoded by Spark's image source, times from the file stems."""
    img = spark.read.format("image").option("dropInvalid", True).load(path)
    origin = F.col("image.origin")
    rows = img.filter(F.lower(origin).rlike(r"\.(png|jpg)$"))
    three = F.col("image.nChannels") == 3
    return rows.select(
        file_stem(origin).alias("name"),
        stem_ts(file_stem(origin), offset).alias("ts_sec"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.when(three, "bgr8").otherwise("mono8").alias("encoding"), F.col("image.data").alias("data"),
    ).filter(F.col("ts_sec").isNotNull())


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, line) of text files, n being the line's number in its file whatever blocks the file is read in."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"), F.trim("value").alias("line"))
    blocks = lines.groupBy("file", "block").agg(F.min("line_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("line_id") - F.col("_first") + F.col("_before")).alias("n"), "line")


def read_cloud_folder(spark: SparkSession, path: str, offset: float = 0.0) -> DataFrame:
    """Points of ASCII PLY or XYZ files, one file per scan, times from the file stems.

    Of a PLY file the lines after its header count, as many as it has vertices; of other files all whose first three fields are
    numbers. Files are split by line like any text, so a large file is read by many tasks; `point_idx` follows the lines of a file.
    """
    lines = numbered_lines(spark, path)
    vertices = F.regexp_extract("line", r"^element\s+vertex\s+(\d+)", 1).try_cast("long")
    heads = lines.filter("line = 'end_header' or line like 'element%'").groupBy("file").agg(
        F.min(F.when(F.col("line") == "end_header", F.col("n"))).alias("_head"), F.max(vertices).alias("_vertices"))
    numbers = F.split("line", r"\s+")
    first_three = [F.get(numbers, F.lit(i)).try_cast("double") for i in range(3)]
    start = F.coalesce(F.col("_head") + 1, F.lit(0))
    held = lines.join(heads, "file", "left").filter(
        F.col("_head").isNull() | (F.col("n") >= start) & (F.col("_vertices").isNull() | (F.col("n") < start + F.col("_vertices"))))
    parsed = held.select("file", (F.col("n") - start).alias("point_idx"), *[c.alias(a) for a, c in zip("xyz", first_three)])
    stem = file_stem(F.col("file"))
    good = parsed.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    return good.select(stem.alias("name"), stem_ts(stem, offset).alias("ts_sec"), "point_idx", "x", "y", "z").filter(F.col("ts_sec").isNotNull())


def read_mesh(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/faces")


def scan_near_keyframes(frames: DataFrame, keyframes: DataFrame, tol_s: float = 0.5) -> DataFrame:
    """Messages at most `tol_s` from a keyframe; meant to run before any decoding."""
    from waymark.operators.timejoin import within_time

    return within_time(frames, keyframes, int(tol_s * 1e9))


