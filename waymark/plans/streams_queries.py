"""Streaming queries over the derived tables, fed as files and run until all input is used."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import timejoin
from waymark.plans import fixtures as fx
from waymark.plans.fixtures import r, r6, sql_with
from waymark.plans.registry import query
from waymark.plans.timeline_queries import KF_DEG, KF_MOVE, frame_poses, seen_pose_images
from waymark.session import cut, scratch_path
from waymark.streaming import live
from waymark.streaming.ordered import run_split

YEAR_NS = 365 * 86400 * 10**9


def landed(spark, df, name, closing=False):
    """The table as a stream of files; `closing` adds one late row of no log that moves the watermark on."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if closing:
        end = df.agg((F.max("ts_ns") + YEAR_NS).alias("ts_ns")).select(F.lit(-1).cast("long").alias("bag_id"), "ts_ns")
        end.write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


#: Rows reach a stream up to a day after their time, in so many files, one a batch; what a gate waits for.
DISORDER_NS, FILES = 86400 * 10**9, 5
DELAY_NS = 2 * DISORDER_NS


def arriving(spark, df, name, late=None):
    """The table as a stream of `FILES` files in order of arrival, each a batch, with rows of different files out of order; then the closing row of every log.
    `late` rows come in the last file."""
    path = scratch_path(spark, name)
    arrival = F.col("ts_ns") + F.pmod(F.xxhash64("bag_id", "ts_ns"), F.lit(DISORDER_NS))
    df = cut(df.withColumns({"closing": F.lit(False), "_arrival": arrival}))
    span = df.agg(F.min("_arrival").alias("low"), (F.max("_arrival") + 1).alias("high")).first()
    file = F.floor((F.col("_arrival") - span["low"]) * FILES / (span["high"] - span["low"]))
    rows = df.drop("_arrival")
    for i in range(FILES):
        part = df.filter(file == i).drop("_arrival")
        if late is not None and i == FILES - 1:
            part = part.unionByName(late.withColumn("closing", F.lit(False)))
        part.coalesce(1).write.mode("append").parquet(path)
    ends = rows.groupBy("bag_id").agg(F.max("ts_ns").alias("ts_ns"), F.lit(True).alias("closing"))
    rows.limit(0).unionByName(ends, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop("_arrival").schema).option("maxFilesPerTrigger", 1).parquet(path)


def split(spark, stream):
    """What the stream gives in time and what came late, run until all files are used."""
    out, late = scratch_path(spark, "ordered"), scratch_path(spark, "late")
    run_split(stream, out, late, scratch_path(spark, "state"))
    return spark.read.parquet(out).drop("batch"), spark.read.parquet(late).drop("batch")


@query("stream_match_images", "ST2 ST3 J4", sql_with(["frame_image"], f"""
SELECT bag_id, ts_ns, CASE WHEN abs(match_ts - ts_ns) <= {fx.IMAGE_DT_NS} THEN match_ts END AS image_ts_ns FROM frame_image"""))
def _(spark, sf):
    scans = landed(spark, fx.frames(spark, sf), "scans", closing=True)
    img = landed(spark, fx.images(spark, sf).select("bag_id", "ts_ns"), "images", closing=True)
    out = scratch_path(spark, "matched")
    live.run_append(live.match_images(scans, img, fx.IMAGE_DT_NS // 1000, "60 days"), out, scratch_path(spark, "state"))
    return spark.read.parquet(out).filter("bag_id >= 0")


@query("stream_motion_gate", "ST4 W2", sql_with(["kept_all"], "SELECT bag_id, ts_ns FROM kept_all"))
def _(spark, sf):
    poses = frame_poses(spark, sf).select("bag_id", "ts_ns", *timejoin.POSE)
    return split(spark, live.motion_gate(arriving(spark, poses, "poses"), fx.MOVE_M, fx.TURN_DEG, DELAY_NS))[0]


@query("stream_keyframe_gate", "ST4 W3", sql_with(["keyframes"], f"SELECT bag_id, ts_ns, {r6('sharpness')} AS sharpness FROM keyframes"))
def _(spark, sf):
    images = arriving(spark, seen_pose_images(spark, sf).filter("px is not null"), "images")
    return split(spark, live.keyframe_gate(images, KF_MOVE, KF_DEG, DELAY_NS))[0].select("bag_id", "ts_ns", r("sharpness").alias("sharpness"))


MAX_SPEED, MAX_RATE = 0.002, 1e9
@query("stream_odom_loss", "ST7 A4", sql_with(["rates"], f"""
SELECT bag_id, prev_ts_ns, ts_ns, {r6('speed')} AS speed FROM rates WHERE speed > {MAX_SPEED}"""))
def _(spark, sf):
    odom = fx.odom(spark, sf).select("bag_id", "ts_ns", "seq", *timejoin.POSE)
    return split(spark, live.odom_loss(arriving(spark, odom, "odom"), MAX_SPEED, MAX_RATE, DELAY_NS))[0].select(
        "bag_id", "prev_ts_ns", "ts_ns", r("speed").alias("speed"))


fx.add_view("calibrations", "SELECT bag_id, ts_ns, 4.0 + seq % 3 AS fx, 4.0 + seq % 2 AS fy, 3.5 AS cx, 3.5 AS cy, 8.0 AS width, 8.0 AS height FROM images WHERE seq % 7 = 0 AND seq > 20", ["images"])
fx.add_view("calibrated", """
  SELECT f.bag_id, f.ts_ns, c.fx, c.fy, c.width FROM frames f ASOF LEFT JOIN calibrations c ON c.bag_id = f.bag_id AND f.ts_ns >= c.ts_ns""", ["frames", "calibrations"])


def calibrations(spark, sf):
    """Calibrations that change in mid-log."""
    one = {"cx": 3.5, "cy": 3.5, "width": 8.0, "height": 8.0}
    return fx.images(spark, sf).filter("seq % 7 = 0 and seq > 20").select(
        "bag_id", "ts_ns", (4.0 + F.col("seq") % 3).alias("fx"), (4.0 + F.col("seq") % 2).alias("fy"), *[F.lit(v).alias(c) for c, v in one.items()])


@query("stream_calibration", "ST5", sql_with(["calibrated"], "SELECT bag_id, ts_ns, CAST(fx AS DOUBLE) AS fx, CAST(fy AS DOUBLE) AS fy, CAST(width AS DOUBLE) AS width FROM calibrated"))
def _(spark, sf):
    scans = arriving(spark, fx.frames(spark, sf), "scans")
    info = arriving(spark, calibrations(spark, sf), "info").filter("not closing")
    return split(spark, live.calibrated(scans, info, DELAY_NS))[0].select("bag_id", "ts_ns", "fx", "fy", "width")


@query("stream_late_rows", "ST3", sql_with(["frame_pose"], f"""
SELECT bag_id, ts_ns - {400 * 86400 * 10**9} AS ts_ns, 'late' AS kind, count(*) AS n FROM frame_pose WHERE ts_ns % 11 = 0 GROUP BY ALL
UNION ALL SELECT bag_id, ts_ns, 'in time', 1 FROM frame_pose"""))
def _(spark, sf):
    """Rows planted 400 days back in the last file are told from those in time, none is lost; a gate without a distance keeps all."""
    poses = cut(frame_poses(spark, sf).select("bag_id", "ts_ns", *timejoin.POSE))
    old = poses.filter("ts_ns % 11 = 0").withColumn("ts_ns", F.col("ts_ns") - 400 * 86400 * 10**9)
    kept, late = split(spark, live.motion_gate(arriving(spark, poses, "poses", old), 1e-300, 0.0, DELAY_NS))
    both = kept.withColumn("kind", F.lit("in time")).unionByName(late.withColumn("kind", F.lit("late")))
    return both.groupBy("bag_id", "ts_ns", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("stream_voxel_sums", "ST6 A2", sql_with(["svox"], f"""
SELECT bag_id, vx, vy, vz, CAST(n AS BIGINT) AS n, {r6('x', 9)} AS x FROM svox"""))
def _(spark, sf):
    pts = landed(spark, fx.points(spark, sf).select("bag_id", "x", "y", "z"), "points")
    out = scratch_path(spark, "sums")
    live.run_updates(live.voxel_sums(pts, 0.5), out, scratch_path(spark, "state"))
    v = live.latest_updates(spark.read.parquet(out), ["bag_id", "vx", "vy", "vz"])
    return v.select("bag_id", "vx", "vy", "vz", "n", r(F.col("sx") / F.col("n"), 9).alias("x"))


@query("stream_topic_dispatch", "ST1 E1", sql_with(["messages"], """
SELECT topic, bag_id, count(*) AS n FROM messages WHERE topic IN ('/points', '/odom') GROUP BY 1, 2"""))
def _(spark, sf):
    msgs = landed(spark, fx.messages(spark, sf), "messages")
    out = scratch_path(spark, "topics")

    def count(batch, batch_id):
        batch.groupBy("topic", "bag_id").agg(F.count(F.lit(1)).alias("n")).write.mode("append").parquet(out)

    live.dispatch(msgs, {"/points": count, "/odom": count}, scratch_path(spark, "state")).awaitTermination()
    return spark.read.parquet(out).groupBy("topic", "bag_id").agg(F.sum("n").alias("n"))
