"""Spatial tables derived from the given star-schema tables, as DataFrames and as SQL views.

The given tables hold no geometry; FIXTURES.md defines the derivation. Every expression is plain
arithmetic, so both engines produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T0_S = 1704067200
T0_US = T0_S * 1_000_000
DAY_S = 30 * 86400
TELEPORT_US = 1706400000000000

# Query arguments that suit the spacing of the derived logs.
LATENCY_NS = 600 * 10**9
MOVE_M, TURN_DEG = 5.0, 8.0
IMAGE_DT_NS = 2600 * 10**9
BUCKET_NS = 6 * 3600 * 10**9
K = {"fx": 4.0, "fy": 4.0, "cx": 3.5, "cy": 3.5, "width": 8, "height": 8}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _us(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def odom(spark, sf_dir) -> DataFrame:
    us = F.col("us")
    theta = F.col("theta")
    return (
        table(spark, sf_dir, "events")
        .select((F.col("user_id") % 4).alias("bag_id"), F.col("event_id").alias("seq"), _us("ts").alias("us"))
        .withColumn("theta", (us - T0_US) / 8.64e10)
        .select(
            "bag_id", "seq", (us * 1000).alias("ts_ns"),
            (50.0 * F.cos(theta) + F.when(us >= TELEPORT_US, 500.0).otherwise(0.0)).alias("px"),
            (50.0 * F.sin(theta)).alias("py"), F.lit(0.0).alias("pz"),
            F.lit(0.0).alias("qx"), F.lit(0.0).alias("qy"),
            F.sin(theta / 2.0).alias("qz"), F.cos(theta / 2.0).alias("qw"),
        )
    )


def _scan_key():
    dn = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("long")
    return dn


def points(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("dn", _scan_key())
        .select(
            (F.col("dn") % 4).alias("bag_id"),
            ((F.lit(T0_S) + F.col("dn") * 1037) * 1_000_000_000).alias("ts_ns"),
            ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 4194304 + F.col("l_partkey")).alias("point_idx"),
            (F.col("l_quantity") * 0.2 + 0.0037).alias("x"),
            ((F.col("l_partkey") % 100) * 0.1 - 4.9963).alias("y"),
            (F.col("l_discount") * 20 + 0.0037).alias("z"),
        )
    )


def frames(spark, sf_dir) -> DataFrame:
    return points(spark, sf_dir).select("bag_id", "ts_ns").distinct()


def gps(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("signup", "error"))
        .select(
            (F.col("user_id") % 4).alias("bag_id"), (_us("ts") * 1000).alias("ts_ns"),
            F.when(F.col("event_type") == "error", -1).otherwise(0).alias("status"),
            (37.0 + F.col("value") * 1e-5).alias("latitude"),
            (-122.0 + F.col("value") * 2e-5).alias("longitude"),
            (F.col("value") * 0.01).alias("altitude"),
        )
    )


def images(spark, sf_dir) -> DataFrame:
    """8x8 mono images as packed bytes, one per vector, spread over the 30 days of the odometry."""
    vec = table(spark, sf_dir, "embeddings")
    step = vec.agg((F.lit(DAY_S) / F.count(F.lit(1))).cast("long").alias("step"))
    level = F.transform(
        "embedding",
        lambda e: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((e.cast("double") + 0.5) * 255.0 + 0.5).cast("int"))),
    )
    return vec.crossJoin(F.broadcast(step)).select(
        (F.col("vec_id") % 4).alias("bag_id"),
        ((F.lit(T0_S) + F.col("vec_id") * F.col("step")) * 1_000_000_000).alias("ts_ns"),
        F.col("vec_id").alias("seq"),
        F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit("mono8").alias("encoding"),
        F.unhex(F.array_join(F.transform(level, lambda v: F.lpad(F.hex(v), 2, "0")), "")).alias("data"),
    )


def camera_info(spark, sf_dir) -> DataFrame:
    """One calibration per log, timed at its first image."""
    k = [K["fx"], 0.0, K["cx"], 0.0, K["fy"], K["cy"], 0.0, 0.0, 1.0]
    return images(spark, sf_dir).groupBy("bag_id").agg(F.min("ts_ns").alias("ts_ns")).select(
        "bag_id", "ts_ns", F.array(*[F.lit(v) for v in k]).alias("k"),
        F.lit(K["width"]).alias("width"), F.lit(K["height"]).alias("height"))


def frame_id_column(bag="bag_id"):
    b = F.col(bag)
    return (F.when(b == 0, "/Map").when(b == 1, "odom").when(b == 2, "base_link").otherwise(""))


def messages(spark, sf_dir) -> DataFrame:
    """Message log: headers of scans, odometry, images and fixes on their topics."""
    def topic(df, name, kind, seq):
        return df.select("bag_id", F.lit(name).alias("topic"), F.lit(kind).alias("msgtype"), "ts_ns",
                         seq.alias("seq"), frame_id_column().alias("frame_id"))

    none = F.lit(0).cast("long")
    return (
        topic(frames(spark, sf_dir), "/points", "sensor_msgs/msg/PointCloud2", none)
        .unionByName(topic(odom(spark, sf_dir), "/odom", "nav_msgs/msg/Odometry", F.col("seq")))
        .unionByName(topic(images(spark, sf_dir), "/camera", "sensor_msgs/msg/Image", F.col("seq")))
        .unionByName(topic(gps(spark, sf_dir), "/gps/fix", "sensor_msgs/msg/NavSatFix", none))
    )


SQL_VIEWS: dict[str, str] = {
    "odom": f"""
  SELECT user_id % 4 AS bag_id, event_id AS seq, epoch_us(ts) * 1000 AS ts_ns,
    50.0::DOUBLE * cos((epoch_us(ts) - {T0_US}) / 8.64e10) + CASE WHEN epoch_us(ts) >= {TELEPORT_US} THEN 500.0 ELSE 0.0 END AS px,
    50.0::DOUBLE * sin((epoch_us(ts) - {T0_US}) / 8.64e10) AS py, 0.0::DOUBLE AS pz,
    0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy,
    sin((epoch_us(ts) - {T0_US}) / 8.64e10 / 2.0) AS qz, cos((epoch_us(ts) - {T0_US}) / 8.64e10 / 2.0) AS qw
  FROM events""",
    "points": f"""
  SELECT dn % 4 AS bag_id, ({T0_S} + dn * 1037) * 1000000000 AS ts_ns,
    (l_orderkey * 8 + l_linenumber) * 4194304 + l_partkey AS point_idx,
    l_quantity * 0.2::DOUBLE + 0.0037::DOUBLE AS x, (l_partkey % 100) * 0.1::DOUBLE - 4.9963::DOUBLE AS y,
    l_discount * 20::DOUBLE + 0.0037::DOUBLE AS z
  FROM (SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS dn FROM lineitem)""",
    "frames": "SELECT DISTINCT bag_id, ts_ns FROM points",
    "gps": """
  SELECT user_id % 4 AS bag_id, epoch_us(ts) * 1000 AS ts_ns,
    CASE WHEN event_type = 'error' THEN -1 ELSE 0 END AS status,
    37.0::DOUBLE + value * 1e-5 AS latitude, -122.0::DOUBLE + value * 2e-5 AS longitude, value * 0.01::DOUBLE AS altitude
  FROM events WHERE event_type IN ('signup', 'error')""",
    "images": f"""
  SELECT vec_id % 4 AS bag_id,
    ({T0_S} + vec_id * ({DAY_S} // (SELECT count(*) FROM embeddings))) * 1000000000 AS ts_ns, vec_id AS seq, embedding
  FROM embeddings""",
    "pixels": """
  SELECT bag_id, ts_ns AS image_ts_ns, (i - 1) // 8 AS v, (i - 1) % 8 AS u,
    greatest(0, least(255, CAST(floor((CAST(embedding[i] AS DOUBLE) + 0.5) * 255.0 + 0.5) AS INTEGER))) AS g
  FROM images, (SELECT unnest(generate_series(1, 64)) AS i)""",
    "frame_ids": "SELECT * FROM (VALUES (0, '/Map'), (1, 'odom'), (2, 'base_link'), (3, '')) t(bag_id, frame_id)",
    "messages": """
  SELECT m.bag_id, topic, ts_ns, seq, frame_id FROM (
    SELECT bag_id, '/points' AS topic, ts_ns, 0 AS seq FROM frames UNION ALL
    SELECT bag_id, '/odom', ts_ns, seq FROM odom UNION ALL
    SELECT bag_id, '/camera', ts_ns, seq FROM images UNION ALL
    SELECT bag_id, '/gps/fix', ts_ns, 0 FROM gps) m JOIN frame_ids USING (bag_id)""",
}

_NEEDS = {"frames": ["points"], "pixels": ["images"], "messages": ["odom", "frames", "images", "gps", "frame_ids"]}


def add_view(name: str, sql: str, needs: list[str]) -> None:
    SQL_VIEWS[name] = sql
    _NEEDS[name] = needs


def sql_with(views: list[str], body: str, recursive: bool = False) -> str:
    """`body` preceded by the named derived views and what they build on."""
    order: list[str] = []

    def visit(v: str) -> None:
        if v in order:
            return
        for n in _NEEDS.get(v, []):
            visit(n)
        order.append(v)

    for v in views:
        visit(v)
    head = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in order)
    word = "WITH RECURSIVE " if recursive else "WITH "
    body = body.strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        return f"{word}{head},\n{body}"
    return f"{word}{head}\n{body}"


def r6(expr: str, digits: int = 6) -> str:
    """Rounded value without a negative zero."""
    return f"CASE WHEN abs({expr}) < {0.5 * 10**-digits} THEN 0.0 ELSE round({expr}, {digits}) END"


def r(c, digits: int = 6):
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)
