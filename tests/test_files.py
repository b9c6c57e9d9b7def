import math

import pytest
from pyspark.sql import functions as F

from waymark.functions.geodesy import geodetic_to_ecef
from waymark.sinks import tables, text
from waymark.sources import files, messages


def test_cloud_folder_round_trip(spark, tmp_path):
    (tmp_path / "12-500000000.ply").write_text(text.ply_header(2) + "\n1.000000 2.000000 3.000000\n4.0 5.0 6.0\n")
    (tmp_path / "13.xyz").write_text("7 8 9\n")
    rows = sorted((r.ts_sec, r.x, r.z) for r in files.read_cloud_folder(spark, str(tmp_path), 1.0).collect())
    assert rows == [(13.5, 1.0, 3.0), (13.5, 4.0, 6.0), (14.0, 7.0, 9.0)]


def test_trajectory_csv(spark, tmp_path):
    head = " msg_timestamp_sec,msg_timestamp_nanosec,pos_x,pos_y,pos_z,orient_x,orient_y,orient_z,orient_w\n"
    (tmp_path / "t.csv").write_text(head + "2,500000000,1,2,3,0,0,0,1\n1,0,4,5,6,0,0,0,1\n")
    t = files.read_trajectory(spark, str(tmp_path / "t.csv"))
    assert [r.timestamp for r in t.collect()] == [1.0, 2.5]
    with pytest.raises(ValueError):
        files.normalize_trajectory(t.drop("`pos.x`").select(F.col("timestamp")))
    odom = files.trajectory_odometry(t, 3)
    tables.write_trajectory(odom, str(tmp_path / "out"))
    again = spark.read.csv(str(tmp_path / "out"), header=True)
    assert again.count() == 2 and "orient.w" in again.columns


def test_ply_sink_counts(spark, tmp_path):
    p = spark.createDataFrame([(0.0, 0.0, 0.0, 2.0, 0.5, -1.0)], "x double, y double, z double, r double, g double, b double")
    text.write_ply(p, str(tmp_path / "p"), color=True)
    assert spark.read.text(str(tmp_path / "p/body")).first()[0] == "0.000000 0.000000 0.000000 255 127 0"
    assert "element vertex 1" in spark.read.text(str(tmp_path / "p/header"), wholetext=True).first()[0]


def test_ecef_origin(spark):
    r = spark.range(1).select(*geodetic_to_ecef(F.lit(0.0), F.lit(0.0), F.lit(0.0))).first()
    assert (r[0], r[1], r[2]) == pytest.approx((6378137.0, 0.0, 0.0))


def test_rgb_and_bgr(spark):
    rows = [(0, 1, 1, 1, "rgb8", bytearray([1, 2, 3])), (0, 2, 1, 1, "bgr8", bytearray([1, 2, 3])), (0, 3, 1, 1, "jpeg", bytearray([1]))]
    img = spark.createDataFrame(rows, "bag_id long, ts_ns long, height int, width int, encoding string, data binary")
    got = {r.image_ts_ns: (r.r, r.g, r.b) for r in messages.pixels(img).collect()}
    assert got == {1: (1, 2, 3), 2: (3, 2, 1)}


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert math.isfinite(len(entry.queries()))


def test_cloud_folder_stops_at_the_vertex_count(spark, tmp_path):
    from waymark.sources import files

    rows = [f"{i}.5 {i} 0" for i in range(400)]
    head = ["ply", "format ascii 1.0", "element vertex 400", "property double x", "element face 2", "end_header"]
    (tmp_path / "12-500000000.ply").write_text("\n".join([*head, *rows, "3 0 1 2", "3 1 2 3"]) + "\n")
    (tmp_path / "13-0.xyz").write_text("1 2 3\n4 5 6\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = {}
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got[size] = sorted((r["name"], r["point_idx"], r["x"]) for r in files.read_cloud_folder(spark, str(tmp_path)).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted([("12-500000000", i, i + 0.5) for i in range(400)] + [("13-0", 0, 1.0), ("13-0", 1, 4.0)])
    assert got["128m"] == want and got["1k"] == want
