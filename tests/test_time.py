import math

import pytest
from pyspark.sql import functions as F

from waymark.operators import gating, odometry, timejoin
from waymark.operators.fold import ordered_fold

S = 10**9
POSE = "px double, py double, pz double, qx double, qy double, qz double, qw double"


def odom(spark, rows):
    """rows: (bag, seconds, x, yaw degrees)"""
    data = [(b, int(t * S), float(x), 0.0, 0.0, 0.0, 0.0, math.sin(math.radians(a) / 2), math.cos(math.radians(a) / 2)) for b, t, x, a in rows]
    return spark.createDataFrame(data, f"bag_id long, ts_ns long, {POSE}")


def times(spark, rows):
    return spark.createDataFrame([(b, int(t * S)) for b, t in rows], "bag_id long, ts_ns long")


@pytest.mark.parametrize("bucket", [S, 3 * S, 3600 * S])
def test_pose_rules(spark, bucket):
    o = odom(spark, [(0, 1, 0.0, 0), (0, 11, 10.0, 90)])
    q = times(spark, [(0, 0.6), (0, 1), (0, 6), (0, 11.4), (0, 12), (0, 1.3), (1, 5)])
    got = {(r.bag_id, r.ts_ns / S): r for r in timejoin.interpolate_pose(q, o, S // 2, bucket_ns=bucket).collect()}
    assert got[0, 0.6].px == 0.0 and got[0, 1].px == 0.0 and got[0, 11.4].px == 10.0
    assert got[0, 6].px is None and got[0, 12].px is None and got[1, 5].px is None
    assert got[0, 1.3].px == pytest.approx(0.3)


def test_slerp_halfway(spark):
    o = odom(spark, [(0, 0, 0.0, 0), (0, 10, 10.0, 90)])
    r = timejoin.interpolate_pose(times(spark, [(0, 5)]), o, 10 * S).first()
    assert math.degrees(2 * math.atan2(r.qz, r.qw)) == pytest.approx(45.0)
    # the same rotation with the opposite sign takes the short way too
    o2 = o.withColumns({c: F.when(F.col("ts_ns") > 0, -F.col(c)).otherwise(F.col(c)) for c in ("qz", "qw")})
    r = timejoin.interpolate_pose(times(spark, [(0, 5)]), o2, 10 * S).first()
    assert abs(math.degrees(2 * math.atan2(r.qz, r.qw))) == pytest.approx(45.0)


def test_nearest_tie_takes_earlier(spark):
    m = timejoin.nearest_time(times(spark, [(0, 5)]), times(spark, [(0, 4), (0, 6)])).first()
    assert m["match"].ts == 4 * S
    strict = timejoin.nearest_time(times(spark, [(0, 5)]), times(spark, [(0, 4)]), tol_ns=S, strict=True).first()
    wide = timejoin.nearest_time(times(spark, [(0, 5)]), times(spark, [(0, 4)]), tol_ns=S).first()
    assert strict["match"] is None and wide["match"].ts == 4 * S


def test_nearest_seen_looks_back_only(spark):
    o = times(spark, [(0, 1), (0, 4), (0, 6)])
    assert timejoin.nearest_seen(times(spark, [(0, 5.9)]), o).first()["match"].ts == 4 * S
    assert timejoin.nearest_seen(times(spark, [(0, 6.5)]), o, offset_ns=-2 * S).first()["match"].ts == 4 * S


def test_ordinal_and_previous_cross_buckets(spark):
    t = times(spark, [(0, i * 0.7) for i in range(40)] + [(1, 3)])
    rn = {(r.bag_id, r.ts_ns): r.rn for r in timejoin.ordinal(t, bucket_ns=2 * S).collect()}
    assert [rn[0, int(i * 0.7 * S)] for i in range(40)] == list(range(1, 41))
    prev = timejoin.previous_sample(t, [], bucket_ns=S).filter("prev is null").count()
    assert prev == 2


def test_odom_loss(spark):
    steady = [(0, t, t * 1.0, 0) for t in range(60)]
    jump = steady + [(0, t, t * 1.0 + 500, 0) for t in range(60, 63)]
    assert odometry.detect_odom_loss(odom(spark, jump)).first().cutoff_ts_ns == 59 * S
    assert odometry.detect_odom_loss(odom(spark, steady)).first().cutoff_ts_ns is None
    assert odometry.detect_odom_loss(odom(spark, steady[:2])).first().cutoff_ts_ns is None
    still = [(0, t, 0.0, 0) for t in range(10)]
    assert odometry.detect_odom_loss(odom(spark, still)).first().cutoff_ts_ns is None


def test_exact_percentile_of_a_large_group(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(odometry, "SKETCH", 200)
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=4000), np.full(2000, 0.25)])
    df = spark.createDataFrame([(int(i % 2 == 0), float(x)) for i, x in enumerate(v)], "g int, v double")
    for p in (0.05, 0.5, 0.95):
        got = {r.g: r.q for r in odometry.exact_percentile(df, "v", p, ["g"], "q").collect()}
        for g in (0, 1):
            assert got[g] == pytest.approx(np.percentile([x for i, x in enumerate(v) if int(i % 2 == 0) == g], p * 100), abs=1e-12)


def sequential_gate(rows, move):
    last, out = None, []
    for b, t, x in rows:
        if last is None or abs(x - last) >= move:
            out.append(int(t * S))
            last = x
    return out


@pytest.mark.parametrize("partitions", [1, 2, 5, 9])
def test_motion_gate_is_sequential_over_partitions(spark, partitions):
    import random

    random.seed(5)
    x, rows = 0.0, []
    for t in range(300):
        x += random.random() * 0.09
        rows.append((0, t, x))
    frames = odom(spark, [(b, t, x, 0) for b, t, x in rows] + [(1, 5, 0.0, 0)])
    kept = gating.motion_gate(frames, 0.1, 0.0, partitions=partitions)
    assert sorted(r.ts_ns for r in kept.filter("bag_id = 0").collect()) == sequential_gate(rows, 0.1)
    assert kept.filter("bag_id = 1").count() == 1


def test_motion_gate_missing_pose_passes(spark):
    frames = odom(spark, [(0, 0, 0.0, 0), (0, 1, 0.06, 0), (0, 2, 0.12, 0), (0, 3, 0.18, 0), (0, 4, 0.24, 0)])
    assert [r.ts_ns // S for r in gating.motion_gate(frames, 0.1, 0).orderBy("ts_ns").collect()] == [0, 2, 4]
    holes = frames.withColumns({c: F.when(F.col("ts_ns") == S, None).otherwise(F.col(c)) for c in ("px", "qw")})
    assert [r.ts_ns // S for r in gating.motion_gate(holes, 0.1, 0).orderBy("ts_ns").collect()] == [0, 1, 2, 4]


def test_ordered_fold_running_sum(spark):
    df = spark.range(100).selectExpr("id % 3 as bag_id", "id as ts_ns", "cast(id as double) as v")

    def step(state, row):
        total = (state[0] if state else 0.0) + row[1]
        return (total,), (row[0], total)

    out = ordered_fold(df, ["bag_id"], ["ts_ns"], ["ts_ns", "v"], step, "ts_ns long, total double", partitions=7)
    for r in out.collect():
        assert r.total == sum(range(r.bag_id, r.ts_ns + 1, 3))


def test_percentiles_of_wide_brackets(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from waymark.operators import odometry

    df = spark.range(60_000).select((F.col("id") % 3).alias("bag_id"), F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(
        F.exp(F.rand(3) * 20) + F.col("id") % 3).alias("v")).cache()
    rows = df.toPandas()
    for p in (0.0, 0.37, 0.95, 1.0):
        for by, most in ((["bag_id"], 5), ([], 5), (["bag_id"], 100_000)):
            got = odometry.exact_percentile(df, "v", p, by, "q", most).collect()
            for r in got:
                part = rows[rows.bag_id == r["bag_id"]] if by else rows
                assert abs(r["q"] - np.percentile(part.v, p * 100)) <= 1e-9 * abs(r["q"])
            assert len(got) == (3 if by else 1)


def test_ordered_stream_carries_state_over_restarts_and_tells_late_rows(spark, tmp_path):
    import numpy as np

    from waymark.streaming.ordered import ordered_steps, run_split

    rng = np.random.default_rng(2)
    rows = [(int(b), int(t), float(v), False) for b in (1, 2) for t, v in enumerate(rng.normal(size=40))]
    arrived = sorted(rows, key=lambda x: x[1] + rng.uniform(0, 5))

    def land(part):
        spark.createDataFrame(part, "bag_id long, ts_ns long, v double, closing boolean").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def step(state, row):
        total = (state[0] if state else 0.0) + row[1]
        return (total,), (total,)

    def run():
        stream = spark.readStream.schema("bag_id long, ts_ns long, v double, closing boolean").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        run_split(ordered_steps(stream, step, "v double", "total double", "total double", 5), f"{tmp_path}/out", f"{tmp_path}/late", f"{tmp_path}/state")

    for part in (arrived[:20], arrived[20:50]):
        land(part)
    run()
    land(arrived[50:] + [(1, 0, 99.0, False), (1, 0, 98.0, False)])
    land([(1, 39, None, True), (2, 39, None, True)])
    run()  # goes on from the checkpoint
    got = {(r.bag_id, r.ts_ns): r.total for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    for b in (1, 2):
        want = np.cumsum([v for bag, _, v, _ in rows if bag == b])
        assert np.allclose([got[b, t] for t in range(40)], want)
    assert len(got) == 80 and [(r.bag_id, r.ts_ns) for r in spark.read.parquet(f"{tmp_path}/late").collect()] == [(1, 0), (1, 0)]


@pytest.fixture(scope="module")
def repeated_times(tmp_path_factory):
    """The smallest tables with a third of the events twice and a ninth three times."""
    import os

    import duckdb

    home, small = tmp_path_factory.mktemp("repeated"), "/root/testdata/sf0.001"
    for name in os.listdir(small):
        if name != "events.parquet":
            os.symlink(f"{small}/{name}", home / name)
    again = " ".join(f"UNION ALL SELECT * REPLACE (event_id + {k}000000 AS event_id) FROM e WHERE event_id % {3 ** k} = 0" for k in (1, 2))
    duckdb.execute(f"COPY (WITH e AS (FROM '{small}/events.parquet') SELECT * FROM e {again}) TO '{home}/events.parquet'")
    return str(home)


@pytest.mark.parametrize("name", ["decode_odometry", "pose_composition"])
def test_repeated_times_give_the_rows_of_the_sql(spark, repeated_times, name):
    from collections import Counter

    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS FROM '{repeated_times}/events.parquet'")
    df = entry.queries()[name](spark, repeated_times)
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    order = [[d[0] for d in con.description].index(c) for c in df.columns]
    rows = lambda it, at: Counter(tuple(round(r[i], 5) + 0.0 for i in at) for r in it)
    assert rows(df.collect(), range(len(order))) == rows(want, order)
