"""Odometry rates, tracking-loss cut-off and exact percentiles of large groups."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.operators.timejoin import BUCKET_NS, previous_sample
from waymark.session import cut

SKETCH = 10_000


def _with_marks(rows: DataFrame, marks: DataFrame, by: list[str]) -> DataFrame:
    return rows.join(marks, by) if by else rows.crossJoin(F.broadcast(marks))


def _narrowed(rows: DataFrame, marks: DataFrame, by: list[str], p: float, most: int, bins: int = 1024) -> DataFrame:
    """`marks` with brackets that hold at most `most` rows of a group, or one value: the rows of a wider bracket are counted in bins, and
    the bins that hold the wanted ranks are the next bracket."""
    while True:
        inside = (F.col("_lo").isNull() | (F.col("_v") >= F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi")))
        held = _with_marks(rows, marks, by)
        seen = cut(held.groupBy(*by).agg(
            F.first("_n").alias("_n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.sum((F.col("_v") < F.col("_lo")).cast("long")).alias("_c"),
            F.sum(inside.cast("long")).alias("_m"), F.min(F.when(inside, F.col("_v"))).alias("_a"), F.max(F.when(inside, F.col("_v"))).alias("_b")))
        wide = (F.col("_m") > most) & (F.col("_b") > F.col("_a"))
        if seen.filter(wide).isEmpty():
            return marks
        step = (F.col("_b") - F.col("_a")) / bins
        k = F.floor((F.col("_n") - 1) * F.lit(float(p)))
        counted = _with_marks(rows, seen.filter(wide), by).filter((F.col("_v") >= F.col("_a")) & (F.col("_v") <= F.col("_b"))).withColumn(
            "_bin", F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_a")) / step).cast("int"))).groupBy(*by, "_bin").agg(
            F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_x"), F.max("_v").alias("_y"), F.first("_n").alias("_n"), F.first(F.coalesce("_c", F.lit(0))).alias("_c"))
        run = counted.withColumn("_cum", F.col("_c") + F.sum("_k").over(Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        wanted = run.filter((F.col("_cum") > k) & (F.col("_cum") - F.col("_k") <= F.least(k + 1, F.col("_n") - 1)))
        next_ = wanted.groupBy(*by).agg(F.min("_x").alias("_p"), F.max("_y").alias("_q"))
        joined = seen.join(next_, by, "left") if by else seen.crossJoin(next_)
        marks = cut(joined.select(*by, "_n", F.coalesce("_p", "_lo").alias("_lo"), F.coalesce("_q", "_hi").alias("_hi")))


def exact_percentile(df: DataFrame, value: str, p: float, by: list[str], name: str = "value", most: int = 100_000) -> DataFrame:
    """Linear-interpolated percentile per group without holding a group in one task.

    A mergeable quantile sketch brackets the wanted ranks within a known rank error; values under the
    bracket are only counted, values in it are counted per distinct value, and the ranks are read
    from the running counts. A bracket that still holds more than about `most` rows is narrowed first. Groups too small for a bracket are counted whole. The group size is
    returned as `<name>_n`.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    slack = 3.0 / SKETCH
    low, high = max(0.0, p - slack), min(1.0, p + slack)
    marks = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", [low, high], SKETCH).alias("_q"),
    ).select(
        *by, "_n",
        F.when((F.col("_n") >= 2 * SKETCH) & F.lit(low > 0.0), F.col("_q")[0]).alias("_lo"),
        F.when((F.col("_n") >= 2 * SKETCH) & F.lit(high < 1.0), F.col("_q")[1]).alias("_hi"),
    )
    marks = cut(marks)
    # A bracket holds about 8 / SKETCH of its group; only groups far beyond `most` need another look.
    if (marks.agg(F.max("_n")).first()[0] or 0) * 8 > most * SKETCH:
        rows = cut(rows)
        marks = _narrowed(rows, marks, by, p, most)
    joined = _with_marks(rows, marks, by)
    binned = joined.filter(F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))).withColumn(
        "_v", F.when(F.col("_v") < F.col("_lo"), F.lit(float("-inf"))).otherwise(F.col("_v")))
    counts = binned.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = (F.col("_n") - 1) * F.lit(float(p))
    k = F.floor(rank)
    run = counts.withColumn("_cum", F.sum("_c").over(w))
    found = run.groupBy(*by).agg(
        F.first("_n").alias(f"{name}_n"),
        F.first(rank - k).alias("_f"),
        F.min(F.when(F.col("_cum") > k, F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_cum") > F.least(k + 1, F.col("_n") - 1), F.col("_v"))).alias("_b"),
    )
    return found.select(*by, f"{name}_n", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias(name))


def odom_rates(odom: DataFrame, bucket_ns: int = BUCKET_NS) -> DataFrame:
    """Speed (m/s) and turning rate (deg/s) of each sample against the one before; zero where time stands."""
    payload = [*rot.POSITION, *rot.QUAT]
    pairs = previous_sample(odom, payload, bucket_ns=bucket_ns).filter(F.col("prev").isNotNull())
    dt = (F.col("ts_ns") - F.col("prev.ts")) / 1e9
    move = rot.distance3(rot.POSITION, [f"prev.{c}" for c in rot.POSITION])
    turn = rot.relative_angle_deg([f"prev.{c}" for c in rot.QUAT], rot.QUAT)
    return pairs.select(
        "bag_id", F.col("prev.ts").alias("prev_ts_ns"), "ts_ns",
        F.when(dt > 0, move / dt).otherwise(F.lit(0.0)).alias("speed"),
        F.when(dt > 0, turn / dt).otherwise(F.lit(0.0)).alias("rate"),
    )


def loss_step(max_speed: float, max_rate_deg: float):
    """Fold step over (ts_ns, pose): (last good time, speed, rate) where a sample is further from the one before than the limits allow. A pair
    without time between its samples has no rate."""
    def step(state, row):
        if state is None or row[0] <= state[0]:
            return row, None
        dt = (row[0] - state[0]) / 1e9
        speed = math.dist(row[1:4], state[1:4]) / dt
        dot = sum(p * q for p, q in zip(row[4:], state[4:])) / (math.hypot(*row[4:]) * math.hypot(*state[4:]))
        rate = math.degrees(2.0 * math.acos(min(1.0, abs(dot)))) / dt
        return row, (state[0], speed, rate) if speed > max_speed or rate > max_rate_deg else None

    return step


def detect_odom_loss(odom: DataFrame, multiplier: float = 6.0, bucket_ns: int = BUCKET_NS) -> DataFrame:
    """Per log: cut-off time (last good sample before the first outlier pair), null if none.

    An outlier exceeds `multiplier` times the log's own 95th percentile of speed or rate; a zero
    baseline switches that test off, and fewer than three samples give no baseline.
    """
    rates = odom_rates(odom, bucket_ns)
    long = rates.select("bag_id", F.explode(F.create_map(
        F.lit("speed"), "speed", F.lit("rate"), "rate")).alias("kind", "v"))
    p95 = exact_percentile(long, "v", 0.95, ["bag_id", "kind"], "p95")
    base = p95.groupBy("bag_id").agg(
        F.max(F.when(F.col("kind") == "speed", F.col("p95"))).alias("speed_p95"),
        F.max(F.when(F.col("kind") == "rate", F.col("p95"))).alias("rate_p95"),
        F.max("p95_n").alias("_pairs"))
    bad_speed = (F.col("speed_p95") > 0) & (F.col("speed") > F.col("speed_p95") * multiplier)
    bad_rate = (F.col("rate_p95") > 0) & (F.col("rate") > F.col("rate_p95") * multiplier)
    flagged = rates.join(base, "bag_id").filter((F.col("_pairs") >= 2) & (bad_speed | bad_rate))
    first = flagged.groupBy("bag_id").agg(F.min("prev_ts_ns").alias("cutoff_ts_ns"))
    logs = odom.groupBy("bag_id").agg(F.count(F.lit(1)).alias("samples"))
    return logs.join(base.select("bag_id", "speed_p95", "rate_p95"), "bag_id", "left").join(first, "bag_id", "left")


def truncate_after(df: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Rows at or before their log's cut-off; logs without one keep everything."""
    cut_ = cutoffs.select("bag_id", "cutoff_ts_ns")
    joined = df.join(cut_, "bag_id", "left")
    keep = F.col("cutoff_ts_ns").isNull() | (F.col("ts_ns") <= F.col("cutoff_ts_ns"))
    return joined.filter(keep).select(*df.columns)
