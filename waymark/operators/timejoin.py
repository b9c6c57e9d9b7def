"""As-of, nearest and interval matching on a time axis.

A whole log may be far larger than one task can sort, so every ordered step works on
(log, time bucket) groups. What has to cross bucket borders is the first and the last sample of
each bucket: those edges are aggregated map-side, carried along the log (one row per bucket) and
joined back. `bucket_ns` bounds a group by sensor rate times bucket width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.grid import NS_PER_S

BUCKET_NS = 3600 * NS_PER_S
BY = ("bag_id",)


def _bucket(ts: Column, bucket_ns: int) -> Column:
    return F.expr(f"_t div {int(bucket_ns)}L")


def _carry(edges: DataFrame, by) -> DataFrame:
    """For each bucket: the last sample of all earlier buckets and the first of all later ones."""
    back = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        *by, "_b",
        F.last("_hi", ignorenulls=True).over(back).alias("_before"),
        F.last("_lo", ignorenulls=True).over(ahead).alias("_after"),
    )


def bracket(queries: DataFrame, samples: DataFrame, payload=(), by=BY, ts: str = "ts_ns",
            sample_ts: str = "ts_ns", bucket_ns: int = BUCKET_NS) -> DataFrame:
    """Attach to each query row `prev` (last sample at or before it) and `next` (first at or after it).

    Both are structs (ts, *payload) or null. One shuffle of queries and samples together.
    """
    packed = F.struct(F.col(sample_ts).alias("ts"), *payload)
    smp = samples.select(*by, F.col(sample_ts).alias("_t"), packed.alias("_s"))
    qry = queries.select(*by, F.col(ts).alias("_t"), F.struct(*queries.columns).alias("_row"))
    both = smp.withColumn("_q", F.lit(0)).unionByName(
        qry.withColumn("_q", F.lit(1)), allowMissingColumns=True
    ).withColumn("_b", _bucket(F.col("_t"), bucket_ns))
    edges = both.groupBy(*by, "_b").agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    up = Window.partitionBy(*by, "_b").orderBy("_t", "_q")
    down = Window.partitionBy(*by, "_b").orderBy(F.desc("_t"), "_q")
    running = (Window.unboundedPreceding, Window.currentRow)
    inside = both.select(
        *by, "_b", "_row",
        F.last("_s", ignorenulls=True).over(up.rowsBetween(*running)).alias("_p"),
        F.last("_s", ignorenulls=True).over(down.rowsBetween(*running)).alias("_n"),
    ).filter(F.col("_row").isNotNull())
    joined = inside.join(_carry(edges, by), [*by, "_b"], "left")
    return joined.select(
        "_row.*",
        F.coalesce("_p", "_before").alias("prev"),
        F.coalesce("_n", "_after").alias("next"),
    )


def previous_sample(df: DataFrame, payload, by=BY, ts: str = "ts_ns", bucket_ns: int = BUCKET_NS,
                    name: str = "prev") -> DataFrame:
    """Attach the strictly preceding row of the same log as struct `prev` (null on the first)."""
    packed = F.struct(F.col(ts).alias("ts"), *payload)
    rows = df.withColumn("_t", F.col(ts)).withColumn("_b", _bucket(F.col("_t"), bucket_ns)).withColumn("_s", packed)
    edges = rows.groupBy(*by, "_b").agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    inside = rows.withColumn("_p", F.lag("_s").over(Window.partitionBy(*by, "_b").orderBy("_t")))
    joined = inside.join(_carry(edges, by).select(*by, "_b", "_before"), [*by, "_b"], "left")
    return joined.select(*df.columns, F.coalesce("_p", "_before").alias(name))


def ordinal(df: DataFrame, by=BY, ts: str = "ts_ns", bucket_ns: int = BUCKET_NS, name: str = "rn") -> DataFrame:
    """1-based position of each row within its log in time order."""
    rows = df.withColumn("_t", F.col(ts)).withColumn("_b", _bucket(F.col("_t"), bucket_ns))
    sizes = rows.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*by, "_b", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"))
    inside = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_t")))
    return inside.join(sizes, [*by, "_b"]).select(*df.columns, (F.col("_rn") + F.col("_before")).alias(name))


def latest_per_key(df: DataFrame, by=BY, ts: str = "ts_ns", order: str = "seq") -> DataFrame:
    """One row per (log, time): the last in stream order wins, as in a keyed table."""
    keys = [*by, ts]
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(order, *[c for c in rest if c != order])
    return df.groupBy(*keys).agg(F.max(packed).alias("_m")).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest])


POSE = (*rot.POSITION, *rot.QUAT)


def interpolate_pose(queries: DataFrame, odom: DataFrame, max_latency_ns: int, by=BY, ts: str = "ts_ns",
                     bucket_ns: int = BUCKET_NS, keep_uncovered: bool = True) -> DataFrame:
    """Pose at each query time: linear position, shortest-arc rotation between bracketing samples.

    An exact hit gives the sample; outside coverage the end sample is used if within
    `max_latency_ns`; between samples the pose is missing only if both gaps are wider than that.
    """
    b = bracket(queries, odom, POSE, by, ts, "ts_ns", bucket_ns)
    t, p, n = F.col(ts), F.col("prev.ts"), F.col("next.ts")
    before_gap, after_gap = t - p, n - t
    lone = F.when(p.isNull() & (after_gap <= max_latency_ns), F.lit("next")).when(
        n.isNull() & (before_gap <= max_latency_ns), F.lit("prev"))
    how = (
        F.when(p.isNull() | n.isNull(), lone)
        .when(before_gap == 0, F.lit("prev"))
        .when(after_gap == 0, F.lit("next"))
        .when((before_gap > max_latency_ns) & (after_gap > max_latency_ns), F.lit(None))
        .otherwise(F.lit("mix"))
    )
    b = b.withColumn("_how", how).withColumn(
        "_f", F.when(n > p, before_gap.cast("double") / (n - p).cast("double")))
    turned = [f"_q{i}" for i in range(4)]
    b = rot.with_slerp(b, [f"prev.{c}" for c in rot.QUAT], [f"next.{c}" for c in rot.QUAT], "_f", turned)
    mixed = {c: F.col(q) for c, q in zip(rot.QUAT, turned)}
    for c in rot.POSITION:
        mixed[c] = rot.lerp(f"prev.{c}", f"next.{c}", F.col("_f"))
    pose = [
        F.when(F.col("_how") == "prev", F.col(f"prev.{c}"))
        .when(F.col("_how") == "next", F.col(f"next.{c}"))
        .when(F.col("_how") == "mix", mixed[c]).alias(c)
        for c in POSE
    ]
    out = b if keep_uncovered else b.filter(F.col("_how").isNotNull())
    # a generator keeps later filters from being rewritten over the whole rotation arithmetic
    return out.select(*queries.columns, F.inline(F.array(F.struct(*pose))))


def nearest_time(left: DataFrame, right: DataFrame, payload=(), by=BY, ts: str = "ts_ns", right_ts: str = "ts_ns",
                 tol_ns: int | None = None, strict: bool = False, name: str = "match",
                 bucket_ns: int = BUCKET_NS, keep_unmatched: bool = True) -> DataFrame:
    """Attach the sample nearest in time as a struct; the earlier wins a tie."""
    b = bracket(left, right, payload, by, ts, right_ts, bucket_ns)
    t = F.col(ts)
    before, after = t - F.col("prev.ts"), F.col("next.ts") - t
    pick = F.when(after.isNull() | (before <= after), F.col("prev")).otherwise(F.col("next"))
    out = b.withColumn(name, pick)
    if tol_ns is not None:
        gap = F.abs(t - F.col(f"{name}.ts"))
        ok = gap < tol_ns if strict else gap <= tol_ns
        out = out.withColumn(name, F.when(ok, F.col(name)))
    if not keep_unmatched:
        out = out.filter(F.col(name).isNotNull())
    return out.select(*left.columns, name)


def nearest_seen(left: DataFrame, right: DataFrame, payload=(), by=BY, offset_ns: int = 0, name: str = "match",
                 bucket_ns: int = BUCKET_NS) -> DataFrame:
    """Nearest sample to (time + offset) among those that precede the row in the stream.

    The stream is read in time order, so with a non-negative offset the last sample seen is the
    nearest; with a negative one the bracket lies in the past and its far end counts only if seen.
    """
    shifted = left.withColumn("_look", F.col("ts_ns") + F.lit(min(0, offset_ns)))
    b = bracket(shifted, right, payload, by, "_look", "ts_ns", bucket_ns)
    aim = F.col("ts_ns") + F.lit(offset_ns)
    seen = F.col("next.ts") <= F.col("ts_ns")
    nearer = (F.col("next.ts") - aim) < (aim - F.col("prev.ts"))
    pick = F.when(F.col("prev").isNull(), F.when(seen, F.col("next"))).when(seen & nearer, F.col("next")).otherwise(
        F.col("prev"))
    return b.select(*left.columns, pick.alias(name))


def within_time(left: DataFrame, right: DataFrame, tol_ns: int, by=BY, how: str = "left_semi",
                right_payload=()) -> DataFrame:
    """Rows of `left` with a `right` row at most `tol_ns` away (`left_semi`), or all such pairs (`inner`).

    Equi-join on time slots of width `tol_ns`; the right side is listed in its slot and both neighbours.
    """
    lhs = left.withColumn("_slot", F.expr(f"ts_ns div {int(max(tol_ns, 1))}L"))
    rhs = right.select(*by, F.col("ts_ns").alias("other_ts_ns"), *right_payload).distinct()
    rhs = rhs.withColumn("_s0", F.expr(f"other_ts_ns div {int(max(tol_ns, 1))}L")).withColumn(
        "_slot", F.explode(F.sequence(F.col("_s0") - 1, F.col("_s0") + 1))).drop("_s0")
    near = F.abs(lhs["ts_ns"] - rhs["other_ts_ns"]) <= tol_ns
    on = [lhs[c] == rhs[c] for c in (*by, "_slot")] + [near]
    joined = lhs.join(rhs, on, how)
    if how == "left_semi":
        return joined.select(*left.columns)
    return joined.select(*[lhs[c] for c in left.columns], rhs["other_ts_ns"], *[rhs[c] for c in right_payload])
