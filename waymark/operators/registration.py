"""Odometry-anchored registration: health check, selection, poses, optional pair refinement."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.operators import gating, odometry, timejoin
from waymark.session import cut


@dataclass
class Registration:
    """`poses` move clouds into the world frame; `sensors` are the odometry poses of the selected frames that have one, which is where
    the sensor and the camera were whatever frame the cloud came in."""

    poses: DataFrame
    cutoffs: DataFrame | None
    sensors: DataFrame
    stages: dict[str, DataFrame] = field(default_factory=dict)


def log_modes(odom: DataFrame, mode: str | DataFrame) -> DataFrame:
    """(bag_id, frame_mode): one mode for all logs, or a table that names each log's, as `first_frame_id` decides it; logs that it
    does not list are local."""
    if isinstance(mode, str):
        return odom.select("bag_id").distinct().withColumn("frame_mode", F.lit(mode))
    return mode.select("bag_id", "frame_mode")


def register_frames(frames: DataFrame, odom: DataFrame, mode: str | DataFrame = "local", max_latency_ns: int = 500_000_000,
                    min_move: float = 0.10, min_rotation_deg: float = 5.0, max_frames: int = 0,
                    health_check: bool = True, loss_multiplier: float = 6.0,
                    bucket_ns: int = timejoin.BUCKET_NS) -> Registration:
    """World pose of each selected frame.

    Clouds already in a fixed frame (mode "global", for all logs or by log) are only gated, get unit poses and are not
    health-checked. Only frame keys and poses move through these steps, never points; the pose table is
    written once because selection, lookup and reports all read it.
    """
    frames = frames.select("bag_id", "ts_ns").distinct()
    stages = {"read": frames}
    fixed = cut(log_modes(odom, mode).filter("frame_mode = 'global'").select("bag_id").distinct())
    cutoffs = None
    if health_check:
        cutoffs = cut(odometry.detect_odom_loss(odom.join(fixed, "bag_id", "left_anti"), loss_multiplier, bucket_ns))
        frames = odometry.truncate_after(frames, cutoffs)
        odom = odometry.truncate_after(odom, cutoffs)
    stages["after_health_check"] = frames
    posed = cut(timejoin.interpolate_pose(frames, odom, max_latency_ns, bucket_ns=bucket_ns))
    kept = gating.motion_gate(posed, min_move, min_rotation_deg, max_frames)
    stages["selected"] = kept
    sensors = cut(posed.filter("px is not null").join(kept, ["bag_id", "ts_ns"]))
    unit = gating.identity_poses(kept.join(fixed, "bag_id", "left_semi"))
    poses = sensors.join(fixed, "bag_id", "left_anti").select("bag_id", "ts_ns", *timejoin.POSE).unionByName(unit)
    stages["with_pose"] = poses.select("bag_id", "ts_ns")
    return Registration(poses, cutoffs, sensors, stages)


def frame_pairs(poses: DataFrame, bucket_ns: int = timejoin.BUCKET_NS) -> DataFrame:
    """Consecutive posed frames with the motion between them (matrix g00.. and shift gx, gy, gz).

    The motion maps coordinates of the later frame into the earlier one.
    """
    pairs = timejoin.previous_sample(poses.select("bag_id", "ts_ns", *timejoin.POSE), timejoin.POSE, bucket_ns=bucket_ns)
    return _motions(pairs.filter("prev is not null").select(
        "bag_id", F.col("prev.ts").alias("to_ts"), F.col("ts_ns").alias("from_ts"),
        *[F.col(f"prev.{c}").alias(f"a_{c}") for c in timejoin.POSE], *[F.col(c).alias(f"b_{c}") for c in timejoin.POSE]))


def loop_candidates(poses: DataFrame, interval: int = 10, window: int = 100, radius: float = 3.0,
                    bucket_ns: int = timejoin.BUCKET_NS) -> DataFrame:
    """Pairs of search frames (every `interval`-th position, not the first) at most `window` positions and `radius` apart."""
    cols = [*timejoin.POSE]
    marked = timejoin.ordinal(poses.select("bag_id", "ts_ns", *cols), bucket_ns=bucket_ns, name="pos").withColumn("pos", F.col("pos") - 1)
    marked = cut(marked.filter((F.col("pos") % interval == 0) & (F.col("pos") > 0)))
    later = marked.select("bag_id", F.col("pos").alias("from_pos"), F.col("ts_ns").alias("from_ts"), *[F.col(c).alias(f"b_{c}") for c in cols])
    earlier = marked.select("bag_id", F.col("pos").alias("to_pos"), F.col("ts_ns").alias("to_ts"), *[F.col(c).alias(f"a_{c}") for c in cols])
    # every later frame lists the few search positions of its window, so the join is by equality
    steps = max(1, window // interval)
    later = later.withColumn("to_pos", F.explode(F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda s: F.col("from_pos") - s * interval)))
    near = later.join(earlier, ["bag_id", "to_pos"]).filter(
        rot.distance3([f"a_{c}" for c in rot.POSITION], [f"b_{c}" for c in rot.POSITION]) <= radius)
    return _motions(near, ["from_pos", "to_pos"])


GUESS = [f"g{i}{j}" for i in range(3) for j in range(3)] + ["gx", "gy", "gz"]


def _motions(pairs: DataFrame, keep=()) -> DataFrame:
    for side in "ab":
        m = rot.quat_to_matrix([f"{side}_{c}" for c in rot.QUAT])
        pairs = pairs.withColumns({f"{side}_{n}": c for n, c in m.items()})
    rel_m, rel_t = rot.relative_pose([f"a_{n}" for n in rot.MATRIX], [f"a_{c}" for c in rot.POSITION],
                                     [f"b_{n}" for n in rot.MATRIX], [f"b_{c}" for c in rot.POSITION])
    return pairs.select("bag_id", "to_ts", "from_ts", *keep, *[c.alias(g) for c, g in zip([*rel_m, *rel_t], GUESS)])


def icp_refine(points: DataFrame, pairs: DataFrame, dist: float = 0.2, normal_radius: float = 0.1, max_nn: int = 30,
               iterations: int = 50) -> DataFrame:
    """Point-to-plane alignment of every pair, all pairs in parallel.

    `points` holds voxelised scans in the sensor frame; a group is the two scans of one pair. Adds the
    refined motion (m00.. mz), fitness (share of matched points) and rmse.
    """
    pairs = cut(pairs)
    # By bytes a few tasks would do, but a pair is many rounds of work: so many tasks that all cores share it.
    spark = pairs.sparkSession
    count = pairs.count()
    tasks = max(1, min(count, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, count // 1000)))
    p = points.select("bag_id", "ts_ns", "x", "y", "z")
    moving = p.join(pairs.select("bag_id", "to_ts", F.col("from_ts").alias("ts_ns")), ["bag_id", "ts_ns"]).select(
        "bag_id", "to_ts", F.col("ts_ns").alias("from_ts"), F.lit(0).alias("role"), "x", "y", "z")
    still = p.join(pairs.select("bag_id", "from_ts", F.col("to_ts").alias("ts_ns")), ["bag_id", "ts_ns"]).select(
        "bag_id", F.col("ts_ns").alias("to_ts"), "from_ts", F.lit(1).alias("role"), "x", "y", "z")
    key = ["bag_id", "to_ts", "from_ts"]
    clouds = moving.unionByName(still)
    out = [f"m{i}{j}" for i in range(3) for j in range(3)] + ["mx", "my", "mz"]
    bag_type = pairs.schema["bag_id"].dataType.simpleString()
    schema = f"bag_id {bag_type}, to_ts long, from_ts long, " + ", ".join(f"{c} double" for c in [*GUESS, *out]) + \
        ", fitness double, rmse double"

    def align(pair: pd.DataFrame, cloud: pd.DataFrame) -> pd.DataFrame:
        if not len(pair):
            return pd.DataFrame(columns=[*key, *GUESS, *out, "fitness", "rmse"])
        row = pair.iloc[0]
        motion = np.eye(4)
        motion[:3, :3] = row[GUESS[:9]].to_numpy(float).reshape(3, 3)
        motion[:3, 3] = row[GUESS[9:]].to_numpy(float)
        xyz, role = cloud[["x", "y", "z"]].to_numpy(), cloud["role"].to_numpy()
        motion, fitness, rmse = point_to_plane(xyz[role == 0], xyz[role == 1], motion, dist, normal_radius, max_nn, iterations)
        done = {**{c: row[c] for c in [*key, *GUESS]}, **dict(zip(out, [*motion[:3, :3].ravel(), *motion[:3, 3]])),
                "fitness": fitness, "rmse": rmse}
        return pd.DataFrame([done])

    # fresh names, since both sides derive from the same pairs
    guesses = pairs.select(*[F.col(c).alias(c) for c in [*key, *GUESS]])
    return guesses.repartition(tasks, *key).groupBy(*key).cogroup(clouds.repartition(tasks, *key).groupBy(*key)).applyInPandas(align, schema)


class CellIndex:
    """Points in cells a little wider than `reach`, so that all points within it of a place lie in the 27 cells around."""

    def __init__(self, points: np.ndarray, reach: float):
        self.points, self.low = points, points.min(axis=0)
        span = points.max(axis=0) - self.low
        self.size = max(reach * (1 + 1e-9), span.max() / 1e6, 1e-12)
        self.last = np.floor(span / self.size).astype(np.int64)
        names = self._names(np.floor((points - self.low) / self.size).astype(np.int64))
        self.order = np.argsort(names, kind="stable")
        self.names = names[self.order]

    def _names(self, at: np.ndarray) -> np.ndarray:
        return ((at[..., 0] + 2) * (self.last[1] + 5) + at[..., 1] + 2) * (self.last[2] + 5) + at[..., 2] + 2

    def around(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, point, squared distance) of all points in the cells around each place, in order of place."""
        at = np.clip(np.nan_to_num(np.floor((places - self.low) / self.size), nan=-2.0), -2, self.last + 2).astype(np.int64)
        steps = np.array([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        column = np.concatenate([np.clip(at[:, None, :2] + steps, -2, self.last[:2] + 2), np.repeat(at[:, None, 2:], 9, axis=1)], axis=2)
        name = self._names(column)
        first, end = np.searchsorted(self.names, name - 1).ravel(), np.searchsorted(self.names, name + 1, "right").ravel()
        # A place beyond the box may be clipped to the same column thrice; only true columns count.
        end = np.where((column[..., :2] == at[:, None, :2] + steps).all(axis=2).ravel(), end, first)
        n = end - first
        place = np.repeat(np.arange(len(places)), n.reshape(-1, 9).sum(axis=1))
        point = self.order[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        gap = places[place] - self.points[point]
        return place, point, (gap ** 2).sum(axis=1)


#: Places looked up at once.
BLOCK = 4096


def surface_directions(points: np.ndarray, radius: float, max_nn: int) -> np.ndarray:
    """Direction of least spread of each point's `max_nn` nearest within `radius`, upright if they are fewer than three."""
    normals = np.tile([0.0, 0.0, 1.0], (len(points), 1))
    cells = CellIndex(points, radius)
    for s in range(0, len(points), BLOCK):
        place, point, d2 = cells.around(points[s:s + BLOCK])
        near = d2 <= radius * radius
        place, point, d2 = place[near], point[near], d2[near]
        order = np.lexsort((point, d2, place))
        place, point = place[order], point[order]
        names, first, count = np.unique(place, return_index=True, return_counts=True)
        count = np.minimum(count, max_nn)
        wide = np.flatnonzero(count >= 3)
        if not len(wide):
            continue
        spread = np.empty((len(wide), 3, 3))
        for i, w in enumerate(wide):
            held = points[point[first[w]:first[w] + count[w]]].T
            held = held - held.mean(axis=1)[:, None]
            spread[i] = held.dot(held.T) * (1.0 / count[w])
        normals[s + names[wide]] = np.linalg.eigh(spread)[1][:, :, 0]
    return normals


def _nearest_in(cells: CellIndex, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point in the cells around each place, the first of equals, and its squared distance (infinite if there is none)."""
    best, best_d2 = np.zeros(len(places), int), np.full(len(places), np.inf)
    for s in range(0, len(places), BLOCK):
        place, point, d2 = cells.around(places[s:s + BLOCK])
        if not len(place):
            continue
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        least = np.minimum.reduceat(d2, first)
        tied = np.where(d2 == np.repeat(least, np.diff(np.append(first, len(place)))), point, len(cells.points))
        best[s + place[first]], best_d2[s + place[first]] = np.minimum.reduceat(tied, first), least
    return best, best_d2


def point_to_plane(moving: np.ndarray, still: np.ndarray, motion: np.ndarray, dist: float, normal_radius: float,
                   max_nn: int, iterations: int) -> tuple[np.ndarray, float, float]:
    """Align `moving` to `still` from an initial 4x4 motion; returns (motion, fitness, rmse).

    Partners beyond `dist` do not count, so cells of half of it are asked first and cells of all of it for what found none there. The work
    grows with the points and their density, not with all pairs.
    """
    if not len(moving) or not len(still):
        return motion, 0.0, 0.0
    normals = surface_directions(still, normal_radius, max_nn)
    narrow, broad = CellIndex(still, dist / 2.0), CellIndex(still, dist)
    last = (-1.0, -1.0)
    fitness = rmse = 0.0
    for turn in range(iterations + 1):
        at = moving @ motion[:3, :3].T + motion[:3, 3]
        best, best_d2 = _nearest_in(narrow, at)
        open_ = np.flatnonzero(~(best_d2 <= dist * dist / 4.0))
        if len(open_):
            best[open_], best_d2[open_] = _nearest_in(broad, at[open_])
        hit = best_d2 <= dist * dist
        fitness = float(hit.mean())
        rmse = float(np.sqrt(best_d2[hit].mean())) if hit.any() else 0.0
        if turn == iterations or not hit.any() or (abs(fitness - last[0]) < 1e-6 and abs(rmse - last[1]) < 1e-6):
            break
        last = (fitness, rmse)
        p, q, n = at[hit], still[best[hit]], normals[best[hit]]
        lever = np.hstack([np.cross(p, n), n])
        step, *_ = np.linalg.lstsq(lever.T @ lever, -lever.T @ ((p - q) * n).sum(axis=1), rcond=None)
        a, b, c = step[:3]
        ca, sa, cb, sb, cc, sc = np.cos(a), np.sin(a), np.cos(b), np.sin(b), np.cos(c), np.sin(c)
        turn_m = np.array([[cc * cb, cc * sb * sa - sc * ca, cc * sb * ca + sc * sa],
                           [sc * cb, sc * sb * sa + cc * ca, sc * sb * ca - cc * sa], [-sb, cb * sa, cb * ca]])
        update = np.eye(4)
        update[:3, :3], update[:3, 3] = turn_m, step[3:]
        motion = update @ motion
    return motion, fitness, rmse


def gate_correction(refined: DataFrame, min_fitness: float = 0.7, max_shift: float = 0.3, max_turn_deg: float = 15.0) -> DataFrame:
    """`accepted` where the fit is good and the correction inverse(guess)·refined is small."""
    g, m = [c for c in GUESS[:9]], [f"m{i}{j}" for i in range(3) for j in range(3)]
    rel_m, rel_t = rot.relative_pose(g, GUESS[9:], m, ("mx", "my", "mz"))
    out = refined.withColumns({"shift": rot.norm3(*rel_t), "turn_deg": rot.trace_angle_deg(rel_m[0] + rel_m[4] + rel_m[8])})
    ok = (F.col("fitness") >= min_fitness) & (F.col("shift") <= max_shift) & (F.col("turn_deg") <= max_turn_deg)
    return out.withColumn("accepted", ok)


def refined_poses(poses: DataFrame, gated: DataFrame) -> DataFrame:
    """World pose per frame: earlier raw pose ∘ refined motion where accepted, else the raw pose.

    Refinements are never chained, so pairs stay independent. Gives matrix columns r00.. and px, py, pz.
    """
    m = rot.quat_to_matrix()
    raw = poses.select("bag_id", "ts_ns", *rot.POSITION, *[c.alias(n) for n, c in m.items()])
    base = raw.select("bag_id", F.col("ts_ns").alias("to_ts"), *[F.col(c).alias(f"b_{c}") for c in (*rot.POSITION, *rot.MATRIX)])
    good = gated.filter("accepted").join(base, ["bag_id", "to_ts"])
    new_m, new_t = rot.compose_pose([f"b_{n}" for n in rot.MATRIX], [f"b_{c}" for c in rot.POSITION],
                                    [f"m{i}{j}" for i in range(3) for j in range(3)], ("mx", "my", "mz"))
    moved = good.select("bag_id", F.col("from_ts").alias("ts_ns"), *[c.alias(f"n_{n}") for c, n in zip([*new_t, *new_m], [*rot.POSITION, *rot.MATRIX])])
    joined = raw.join(moved, ["bag_id", "ts_ns"], "left")
    return joined.select("bag_id", "ts_ns", *[F.coalesce(f"n_{n}", n).alias(n) for n in (*rot.POSITION, *rot.MATRIX)])
