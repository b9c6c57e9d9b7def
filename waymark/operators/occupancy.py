"""Ray-cast voxel occupancy, ground heights and two-dimensional occupancy grids."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.grid import NS_PER_S, cell, cell_center, cell_trunc
from waymark.operators import graph
from waymark.session import cut

# Sensor model probabilities of a hit, a miss, the clamping bounds and the decision.
P_HIT, P_MISS = 0.7, 0.4
P_MIN, P_MAX = 0.1192, 0.971
P_OCCUPIED = 0.5


def log_odds(p: float) -> float:
    return math.log(p / (1.0 - p))


KEY = ("kx", "ky", "kz")


WALK = 1_000_000  # plane crossings handled at once


def ray_cells(rays: DataFrame, res: float, max_range: float) -> DataFrame:
    """Voxels each ray passes: (bag_id, ts_ns, kx, ky, kz, hit).

    A ray runs from the origin (ox, oy, oz) to the point; all voxels on the way are free, the one of the
    point is hit. Beyond `max_range` (if positive) it stops there without a hit. The crossings of the
    grid planes are listed and sorted for all rays of a batch at once; voxels lie between consecutive
    ones. Repeats within a batch are dropped before anything is shuffled.
    """
    slim = rays.select("bag_id", "ts_ns", "ox", "oy", "oz", "x", "y", "z")
    bag_type = slim.schema["bag_id"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin = np.column_stack([batch.column(f"o{a}").to_numpy() for a in "xyz"])
            point = np.column_stack([batch.column(a).to_numpy() for a in "xyz"])
            step = point - origin
            length = np.sqrt((step * step).sum(axis=1))
            hit = np.ones(len(step), bool) if max_range <= 0 else length <= max_range
            step = np.where(hit[:, None], step, step * (max_range / np.maximum(length, 1e-300))[:, None])
            end = np.where(hit[:, None], point, origin + step)
            first, last = np.floor(origin / res).astype(np.int64), np.floor(end / res).astype(np.int64)
            load = np.cumsum(np.abs(last - first).sum(axis=1) + 2)
            cuts = np.searchsorted(load, np.arange(WALK, load[-1] if len(load) else 0, WALK))
            for rows in np.split(np.arange(len(step)), np.unique(cuts)):
                if not len(rows):
                    continue
                ray, key, struck = _walk(origin[rows], step[rows], first[rows], last[rows], hit[rows], res)
                if not len(ray):
                    continue
                # one row per scan and voxel of this batch, hits first
                take = pa.array(rows[ray])
                scan = pa.table({"bag_id": batch.column("bag_id").take(take), "ts_ns": batch.column("ts_ns").take(take),
                                 "kx": key[:, 0], "ky": key[:, 1], "kz": key[:, 2], "hit": struck.astype(np.int32)})
                once = scan.group_by(["bag_id", "ts_ns", *KEY]).aggregate([("hit", "max")]).rename_columns(
                    ["bag_id", "ts_ns", *KEY, "hit"])
                yield from once.combine_chunks().to_batches()

    return slim.mapInArrow(walk, f"bag_id {bag_type}, ts_ns long, kx long, ky long, kz long, hit int")


def _walk(origin, step, first, last, hit, res):
    """Rows (ray index, voxel, struck) of a few rays."""
    ray_of, at = [np.arange(len(step))], [np.zeros(len(step))]
    for axis in range(3):
        low = np.minimum(first[:, axis], last[:, axis]) + 1
        count = np.abs(last[:, axis] - first[:, axis])
        ray = np.repeat(np.arange(len(step)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        plane = (low[ray] + offset) * res
        ray_of.append(ray)
        at.append((plane - origin[ray, axis]) / step[ray, axis])
    ray, t = np.concatenate(ray_of), np.concatenate(at)
    order = np.lexsort((t, ray))
    ray, t = ray[order], t[order]
    following = np.where(np.append(ray[1:] == ray[:-1], False), np.append(t[1:], 1.0), 1.0)
    middle = (t + following) / 2.0
    key = np.floor((origin[ray] + step[ray] * middle[:, None]) / res).astype(np.int64)
    free = (key != last[ray]).any(axis=1)
    struck = np.flatnonzero(hit)
    return (np.concatenate([ray[free], struck]), np.concatenate([key[free], last[struck]]),
            np.concatenate([np.zeros(int(free.sum()), bool), np.ones(len(struck), bool)]))


def scan_voxels(rays: DataFrame, res: float, max_range: float) -> DataFrame:
    """One observation per scan and voxel; a hit beats the misses of the same scan."""
    return ray_cells(rays, res, max_range).groupBy("bag_id", "ts_ns", *KEY).agg(F.max("hit").alias("hit"))


def voxel_log_odds(scans: DataFrame, bucket_ns: int = 600 * NS_PER_S) -> DataFrame:
    """Clamped log-odds per voxel after all scans in time order.

    A run of clamped additions is itself one clamped addition (sum, low, high), so each time bucket is
    reduced on its own and the buckets are chained; no voxel gathers more than a bucket of scans.
    """
    up, down, low, high = log_odds(P_HIT), log_odds(P_MISS), log_odds(P_MIN), log_odds(P_MAX)
    obs = scans.withColumn("_b", F.expr(f"ts_ns div {int(bucket_ns)}L"))
    runs = obs.groupBy("bag_id", *KEY, "_b").agg(F.array_sort(F.collect_list(F.struct("ts_ns", "hit"))).alias("_o"))

    def add(acc, o):
        d = F.when(o["hit"] == 1, F.lit(up)).otherwise(F.lit(down))
        return F.struct((acc["s"] + d).alias("s"), rot.clipped(acc["lo"] + d, low, high).alias("lo"),
                        rot.clipped(acc["hi"] + d, low, high).alias("hi"))

    start = F.struct(F.lit(0.0).alias("s"), F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"))
    runs = runs.select("bag_id", *KEY, "_b", F.aggregate("_o", start, add).alias("_r"))
    chain = runs.groupBy("bag_id", *KEY).agg(F.array_sort(F.collect_list(F.struct("_b", "_r"))).alias("_c"))

    def apply(x, c):
        return F.greatest(c["_r"]["lo"], F.least(c["_r"]["hi"], x + c["_r"]["s"]))

    return chain.select("bag_id", *KEY, F.aggregate("_c", F.lit(0.0), apply).alias("log_odds"))


def occupancy(rays: DataFrame, res: float, max_range: float = 40.0) -> DataFrame:
    return voxel_log_odds(scan_voxels(rays, res, max_range))


def ground_height(ground: DataFrame, extents: DataFrame, res: float) -> DataFrame:
    """Mean ground height per raster cell of each log."""
    e = extents.select("bag_id", "min_x", "min_y", "x_size", "y_size")
    g = ground.join(e, "bag_id").withColumns({"gx": cell_trunc("x", res, "min_x"), "gy": cell_trunc("y", res, "min_y")})
    inside = (F.col("gx") >= 0) & (F.col("gx") < F.col("x_size")) & (F.col("gy") >= 0) & (F.col("gy") < F.col("y_size"))
    return g.filter(inside).groupBy("bag_id", "gx", "gy").agg(F.avg("z").alias("z"))


def raster_cells(extents: DataFrame) -> DataFrame:
    """All cells of every log's raster; columns are spread over tasks before rows are listed."""
    cols = extents.select("bag_id", "x_size", "y_size", F.explode(F.sequence(F.lit(0), F.col("x_size") - 1)).alias("gx"))
    cols = cols.repartition("bag_id", "gx")
    return cols.select("bag_id", F.col("gx").cast("long").alias("gx"), "x_size",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("y_size").cast("long") - 1)).alias("gy"))


#: Raster cells of a strip of columns, which one task fills.
STRIP_CELLS = 1 << 18


def nearest_rows(far: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """For each column x and place y < `size` the row r with the least (y - at[r])² + far[x, r], the first of equals.

    The best row never falls as y grows, so places are answered from coarse to fine between the answers of their neighbours: the lower
    envelope of the columns' parabolas in logarithmically many passes over arrays.
    """
    columns, rows = far.shape
    best = np.zeros((columns, size), np.int64)
    step = 1 << max(0, size - 1).bit_length()
    done = np.zeros(0, np.int64)
    while step:
        todo = np.setdiff1d(np.arange(0, size, step), done)
        if len(todo):
            low = np.where(todo >= step, best[:, np.maximum(todo - step, 0)], 0)
            high = np.where(todo + step < size, best[:, np.minimum(todo + step, size - 1)], rows - 1) if len(done) else np.full((columns, len(todo)), rows - 1)
            low = low if len(done) else np.zeros_like(low)
            n = (high - low + 1).ravel()
            first = np.cumsum(n) - n
            r = np.repeat(low.ravel() - first, n) + np.arange(n.sum())
            x = np.repeat(np.arange(columns), n.reshape(columns, -1).sum(1))
            cost = (np.repeat(np.tile(todo, columns), n) - at[r]) ** 2 + far[x, r]
            least = np.repeat(np.minimum.reduceat(cost, first), n)
            best[:, todo] = np.minimum.reduceat(np.where(cost == least, r, rows), first).reshape(columns, -1)
            done = np.union1d(done, todo)
        step //= 2
    return best


def _fill_strip(key: tuple, table: pa.Table) -> pa.Table:
    """Heights of all cells of a strip, from its known cells and the next ones beyond it in each row."""
    gx, gy, z = (table.column(c).to_numpy() for c in ("gx", "gy", "z"))
    left, right, tall = (table.column(c)[0].as_py() for c in ("left", "right", "y_size"))
    order = np.lexsort((gx, gy))
    gx, gy, z = gx[order], gy[order], z[order]
    at, row = np.unique(gy, return_inverse=True)
    x = np.arange(left, right)
    # Nearest known cell within each row: the last up to x or the first beyond it, the left one if both are as near.
    names, ask = row * (1 << 40) + gx, np.arange(len(at))[None] * (1 << 40) + x[:, None]
    after = np.searchsorted(names, ask, "right")
    before = np.maximum(after - 1, 0)
    after = np.minimum(after, len(names) - 1)
    none = 1 << 31
    d_before = np.where((row[before] == np.arange(len(at))) & (gx[before] <= x[:, None]), x[:, None] - gx[before], none)
    d_after = np.where((row[after] == np.arange(len(at))) & (gx[after] > x[:, None]), gx[after] - x[:, None], none)
    chosen = np.where(d_before <= d_after, before, after)
    best = nearest_rows(np.minimum(d_before, d_after).astype(np.int64) ** 2, at, tall)
    height = z[np.take_along_axis(chosen, best, 1)]
    return pa.table({"bag_id": pa.array([key[0].as_py()] * height.size, table.schema.field("bag_id").type), "gx": np.repeat(x, tall),
                     "gy": np.tile(np.arange(tall), len(x)), "z": height.ravel()})


def fill_ground(known: DataFrame, ground: DataFrame, extents: DataFrame, cells: int = STRIP_CELLS) -> DataFrame:
    """Height for every raster cell: its own mean or that of the nearest known cell (lowest row-major index on a tie).

    An exact distance transform: nearest cells within rows, then over rows. A log's raster is dealt to strips of columns of about
    `cells` cells; a strip needs its own known cells and, in each row, the next ones on both sides. Fewer than three known cells give the lowest
    ground point everywhere; no ground at all gives zero.
    """
    known = cut(known)
    low = ground.groupBy("bag_id").agg(F.min("z").alias("_low"))
    count = known.groupBy("bag_id").agg(F.count(F.lit(1)).alias("_k"))
    logs = cut(extents.select("bag_id", "x_size", "y_size").join(low, "bag_id", "left").join(count, "bag_id", "left"))
    flat = raster_cells(logs.filter(F.coalesce("_k", F.lit(0)) < 3)).join(logs.select("bag_id", "_low"), "bag_id").select(
        "bag_id", "gx", "gy", F.coalesce("_low", F.lit(0.0)).alias("z"))
    wide = logs.filter("_k >= 3").select("bag_id", "x_size", "y_size", F.greatest(F.lit(1), F.floor(F.lit(cells) / F.col("y_size"))).cast("long").alias("wide"))
    own = cut(known.join(wide, "bag_id").withColumn("strip", F.floor(F.col("gx") / F.col("wide"))))
    ends = own.groupBy("bag_id", "gy", "strip").agg(F.min(F.struct("gx", "z")).alias("first"), F.max(F.struct("gx", "z")).alias("last"))
    rows = own.select("bag_id", "gy").distinct().join(wide, "bag_id").withColumn(
        "strip", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("x_size") - 1) / F.col("wide")))))
    along = Window.partitionBy("bag_id", "gy").orderBy("strip")
    beyond = rows.join(ends, ["bag_id", "gy", "strip"], "left").select("bag_id", "gy", "strip", "x_size", "y_size", "wide", F.array(
        F.last("last", True).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.first("first", True).over(along.rowsBetween(1, Window.unboundedFollowing))).alias("n"))
    beyond = beyond.withColumn("n", F.explode("n")).filter("n is not null").withColumns({"gx": F.col("n.gx"), "z": F.col("n.z")})
    names = ("bag_id", "gx", "gy", "z", "x_size", "y_size", "wide", "strip")
    held = own.select(*names).unionByName(beyond.select(*names)).select(
        "bag_id", "strip", "gx", "gy", "z", F.col("y_size").cast("long").alias("y_size"), (F.col("strip") * F.col("wide")).alias("left"),
        F.least(F.col("x_size").cast("long"), (F.col("strip") + 1) * F.col("wide")).alias("right"))
    bag = known.schema["bag_id"].dataType.simpleString()
    filled = held.groupBy("bag_id", "strip").applyInArrow(_fill_strip, f"bag_id {bag}, gx long, gy long, z double")
    return filled.unionByName(flat)


OCCUPIED, UNKNOWN, FREE = 0, 127, 254


def occupancy_grid(heights: DataFrame, voxels: DataFrame, extents: DataFrame, grid_res: float, voxel_res: float,
                   z_min: float, z_max: float) -> DataFrame:
    """Cell value from the voxels above it: any occupied 0, else any known 254, else 127.

    Heights are sampled evenly between z_min and z_max over the ground, at least seven times and at
    least once per `grid_res`; each voxel is looked up once.
    """
    samples = max(7, math.ceil((z_max - z_min) / grid_res) + 1)
    step = (z_max - z_min) / (samples - 1)
    e = extents.select("bag_id", "min_x", "min_y")
    cells = heights.join(e, "bag_id")
    ladder = F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: cell(F.col("z") + z_min + i * step, voxel_res)))
    looked = cells.select("bag_id", "gx", "gy", cell(cell_center("gx", grid_res, "min_x"), voxel_res).alias("kx"),
                          cell(cell_center("gy", grid_res, "min_y"), voxel_res).alias("ky"), F.explode(ladder).alias("kz"))
    met = looked.join(voxels, ["bag_id", *KEY], "left")
    known = F.col("log_odds").isNotNull()
    occupied = F.coalesce(F.col("log_odds") >= log_odds(P_OCCUPIED), F.lit(False))
    state = met.groupBy("bag_id", "gx", "gy").agg(F.bool_or(occupied).alias("o"), F.bool_or(known).alias("k"))
    value = F.when(F.col("o"), OCCUPIED).when(F.col("k"), FREE).otherwise(UNKNOWN)
    return state.select("bag_id", "gx", "gy", value.alias("value"))


def _around(cells: DataFrame) -> DataFrame:
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    return cells.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).withColumns(
        {"gx": F.col("gx") + F.col("_i"), "gy": F.col("gy") + F.col("_j")}).drop("_i", "_j")


def close_cells(cells: DataFrame, extents: DataFrame, iterations: int) -> DataFrame:
    """Grow by one cell `iterations` times, then shrink as often; cells off the raster count as empty."""
    size = extents.select("bag_id", "x_size", "y_size")
    out = cells.select("bag_id", "gx", "gy")
    for _ in range(iterations):
        inside = (F.col("gx") >= 0) & (F.col("gy") >= 0) & (F.col("gx") < F.col("x_size")) & (F.col("gy") < F.col("y_size"))
        out = _around(out).join(size, "bag_id").filter(inside).select("bag_id", "gx", "gy").distinct()
    for _ in range(iterations):
        out = _around(out).groupBy("bag_id", "gx", "gy").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 9).drop("_n")
    return out


def cell_components(cells: DataFrame) -> DataFrame:
    """Eight-neighbour components: (bag_id, gx, gy, label)."""
    ids = cells.select("bag_id", "gx", "gy", (F.col("gy") * (1 << 31) + F.col("gx")).alias("id"))
    around = _around(ids.withColumn("u", F.col("id")).drop("id"))
    target = ids.select(*[F.col(c).alias(c) for c in ("bag_id", "gx", "gy")], F.col("id").alias("v"))
    edges = around.join(target, ["bag_id", "gx", "gy"]).filter("u <> v").select("bag_id", "u", "v")
    labels = graph.components(ids, edges)
    return ids.join(labels, ["bag_id", "id"]).select("bag_id", "gx", "gy", "label")


def filter_small_clusters(grid: DataFrame, extents: DataFrame, min_size: int, closing: int) -> DataFrame:
    """Occupied clusters (after closing gaps) under `min_size` cells become unknown, larger ones occupied as a whole."""
    if min_size <= 0:
        return grid
    grid = cut(grid)
    closed = cut(close_cells(grid.filter(F.col("value") == OCCUPIED), extents, closing))
    labels = cell_components(closed)
    sizes = graph.component_sizes(labels)
    judged = labels.join(sizes, ["bag_id", "label"]).select(
        "bag_id", "gx", "gy", F.when(F.col("size") < min_size, UNKNOWN).otherwise(OCCUPIED).alias("_v"))
    return grid.join(judged, ["bag_id", "gx", "gy"], "left").select("bag_id", "gx", "gy", F.coalesce("_v", "value").alias("value"))


def map_metadata(extents: DataFrame, res: float) -> DataFrame:
    return extents.select("bag_id", F.lit(float(res)).alias("resolution"), F.col("min_x").alias("origin_x"),
                          F.col("min_y").alias("origin_y"), F.lit(0.0).alias("origin_z"), F.lit(0).alias("negate"),
                          F.lit(0.65).alias("occupied_thresh"), F.lit(0.25).alias("free_thresh"), "x_size", "y_size")


def pgm_rows(grid: DataFrame, extents: DataFrame) -> DataFrame:
    """Text raster rows, top row (largest y) first in `row` order; missing cells are unknown."""
    cells = raster_cells(extents).join(grid, ["bag_id", "gx", "gy"], "left")
    rows = cells.groupBy("bag_id", "gy").agg(
        F.array_sort(F.collect_list(F.struct("gx", F.coalesce("value", F.lit(UNKNOWN)).alias("v")))).alias("_r"))
    line = F.array_join(F.transform("_r", lambda c: c["v"].cast("string")), " ")
    joined = rows.join(extents.select("bag_id", "y_size"), "bag_id")
    return joined.select("bag_id", (F.col("y_size") - 1 - F.col("gy")).alias("row"), line.alias("line"))


def write_pgm(grid: DataFrame, extents: DataFrame, path: str) -> None:
    """Sorted text rows per log, header lines in row -1."""
    head = extents.select("bag_id", F.lit(-1).cast("long").alias("row"),
                          F.format_string("P2\n%d %d\n255", "x_size", "y_size").alias("line"))
    out = pgm_rows(grid, extents).unionByName(head)
    out.repartitionByRange("bag_id", "row").sortWithinPartitions("bag_id", "row").select("bag_id", "line").write.partitionBy(
        "bag_id").mode("overwrite").text(path)
