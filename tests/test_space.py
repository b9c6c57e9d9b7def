import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.functions import eigen
from waymark.functions.color import is_gray
from waymark.operators import graph, mesh, occupancy, outliers, points as pts, registration, spacejoin, views
from waymark.plans import jobs
from waymark.session import cut


def cloud(spark, xyz, bag=0):
    return spark.createDataFrame([(bag, i, *map(float, p)) for i, p in enumerate(xyz)],
                                 "bag_id long, point_idx long, x double, y double, z double")


@pytest.fixture(scope="module")
def clumpy():
    """A tight clump with a third of the points, copies of one point, a sheet and lone points."""
    rng = np.random.default_rng(11)
    clump = rng.normal(scale=0.01, size=(300, 3)) + 5
    copies = np.tile([[1.0, 1.0, 1.0]], (150, 1))
    sheet = np.column_stack([rng.uniform(-10, 10, (400, 2)), np.zeros(400)])
    lone = rng.uniform(-60, 60, (50, 3))
    return np.round(np.concatenate([clump, copies, sheet, lone]), 6)


def test_counts_match_brute_force(spark, clumpy):
    d2 = ((clumpy[:, None] - clumpy[None]) ** 2).sum(-1)
    for radius in (0.02, 1.3):
        want = (d2 <= radius * radius).sum(1)
        c = cloud(spark, clumpy)
        got = {r.point_idx: r.hits for r in spacejoin.neighbours_within(c, c, radius).collect()}
        assert [got[i] for i in range(len(clumpy))] == want.tolist()
        flag = {r.point_idx: r.ok for r in spacejoin.neighbours_within(c, c, radius, 7, flag="ok").collect()}
        assert [flag[i] for i in range(len(clumpy))] == (want >= 7).tolist()


@pytest.mark.parametrize("k,leaf", [(1, 512), (4, 32), (20, 64)])
def test_nearest_matches_brute_force(spark, clumpy, monkeypatch, k, leaf):
    monkeypatch.setattr(spacejoin, "LEAF", leaf)
    monkeypatch.setattr(spacejoin, "GROUP", 200)
    monkeypatch.setattr(spacejoin, "QUERIES", 16)
    c = cloud(spark, clumpy)
    got = {r.point_idx: r.neighbours for r in spacejoin.nearest(c, c, k, 0.05).collect()}
    d2 = np.zeros((len(clumpy), len(clumpy)))
    for a in range(3):
        d2 += (clumpy[:, a, None] - clumpy[None, :, a]) ** 2
    for i in range(len(clumpy)):
        order = np.lexsort((np.arange(len(clumpy)), d2[i]))[:k]
        assert [n.id for n in got[i]] == order.tolist()


def test_nearest_fewer_than_k(spark):
    c = cloud(spark, [[0, 0, 0], [1, 0, 0]])
    assert all(len(r.neighbours) == 2 for r in spacejoin.nearest(c, c, 5, 0.5).collect())


def test_outliers_and_clean(spark):
    rng = np.random.default_rng(2)
    body = rng.uniform(0, 2, (800, 3))
    c = cloud(spark, np.concatenate([body, [[30.0, 0, 0], [0, 40.0, 0]]]))
    assert outliers.radius_outlier(c, 5, 0.6).filter("x > 20 or y > 20").count() == 0
    out = outliers.statistical_outlier(c, 10, 2.0, 0.5)
    assert out.filter("x > 20 or y > 20").count() == 0 and out.count() > 700
    alone = cloud(spark, [[0, 0, 0], [9, 9, 9]], bag=1)
    cleaned = outliers.clean_points(c.unionByName(alone), 0.2)
    assert cleaned.filter("bag_id = 1").count() == 2  # every stage would empty it
    assert cleaned.filter("bag_id = 0 and (x > 20 or y > 20)").count() == 0


def test_normals_of_a_plane(spark):
    rng = np.random.default_rng(4)
    xy = rng.uniform(0, 3, (300, 2))
    c = cloud(spark, np.column_stack([xy, 0.5 * xy[:, 0]]))
    n = pts.orient_up(outliers.estimate_normals(c, 1.0, 30, 0.3)).collect()
    want = np.array([-0.5, 0, 1]) / np.sqrt(1.25)
    assert max(abs(r.nx - want[0]) + abs(r.ny) + abs(r.nz - want[2]) for r in n) < 1e-6


def test_gray_rules(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5), (0.4, 0.5, 0.6), (0.9, 0.1, 0.1)], "r double, g double, b double")
    assert [r[0] for r in df.select(is_gray("r", "g", "b")).collect()] == [True, False, False]
    rows = [(0, 0, 0.0, 0.0, 0.0, 0.9, 0.1, 0.1), (0, 1, 0.04, 0.0, 0.0, 0.5, 0.5, 0.5), (0, 2, 0.06, 0.0, 0.0, 0.5, 0.5, 0.5)]
    c = spark.createDataFrame(rows, "bag_id long, point_idx long, x double, y double, z double, r double, g double, b double")
    assert sorted(r.point_idx for r in pts.drop_gray_near_color(c, 0.05).collect()) == [0, 2]


def test_ray_walk(spark):
    rays = spark.createDataFrame([(0, 1, 0.5, 0.5, 0.5, 3.5, 0.5, 0.5), (0, 2, 0.5, 0.5, 0.5, 9.5, 0.5, 0.5)],
                                 "bag_id long, ts_ns long, ox double, oy double, oz double, x double, y double, z double")
    rows = {(r.ts_ns, r.kx): r.hit for r in occupancy.scan_voxels(rays, 1.0, 5.0).collect()}
    assert rows == {(1, 0): 0, (1, 1): 0, (1, 2): 0, (1, 3): 1, (2, 0): 0, (2, 1): 0, (2, 2): 0, (2, 3): 0, (2, 4): 0}


def test_log_odds_buckets_do_not_matter(spark):
    rng = np.random.default_rng(6)
    obs = [(0, t, 0, 0, 0, int(rng.random() < 0.5)) for t in range(200)]
    df = spark.createDataFrame(obs, "bag_id long, ts_ns long, kx long, ky long, kz long, hit int")
    x = 0.0
    lo, hi = occupancy.log_odds(occupancy.P_MIN), occupancy.log_odds(occupancy.P_MAX)
    for o in obs:
        x = min(hi, max(lo, x + occupancy.log_odds(occupancy.P_HIT if o[5] else occupancy.P_MISS)))
    for bucket in (1, 7, 1000):
        assert occupancy.voxel_log_odds(df, bucket).first().log_odds == pytest.approx(x, abs=1e-9)


def test_small_clusters(spark):
    cells = [(0, x, 0, 0) for x in range(3)] + [(0, 10 + x, 10 + y, 0) for x in range(5) for y in range(5)] + [(0, 1, 20, 254)]
    grid = spark.createDataFrame(cells, "bag_id long, gx long, gy long, value int")
    ext = spark.createDataFrame([(0, 30, 30)], "bag_id long, x_size int, y_size int")
    got = {(r.gx, r.gy): r.value for r in occupancy.filter_small_clusters(grid, ext, 20, 0).collect()}
    assert got[0, 0] == 127 and got[12, 12] == 0 and got[1, 20] == 254


def test_components_long_chain(spark):
    n = 500
    ids = spark.range(n).selectExpr("0L as bag_id", "id")
    e = spark.range(n - 1).filter("id <> 250").selectExpr("0L as bag_id", "id as u", "id + 1 as v")
    both = e.unionByName(e.selectExpr("bag_id", "v as u", "u as v"))
    labels = {r.id: r.label for r in graph.components(ids, both).collect()}
    assert {labels[i] for i in range(251)} == {0} and {labels[i] for i in range(251, n)} == {251}


def test_majority_vote(spark):
    adj = spark.createDataFrame([(0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 5, 2), (0, 5, 3), (0, 5, 4), (0, 5, 6)], "bag_id long, u long, v long")
    labels = spark.createDataFrame([(0, 1, 9), (0, 2, 2), (0, 3, 2), (0, 4, 7), (0, 5, 9), (0, 6, 7)], "bag_id long, fid long, kf_idx int")
    got = {r.fid: r.kf_idx for r in graph.smooth_labels(labels, adj, 1).collect()}
    assert got[1] == 2 and got[5] == 9


def test_unit_cube_surface(spark):
    v, f = mesh.voxel_surface(spark.createDataFrame([(0, 0, 0, 0)], "bag_id long, vx long, vy long, vz long"), 1.0)
    assert v.count() == 8 and f.count() == 12 and mesh.face_adjacency(f).count() == 36
    g = mesh.face_geometry(v, f)
    assert g.agg(F.sum("area")).first()[0] == pytest.approx(6.0)
    outward = g.filter((F.col("x") - 0.5) * F.col("nx") + (F.col("y") - 0.5) * F.col("ny") + (F.col("z") - 0.5) * F.col("nz") > 0)
    assert outward.count() == 12
    assert {round(r.curvature, 6) for r in mesh.vertex_curvature(v, f, corrected=True).collect()} != {0.0}


def test_flat_heights_take_middle(spark):
    v = spark.createDataFrame([(0, 1, 0.0, 0.0, 2.0), (0, 2, 1.0, 0.0, 2.0)], "bag_id long, vid long, x double, y double, z double")
    assert {r.r for r in mesh.height_colors(v, "gray").collect()} == {0.5}


def test_shelf_pack(spark):
    c = spark.createDataFrame([(0, 1, 6, 5), (0, 2, 6, 4)], "bag_id long, chart long, w_int int, h_int int")
    got = {r.chart: (r.px, r.py) for r in views.shelf_pack(c, 10).collect()}
    assert got == {1: (0, 0), 2: (0, 5)}


def test_icp_recovers_a_shift():
    rng = np.random.default_rng(9)
    walls = np.concatenate([np.column_stack([rng.uniform(0, 2, 200), rng.uniform(0, 2, 200), np.zeros(200)]),
                            np.column_stack([rng.uniform(0, 2, 200), np.zeros(200), rng.uniform(0, 2, 200)]),
                            np.column_stack([np.zeros(200), rng.uniform(0, 2, 200), rng.uniform(0, 2, 200)])])
    shift = np.array([0.03, -0.02, 0.04])
    motion, fitness, rmse = registration.point_to_plane(walls - shift, walls, np.eye(4), 0.2, 0.4, 30, 50)
    assert np.allclose(motion[:3, 3], shift, atol=2e-3) and fitness > 0.95 and rmse < 0.05


def test_icp_partners_equal_brute_force_at_bounded_work():
    rng = np.random.default_rng(3)
    per_place = []
    for side in (6, 24):  # a lattice with many equal distances, sixteen times as large at the same density
        still = np.unique(rng.integers(0, (4 * side, 4 * side, 8), (40 * side * side, 3)), axis=0) * 0.25
        rng.shuffle(still)
        places = np.vstack([still[:300] + 0.125, [[-50.0, 3.0, 1.0], [np.nan, 0.0, 0.0], [1e30, 0.0, 0.0]]])
        cells = registration.CellIndex(still, 0.5)
        place, _point, _d2 = cells.around(places)
        per_place.append(len(place) / len(places))
        best, best_d2 = registration._nearest_in(cells, places)
        for i, at in enumerate(places):
            d2 = ((at - still) ** 2).sum(axis=1)
            if d2.min() <= 0.25:
                assert (best[i], best_d2[i]) == (d2.argmin(), d2.min())
            else:
                assert not best_d2[i] <= 0.25
        normals = registration.surface_directions(still, 0.5, 30)
        for i in range(0, len(still), 97):
            d2 = ((still - still[i]) ** 2).sum(axis=1)
            near = [k for k in np.argsort(d2, kind="stable")[:30] if d2[k] <= 0.25]
            want = np.linalg.eigh(np.cov(still[near].T, bias=True))[1][:, 0] if len(near) >= 3 else [0.0, 0.0, 1.0]
            assert np.allclose(normals[i], want)
    assert per_place[1] < 1.5 * per_place[0]



def test_rigid_transform_keeps_distances(spark):
    p = cloud(spark, [[0, 0, 0], [1, 2, 3]]).withColumn("ts_ns", F.lit(1).cast("long"))
    pose = spark.createDataFrame([(0, 1, 5.0, 6.0, 7.0, 0.1, 0.2, 0.3, 0.9)],
                                 "bag_id long, ts_ns long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    a, b = pts.transform_points(p, pose).orderBy("point_idx").collect()
    assert (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 == pytest.approx(14.0)
    assert (a.x, a.y, a.z) == (5.0, 6.0, 7.0)


def test_equal_rows_all_stay(spark):
    from waymark.operators import spacejoin

    rows = [("a", 0.0, 0.0, 0.0)] * 3 + [("a", 5.0, 0.0, 0.0)] * 2
    base = [("a", 0.1, 0.0, 0.0)] * 4 + [("a", 9.0, 9.0, 9.0)]
    q = spark.createDataFrame(rows, "bag_id string, x double, y double, z double")
    b = spark.createDataFrame(base, q.schema)
    got = sorted((r["x"], r["hits"]) for r in spacejoin.neighbours_within(q, b, 1.0).collect())
    assert got == [(0.0, 4)] * 3 + [(5.0, 0)] * 2
    assert spacejoin.radius_semi(q, b, 1.0).count() == 3
    assert spacejoin.radius_anti(q, b, 1.0).count() == 2


def test_tile_leaf_pairs_grow_with_the_points(spark):
    from pyspark.sql import functions as F

    from waymark.operators import spacejoin

    def tried(side):
        cells = spark.range(side**3).select(F.lit("a").alias("bag_id"), (F.col("id") % side).alias("ix"), (F.floor(F.col("id") / side) % side).alias("iy"),
                                            F.floor(F.col("id") / side**2).alias("iz"))
        box = {f"{p}{e}{a}": F.col(f"i{a}") + (0.1 if e == "lo" else 0.9) for p in "qb" for e in ("lo", "hi") for a in "xyz"}
        tiles = cells.select("bag_id", F.lit(0).alias("_m"), F.lit(1.0).alias("u"), *[c.alias(n) for n, c in box.items() if n[0] == "q"])
        leaves = cells.select("bag_id", F.lit(0).alias("leaf"), *[F.col(f"i{a}").alias(f"b{a}") for a in "xyz"], F.lit(1).alias("nb"),
                              *[c.alias(n) for n, c in box.items() if n[0] == "b"])
        top = side.bit_length()
        plan = spacejoin.tile_leaf_pairs(tiles, leaves, ("bag_id",), top, 1.0, [0, 0, 0])
        return plan.count() / side**3

    small, large = tried(8), tried(24)
    assert large <= 27 and large < 2 * small


def test_nearest_beyond_any_fixed_extent(spark):
    from waymark.operators import spacejoin

    rows = [("a", i, 5_000_000.0 + i, 500_000.0, 10.0) for i in range(50)]
    pts = spark.createDataFrame(rows, "bag_id string, point_idx long, x double, y double, z double")
    got = {r["point_idx"]: [n["id"] for n in r["neighbours"]] for r in spacejoin.nearest(pts, pts, 2, 1.0).collect()}
    assert got[0] == [0, 1] and got[49] == [49, 48] and len(got) == 50


def test_least_direction_against_numpy(spark):
    rng = np.random.default_rng(3)
    mats = [a @ a.T for a in rng.normal(size=(200, 3, 3))]
    mats += [np.diag(d) for d in ([1.0, 1, 0], [0, 1, 1], [2, 2, 2], [0, 0, 0], [3, 1, 2], [5, 0, 0], [0, 0, 5], [1e-9, 1, 1], [1e9, 2e9, 3e9])]
    turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
    mats += [turn @ np.diag(d) @ turn.T for d in ([4.0, 1, 1], [1, 1, 1], [2, 2, 1e-12], [1, 1 + 1e-3, 5])]
    rows = [(i, *(float(m[a, b]) for a, b in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)))) for i, m in enumerate(mats)]
    df = spark.createDataFrame(rows, "i int, xx double, xy double, xz double, yy double, yz double, zz double")
    for r in eigen.least_direction(df, ("xx", "xy", "xz", "yy", "yz", "zz")).collect():
        m, n = mats[r.i], np.array([r.nx, r.ny, r.nz])
        values, vectors = np.linalg.eigh(m)
        scale = max(abs(values).max(), 1e-300)
        assert abs(np.linalg.norm(n) - 1) < 1e-12
        assert np.linalg.norm(m @ n - values[0] * n) <= 1e-6 * scale, (r.i, n, values)
        if values[1] - values[0] > 1e-2 * scale:
            assert abs(abs(n @ vectors[:, 0]) - 1) < 1e-9
    flat = {r.i: r.nz for r in eigen.least_direction(df.filter("i >= 200"), ("xx", "xy", "xz", "yy", "yz", "zz")).collect()}
    assert flat[202] == 1 and flat[203] == 1 and flat[205] == 1 and flat[206] == 0  # equal spread: upright where that is possible


def plain_fill(known, x_size, y_size):
    out = {}
    for x in range(x_size):
        for y in range(y_size):
            _, gy, gx = min(((x - gx) ** 2 + (y - gy) ** 2, gy, gx) for gx, gy in known)
            out[x, y] = known[gx, gy]
    return out


@pytest.mark.parametrize("cells", [7, 60, 1 << 18])
def test_ground_gaps_take_the_nearest_cell(spark, cells):
    rng = np.random.default_rng(cells)
    rows, want = [], {}
    for bag, (x_size, y_size, n) in enumerate([(13, 9, 12), (1, 20, 4), (25, 1, 3), (17, 31, 5), (6, 6, 36), (30, 4, 3)]):
        known = {(int(x), int(y)): float(i) for i, (x, y) in enumerate(zip(rng.integers(0, x_size, 4 * n), rng.integers(0, y_size, 4 * n)))}
        known = dict(list(known.items())[:max(3, n)])
        rows += [(bag, x, y, z, x_size, y_size) for (x, y), z in known.items()]
        want |= {(bag, *k): z for k, z in plain_fill(known, x_size, y_size).items()}
    given = spark.createDataFrame(rows, "bag_id long, gx long, gy long, z double, x_size int, y_size int")
    ext = given.select("bag_id", "x_size", "y_size").distinct().unionByName(spark.createDataFrame([(90, 2, 3), (91, 1, 2)], "bag_id long, x_size int, y_size int"))
    known = given.select("bag_id", "gx", "gy", "z").unionByName(spark.createDataFrame([(90, 1, 1, 7.0)], "bag_id long, gx long, gy long, z double"))
    got = {(r.bag_id, r.gx, r.gy): r.z for r in occupancy.fill_ground(known, known.select("bag_id", (F.col("z") - 1).alias("z")), ext, cells).collect()}
    want |= {(90, x, y): 6.0 for x in range(2) for y in range(3)} | {(91, 0, y): 0.0 for y in range(2)}
    assert got == want


def test_far_vertices_are_those_beyond_the_limit_of_their_mesh(spark):
    rng = np.random.default_rng(11)
    pts_ = [(b, *map(float, p)) for b in (0, 1, 2, 3) for p in rng.uniform(-4, 4, (300, 3))]
    verts = [(b, i, *map(float, p)) for b in (0, 1, 2, 3, 4) for i, p in enumerate(rng.uniform(-9, 9, (200, 3)))]
    verts.append((3, 200, *[p[1:] for p in pts_ if p[0] == 3][0]))
    limit = {0: 0.7, 1: 3.0, 2: float("inf"), 3: 0.0, 4: float("inf")}
    v = cut(spark.createDataFrame(verts, "bag_id long, vid long, x double, y double, z double"))
    p = cut(spark.createDataFrame(pts_, "bag_id long, x double, y double, z double"))
    f = spark.createDataFrame([(0, 0, 0, 1, 2)], "bag_id long, fid long, v0 long, v1 long, v2 long")
    lim = cut(spark.createDataFrame(list(limit.items()), "bag_id long, limit double"))
    got = {(r.bag_id, r.vid) for r in mesh.trim_far_vertices(v, f, p, lim)[0].collect()}
    cloud = {b: np.array([q[1:] for q in pts_ if q[0] == b]).reshape(-1, 3) for b in limit}
    want = {(b, i) for b, i, *at in verts if len(cloud[b]) and np.sqrt(((cloud[b] - at) ** 2).sum(1)).min() <= limit[b]}
    assert got == want and 0 < len([k for k in got if k[0] == 0]) < 200


def test_a_surface_keeps_no_copy_of_its_cloud(spark):
    import glob

    import pyarrow.parquet as pq

    rng = np.random.default_rng(3)
    rows = [(0, i, *map(float, p)) for i, p in enumerate(rng.uniform(0, 6, (20_000, 3)))]
    cloud = cut(spark.createDataFrame(rows, "bag_id long, point_idx long, x double, y double, z double"))
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/table-*"))
    v, f = jobs.surface_mesh(cloud, 2.0, jobs.SurfaceConfig(smooth_iterations=1))
    assert f.count() > 0
    made = set(glob.glob(f"{folder}/table-*")) - before
    assert max(sum(pq.read_metadata(x).num_rows for x in glob.glob(f"{t}/*.parquet")) for t in made) < 5_000


def test_map_metadata_needs_no_normals(spark, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(outliers, "estimate_normals", None)
    rows = entry.queries()["map_metadata"](spark, entry.SMOKE_DIR).collect()
    assert {r.bag_id for r in rows} == {0, 1, 2, 3}


def test_scans_before_the_first_calibration_are_coloured(spark):
    """The log's first calibration holds for them too."""
    points = cut(cloud(spark, [[2, 0, 0], [2, 0.5, 0.5]]).withColumn("ts_ns", F.lit(95)))
    odom = spark.createDataFrame([(0, t, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for t in (90, 95, 100, 105)],
                                 "bag_id long, ts_ns long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    images = spark.createDataFrame([(0, 100, 8, 8, "mono8", bytearray([200] * 64))],
                                   "bag_id long, ts_ns long, height int, width int, encoding string, data binary")
    info = spark.createDataFrame([(0, 100, [4.0, 0.0, 3.5, 0.0, 4.0, 3.5, 0.0, 0.0, 1.0], 8, 8)],
                                 "bag_id long, ts_ns long, k array<double>, width int, height int")
    cfg = jobs.CloudConfig(voxel=0.1, min_frame_points=1, clean=False, max_latency_ns=100)
    got = jobs.coloured_cloud(points, odom, images, info, cfg, jobs.ColourConfig(max_dt_ns=10)).collect()
    assert [round(row.g, 6) for row in got] == [round(200 / 255, 6)] * 2


def test_block_search_tries_few_of_the_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.uniform(0, 30, (3000, 3))
    points[1000:1200] = np.round(points[1000:1200])
    points[1500:1600] = points[1000:1100]
    tried, plain = [0], spacejoin._squares

    def counted(a, b):
        tried[0] += len(a) * len(b)
        return plain(a, b)

    monkeypatch.setattr(spacejoin, "_squares", counted)
    table = {"bag_id": np.zeros(3000, int), **{a: points[:, i].copy() for i, a in enumerate("xyz")}}
    ids = np.arange(3000)
    found = spacejoin._block_search(["bag_id"], 20, None)(pa.table({**table, "_qid": ids}), pa.table({**table, "_bid": ids}))
    d2 = plain(points, points)
    for i, near in enumerate(found["nb"].to_pylist()):
        assert [n["id"] for n in near] == np.lexsort((ids, d2[i]))[:20].tolist()
    assert tried[0] < d2.size / 4


def test_colours_need_no_second_pass_over_points_without_pixel(spark):
    from waymark.operators import colour
    images = spark.createDataFrame([(0, 7, 2, 2, "mono8", bytearray([0, 51, 102, 255]))],
                                   "bag_id long, ts_ns long, height int, width int, encoding string, data binary")
    rows = [(0, 1, 7, 1, 0), (0, 2, 7, None, None), (0, 3, None, None, None), (0, 4, 7, 0, 1), (0, 5, 8, 0, 1)]
    out = colour.sample_images(spark.createDataFrame(rows, "bag_id long, point_idx long, image_ts_ns long, u int, v int"), images)
    assert {r.point_idx: r.g for r in out.collect()} == {1: 0.2, 2: 0.5, 3: 0.5, 4: 0.4, 5: 0.5}
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
