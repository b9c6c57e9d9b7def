"""Triangle meshes as vertex and face tables, keyed by log (bag_id).

vertices(bag_id, vid, x, y, z, ...), faces(bag_id, fid, v0, v1, v2). Vertex ids need not be dense.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions import rotation as rot
from waymark.functions.color import colormap
from waymark.functions.grid import cell
from waymark.operators.odometry import exact_percentile
from waymark.operators.spacejoin import nearest
from waymark.session import cut

# Outward sides of a unit cube as (step to the neighbour, four corners counter-clockwise).
CUBE_SIDES = (
    ((1, 0, 0), ((1, 0, 0), (1, 1, 0), (1, 1, 1), (1, 0, 1))),
    ((-1, 0, 0), ((0, 0, 0), (0, 0, 1), (0, 1, 1), (0, 1, 0))),
    ((0, 1, 0), ((0, 1, 0), (0, 1, 1), (1, 1, 1), (1, 1, 0))),
    ((0, -1, 0), ((0, 0, 0), (1, 0, 0), (1, 0, 1), (0, 0, 1))),
    ((0, 0, 1), ((0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 1, 1))),
    ((0, 0, -1), ((0, 0, 0), (0, 1, 0), (1, 1, 0), (1, 0, 0))),
)
HALF, STRIDE = 1 << 18, 1 << 19  # 19 bits an axis


def pack3(x, y, z) -> Column:
    """Corner id; a corner beyond 19 bits an axis is an error, never another corner's id."""
    held = x.between(-HALF, HALF - 1) & y.between(-HALF, HALF - 1) & z.between(-HALF, HALF - 1)
    return F.when(~held, F.raise_error(F.lit("corner beyond 19 bits an axis: subtract the log's smallest voxel first")).cast("long")).otherwise(((x + HALF) * (STRIDE * STRIDE) + (y + HALF) * STRIDE + (z + HALF)).cast("long"))


def voxel_surface(voxels: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Sides between occupied (vx, vy, vz) and empty voxels, two triangles each, outward oriented."""
    v = voxels.select("bag_id", "vx", "vy", "vz")
    sides = F.array(*[
        F.struct(F.lit(i).alias("side"), *[F.lit(s).alias(f"s{a}") for s, a in zip(step, "xyz")],
                 *[F.lit(c).alias(f"c{k}{a}") for k, corner in enumerate(corners) for c, a in zip(corner, "xyz")])
        for i, (step, corners) in enumerate(CUBE_SIDES)])
    around = v.withColumn("_s", F.explode(sides)).select(
        "bag_id", "vx", "vy", "vz", "_s", *[(F.col(f"v{a}") + F.col(f"_s.s{a}")).alias(f"n{a}") for a in "xyz"])
    full = v.select(F.col("bag_id").alias("bag_id"), *[F.col(f"v{a}").alias(f"n{a}") for a in "xyz"])
    open_ = around.join(full, ["bag_id", "nx", "ny", "nz"], "left_anti")
    corner = [[F.col(f"v{a}") + F.col(f"_s.c{k}{a}") for a in "xyz"] for k in range(4)]
    ids = [pack3(*c) for c in corner]
    fid = pack3(F.col("vx"), F.col("vy"), F.col("vz")) * 12 + F.col("_s.side") * 2
    quads = open_.select("bag_id", fid.alias("fid"), *[i.alias(f"q{k}") for k, i in enumerate(ids)])
    two = F.array(F.struct(F.lit(0).alias("t"), F.col("q0").alias("v0"), F.col("q1").alias("v1"), F.col("q2").alias("v2")),
                  F.struct(F.lit(1).alias("t"), F.col("q0").alias("v0"), F.col("q2").alias("v1"), F.col("q3").alias("v2")))
    faces = quads.withColumn("_t", F.explode(two)).select("bag_id", (F.col("fid") + F.col("_t.t")).alias("fid"),
                                                          "_t.v0", "_t.v1", "_t.v2")
    return vertices_of(faces, size), faces


def vertices_of(faces: DataFrame, size: float) -> DataFrame:
    """Corner coordinates from packed corner ids."""
    ids = faces.select("bag_id", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    return ids.select(
        "bag_id", "vid", ((F.expr(f"vid div {STRIDE * STRIDE}L") - HALF) * size).alias("x"),
        ((F.expr(f"(vid div {STRIDE}L) % {STRIDE}L") - HALF) * size).alias("y"), ((F.expr(f"vid % {STRIDE}L") - HALF) * size).alias("z"))


def corners(faces: DataFrame) -> DataFrame:
    return faces.select("bag_id", "fid", F.posexplode(F.array("v0", "v1", "v2")).alias("corner", "vid"))


def face_vertices(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces with the coordinates of their corners (x0 .. z2): one join and one aggregation."""
    joined = corners(faces).join(vertices.select("bag_id", "vid", "x", "y", "z"), ["bag_id", "vid"])
    at = lambda c, k: F.max(F.when(F.col("corner") == k, F.col(c)))
    return joined.groupBy("bag_id", "fid").agg(*[at("vid", k).alias(f"v{k}") for k in range(3)],
                                               *[at(a, k).alias(f"{a}{k}") for k in range(3) for a in "xyz"])


def face_geometry(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Centre (x, y, z), unit normal (zero if degenerate) and area per face."""
    g = face_vertices(vertices, faces)
    e1 = [F.col(f"{a}1") - F.col(f"{a}0") for a in "xyz"]
    e2 = [F.col(f"{a}2") - F.col(f"{a}0") for a in "xyz"]
    g = g.withColumns({f"_c{a}": c for a, c in zip("xyz", rot.cross3(e1, e2))}).withColumn("_l", rot.norm3("_cx", "_cy", "_cz"))
    unit = {f"n{a}": F.when(F.col("_l") > 1e-12, F.col(f"_c{a}") / F.col("_l")).otherwise(0.0).alias(f"n{a}") for a in "xyz"}
    centre = [((F.col(f"{a}0") + F.col(f"{a}1") + F.col(f"{a}2")) / 3.0).alias(a) for a in "xyz"]
    return g.select("bag_id", "fid", "v0", "v1", "v2", *centre, *unit.values(), (F.col("_l") / 2.0).alias("area"))


def face_edges(faces: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")) for a, b in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))])
    return faces.select("bag_id", "fid", F.explode(pairs).alias("e")).select("bag_id", "fid", "e.a", "e.b")


def face_adjacency(faces: DataFrame) -> DataFrame:
    """Pairs (u, v) of faces sharing an edge, in both directions; edges of more than two faces join none.

    The face ids of an edge are reduced to count, minimum and maximum, so no edge lists its pairs.
    """
    shared = face_edges(faces).groupBy("bag_id", "a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("fid").alias("f"), F.max("fid").alias("g")).filter((F.col("n") == 2) & (F.col("f") < F.col("g")))
    both = F.array(F.struct(F.col("f").alias("u"), F.col("g").alias("v")), F.struct(F.col("g").alias("u"), F.col("f").alias("v")))
    return shared.select("bag_id", F.explode(both).alias("p")).select("bag_id", "p.u", "p.v").distinct()


def vertex_curvature(vertices: DataFrame, faces: DataFrame, corrected: bool = False) -> DataFrame:
    """Spread of incident face normals per vertex.

    The literal form divides the length of the mean normal once more by the number of faces; a vertex of
    one face scores 1, one without valid faces 0. `corrected` gives 1 − |mean normal|.
    """
    g = face_geometry(vertices, faces).filter((F.col("nx") != 0) | (F.col("ny") != 0) | (F.col("nz") != 0))
    inc = g.select("bag_id", F.explode(F.array("v0", "v1", "v2")).alias("vid"), "nx", "ny", "nz")
    mean = inc.groupBy("bag_id", "vid").agg(F.count(F.lit(1)).alias("_n"), *[F.avg(f"n{a}").alias(f"m{a}") for a in "xyz"])
    length = rot.norm3("mx", "my", "mz")
    value = 1.0 - length if corrected else F.when(F.col("_n") > 1, 1.0 - length / F.col("_n")).otherwise(1.0)
    scored = mean.select("bag_id", "vid", value.alias("_v"))
    return vertices.select("bag_id", "vid").join(scored, ["bag_id", "vid"], "left").select(
        "bag_id", "vid", F.coalesce("_v", F.lit(0.0)).alias("curvature"))


def protect_faces(faces: DataFrame, curvature: DataFrame, percentile: float, rings: int = 1) -> DataFrame:
    """Ids (bag_id, fid) of faces with a vertex at or above the curvature percentile, grown by vertex rings."""
    limit = exact_percentile(curvature, "curvature", percentile / 100.0, ["bag_id"], "limit")
    sharp = curvature.join(limit, "bag_id").filter(F.col("curvature") >= F.col("limit")).select("bag_id", "vid")
    c = corners(faces)
    marked = c.join(sharp, ["bag_id", "vid"], "left_semi").select("bag_id", "fid").distinct()
    return dilate_faces(faces, marked, rings)


def dilate_faces(faces: DataFrame, marked: DataFrame, rings: int) -> DataFrame:
    c = corners(faces)
    for _ in range(rings):
        touched = c.join(marked, ["bag_id", "fid"], "left_semi").select("bag_id", "vid").distinct()
        marked = cut(c.join(touched, ["bag_id", "vid"], "left_semi").select("bag_id", "fid").distinct())
    return marked


def submesh(vertices: DataFrame, faces: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen faces and the vertices they use; ids stay as they are."""
    kept = faces.join(chosen, ["bag_id", "fid"], "left_semi")
    return referenced(vertices, kept), kept


def referenced(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    used = faces.select("bag_id", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    return vertices.join(used, ["bag_id", "vid"], "left_semi")


def dense_index(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Renumber vertices 0..n-1 per mesh in id order: ranks within id slots, whose number grows with the mesh, plus the sizes of
    earlier slots."""
    span = vertices.groupBy("bag_id").agg(F.count(F.lit(1)).alias("_n"), F.min("vid").alias("_lo"), F.max("vid").alias("_hi"))
    share = (F.col("vid") - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo") + 1)
    slotted = vertices.join(span, "bag_id").withColumn("_slot", F.floor(share * F.ceil(F.col("_n") / 2048)).cast("long")).drop("_n", "_lo", "_hi")
    sizes = slotted.groupBy("bag_id", "_slot").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("bag_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bag_id", "_slot", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inner = F.row_number().over(Window.partitionBy("bag_id", "_slot").orderBy("vid"))
    numbered = slotted.withColumn("_r", inner).join(sizes, ["bag_id", "_slot"]).withColumn("new", F.col("_o") + F.col("_r") - 1)
    moved = _remap(faces, numbered.select("bag_id", F.col("vid").alias("old"), "new"))
    rest = [c for c in vertices.columns if c not in ("bag_id", "vid")]
    return numbered.select("bag_id", F.col("new").alias("vid"), *rest), moved


def _remap(faces: DataFrame, mapping: DataFrame) -> DataFrame:
    c = corners(faces).join(mapping.select("bag_id", F.col("old").alias("vid"), "new"), ["bag_id", "vid"])
    at = lambda k: F.max(F.when(F.col("corner") == k, F.col("new"))).alias(f"v{k}")
    return c.groupBy("bag_id", "fid").agg(at(0), at(1), at(2))


def clean_mesh(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge equal positions, drop repeated, degenerate and surplus faces of an edge, drop unused vertices.

    Of an edge with more than two faces the two largest (then lowest ids) stay.
    """
    home = vertices.groupBy("bag_id", "x", "y", "z").agg(F.min("vid").alias("new"))
    mapping = vertices.join(home, ["bag_id", "x", "y", "z"]).select("bag_id", F.col("vid").alias("old"), "new")
    f = _remap(faces, mapping).filter("v0 <> v1 and v1 <> v2 and v2 <> v0")
    f = f.withColumn("_k", F.array_sort(F.array("v0", "v1", "v2"))).groupBy("bag_id", "_k").agg(
        F.min(F.struct("fid", "v0", "v1", "v2")).alias("m")).select("bag_id", "m.*")
    f = cut(f)
    v = vertices.join(mapping.select("bag_id", F.col("new").alias("vid")).distinct(), ["bag_id", "vid"], "left_semi")
    areas = face_geometry(v, f).select("bag_id", "fid", "area")
    rank = F.row_number().over(Window.partitionBy("bag_id", "a", "b").orderBy(F.desc("area"), "fid"))
    kept = face_edges(f).join(areas, ["bag_id", "fid"]).withColumn("_r", rank).filter("_r <= 2")
    whole = kept.groupBy("bag_id", "fid").agg(F.count(F.lit(1)).alias("_n")).filter("_n = 3").select("bag_id", "fid")
    f = f.join(whole, ["bag_id", "fid"], "left_semi")
    return referenced(v, f), f


def vertex_edges(faces: DataFrame) -> DataFrame:
    e = face_edges(faces).select("bag_id", "a", "b").distinct()
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return e.select("bag_id", F.explode(both).alias("p")).select("bag_id", "p.u", "p.v")


# Fixed value: the shrinking step of the two-step smoother.
TAUBIN_MU = -0.53


def smooth_mesh(vertices: DataFrame, faces: DataFrame, method: str = "taubin", iterations: int = 5,
                factor: float = 0.5) -> DataFrame:
    """Move vertices towards the inverse-distance weighted mean of their neighbours.

    `laplacian` repeats one step; `taubin` follows each with a step of TAUBIN_MU, which keeps the volume.
    """
    edges = cut(vertex_edges(faces))
    v = vertices.select("bag_id", "vid", "x", "y", "z")
    steps = (factor, TAUBIN_MU) if method == "taubin" else (factor,)
    for _ in range(iterations):
        for f in steps:
            here = v.select("bag_id", F.col("vid").alias("u"), *[F.col(a).alias(f"u{a}") for a in "xyz"])
            there = v.select("bag_id", F.col("vid").alias("v"), *[F.col(a).alias(f"w{a}") for a in "xyz"])
            met = edges.join(here, ["bag_id", "u"]).join(there, ["bag_id", "v"])
            w = 1.0 / (rot.distance3([f"u{a}" for a in "xyz"], [f"w{a}" for a in "xyz"]) + 1e-12)
            mean = met.withColumn("_w", w).groupBy("bag_id", F.col("u").alias("vid")).agg(
                *[(F.sum(F.col(f"w{a}") * F.col("_w")) / F.sum("_w")).alias(f"m{a}") for a in "xyz"])
            v = v.join(mean, ["bag_id", "vid"], "left").select(
                "bag_id", "vid", *[(F.col(a) + f * (F.coalesce(f"m{a}", a) - F.col(a))).alias(a) for a in "xyz"])
        v = cut(v)
    return v


#: Sizes between one doubling and the next that are tried once a target is bracketed.
FINE_STEPS = 8


def decimate_target(faces: DataFrame, target: float) -> DataFrame:
    """Face count wanted per mesh: a fraction up to one, else an absolute number; at least four for a fraction."""
    n = faces.groupBy("bag_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.greatest(F.lit(4), F.floor(F.col("n") * float(target))) if target <= 1.0 else F.lit(int(target))
    return n.select("bag_id", "n", wanted.cast("long").alias("target"))


def simplify_mesh(vertices: DataFrame, faces: DataFrame, target: float, cell_size: float, percentile: float = 80.0,
                  rings: int = 1) -> tuple[DataFrame, DataFrame]:
    """Merge vertices of flat regions by growing cells until the face target is met.

    Faces at sharp vertices (with rings around) are protected and keep all their vertices. From `cell_size` on, cells double or halve for
    each mesh until one size misses the target and the next meets it; of the sizes between, the smallest that meets it is taken. Meshes within the target,
    or with protected faces at or above it, stay as they are; `simplify_report` names those whose target is not met.
    """
    faces, vertices = cut(faces), cut(vertices)
    want = decimate_target(faces, target)
    guard = cut(protect_faces(faces, vertex_curvature(vertices, faces), percentile, rings))
    guarded = guard.groupBy("bag_id").agg(F.count(F.lit(1)).alias("p"))
    plan = want.join(guarded, "bag_id", "left").withColumn("p", F.coalesce("p", F.lit(0)))
    plan = plan.withColumn("_skip", (F.col("n") <= F.greatest(F.lit(4), F.col("target"))) | (F.col("p") >= F.col("target")) | (
        F.col("n") - F.col("p") < 4))
    plan = cut(plan.withColumn("low", F.greatest(F.lit(4), F.least(F.col("n") - F.col("p"), F.col("target") - F.col("p")))))
    fixed = corners(faces).join(guard, ["bag_id", "fid"], "left_semi").select("bag_id", "vid").distinct()
    loose = vertices.join(plan.filter("not _skip").select("bag_id"), "bag_id", "left_semi").join(fixed, ["bag_id", "vid"], "left_anti")
    loose = cut(loose)
    low_faces = cut(faces.join(guard, ["bag_id", "fid"], "left_anti").join(plan.filter("not _skip").select("bag_id"), "bag_id", "left_semi"))

    def clustered(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Merged vertices and remaining faces for every (bag_id, step); the cell side doubles from step to step."""
        side = F.pow(F.lit(2.0), F.col("step")) * cell_size
        keyed = loose.join(steps, "bag_id").withColumns({f"c{a}": F.floor(F.col(a) / side) for a in "xyz"})
        group = ["bag_id", "step", "cx", "cy", "cz"]
        centre = keyed.groupBy(*group).agg(F.min("vid").alias("new"), *[F.avg(a).alias(f"a{a}") for a in "xyz"])
        merged = cut(keyed.join(centre, group).select("bag_id", "step", F.col("vid").alias("old"), "new", "ax", "ay", "az"))
        mapped = corners(low_faces).join(steps, "bag_id").join(
            merged.select("bag_id", "step", F.col("old").alias("vid"), "new"), ["bag_id", "step", "vid"], "left").withColumn("vid", F.coalesce("new", "vid"))
        at = lambda k: F.max(F.when(F.col("corner") == k, F.col("vid"))).alias(f"v{k}")
        tri = mapped.groupBy("bag_id", "step", "fid").agg(at(0), at(1), at(2)).filter("v0 <> v1 and v1 <> v2 and v2 <> v0")
        tri = tri.withColumn("_k", F.array_sort(F.array("v0", "v1", "v2"))).groupBy("bag_id", "step", "_k").agg(
            F.min(F.struct("fid", "v0", "v1", "v2")).alias("m")).select("bag_id", "step", "m.*")
        return merged, cut(tri)

    def judged(steps: DataFrame, tri: DataFrame) -> DataFrame:
        """(bag_id, step, ok, still): whether the target is met, and whether another step in that direction changes nothing."""
        counts = tri.groupBy("bag_id", "step").agg(F.count(F.lit(1)).alias("_n"))
        n = F.coalesce("_n", F.lit(0))
        return steps.join(counts, ["bag_id", "step"], "left").join(plan.select("bag_id", "low", (F.col("n") - F.col("p")).alias("free")), "bag_id").select(
            "bag_id", "step", (n <= F.col("low")).alias("ok"), ((n == 0) | (n == F.col("free"))).alias("still"))

    bags = plan.filter("not _skip").select("bag_id")
    known, open_bags = None, bags.withColumns({"_from": F.lit(0), "_to": F.lit(3)})
    while True:
        steps = cut(open_bags.select("bag_id", F.explode(F.transform(F.sequence("_from", "_to"), lambda i: i.cast("double"))).alias("step")))
        got = judged(steps, clustered(steps)[1])
        known = cut(got if known is None else known.unionByName(got))
        ends = known.groupBy("bag_id").agg(F.min("step").alias("first"), F.max("step").alias("last"), F.min_by("ok", "step").alias("first_ok"),
                                           F.min_by("still", "step").alias("first_still"), F.bool_or("ok").alias("any_ok"), F.max_by("still", "step").alias("last_still"))
        finer = F.col("first_ok") & ~F.col("first_still")
        coarser = ~F.col("any_ok") & ~F.col("last_still")
        open_bags = cut(ends.filter(finer | coarser).select(
            "bag_id", F.when(finer, F.col("first") - 4).otherwise(F.col("last") + 1).cast("int").alias("_from"),
            F.when(finer, F.col("first") - 1).otherwise(F.col("last") + 4).cast("int").alias("_to")))
        if open_bags.isEmpty():
            break
    met = known.groupBy("bag_id").agg(F.min(F.when(F.col("ok"), F.col("step"))).alias("met"), F.max("step").alias("last"))
    between = met.withColumn("step", F.explode(F.when(F.col("met").isNull(), F.array("last")).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(FINE_STEPS - 1)), lambda i: F.col("met") - i / float(FINE_STEPS))))).select("bag_id", "step")
    between = cut(between)
    merged, tri = clustered(between)
    choice = cut(judged(between, tri).groupBy("bag_id").agg(F.coalesce(F.min(F.when(F.col("ok"), F.col("step"))), F.max("step")).alias("step")))
    new_faces = tri.join(choice, ["bag_id", "step"]).drop("step")
    kept_faces = faces.join(plan.filter("_skip").select("bag_id"), "bag_id", "left_semi").unionByName(
        faces.join(plan.filter("not _skip").select("bag_id"), "bag_id", "left_semi").join(guard, ["bag_id", "fid"], "left_semi"))
    out_faces = cut(new_faces.unionByName(kept_faces))
    centres = merged.join(choice, ["bag_id", "step"]).filter("old = new").select(
        "bag_id", F.col("new").alias("vid"), *[F.col(f"a{a}").alias(f"_{a}") for a in "xyz"])
    placed = vertices.join(centres, ["bag_id", "vid"], "left").select(
        "bag_id", "vid", *[F.coalesce(f"_{a}", a).alias(a) for a in "xyz"])
    return referenced(placed, out_faces), out_faces


def simplify_report(faces: DataFrame, simplified: DataFrame, target: float) -> DataFrame:
    """(bag_id, n, target, left, met) of every mesh: faces before, wanted and after simplifying."""
    left = simplified.groupBy("bag_id").agg(F.count(F.lit(1)).alias("left"))
    want = decimate_target(faces, target).join(left, "bag_id", "left").withColumn("left", F.coalesce("left", F.lit(0)))
    return want.withColumn("met", F.col("left") <= F.greatest(F.lit(4), F.col("target")))


def trim_low_support(vertices: DataFrame, faces: DataFrame, percentile: float, support: str = "support") -> tuple[DataFrame, DataFrame]:
    """Drop vertices whose support lies under the percentile of their mesh, with their faces."""
    limit = exact_percentile(vertices, support, percentile / 100.0, ["bag_id"], "limit")
    kept = vertices.join(limit.select("bag_id", "limit"), "bag_id").filter(F.col(support) >= F.col("limit")).drop("limit")
    return _drop_faces(kept, faces)


def trim_far_vertices(vertices: DataFrame, faces: DataFrame, points: DataFrame, limits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop vertices farther than their mesh's `limit` (bag_id, limit) from every point, with their faces.

    Points become tight boxes of cells a quarter of the limit wide, combined before the shuffle. A vertex stays if a box around it lies
    within the limit whole; only cells that straddle the limit of a vertex still open give their points. `points` is read twice.
    """
    finite = limits.filter((F.col("limit") >= 0) & (F.col("limit") < float("inf")))
    side = F.greatest(F.col("limit") / 4.0, F.lit(1e-6))
    keys = ["_cx", "_cy", "_cz"]
    celled = points.select("bag_id", "x", "y", "z").join(finite, "bag_id").withColumns({k: cell(a, side) for k, a in zip(keys, "xyz")})
    boxes = cut(celled.groupBy("bag_id", *keys).agg(
        *[F.min(a).alias(f"blo{a}") for a in "xyz"], *[F.max(a).alias(f"bhi{a}") for a in "xyz"]))

    def met(some: DataFrame, reach: int) -> DataFrame:
        """Vertices with the boxes up to `reach` cells away: squared distances to their nearest and farthest corners."""
        out = some
        for k, a in zip(keys, "xyz"):
            out = out.withColumn("_o", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn(k, cell(a, side) + F.col("_o")).drop("_o")
        near, far = F.lit(0.0), F.lit(0.0)
        for a in "xyz":
            under, over = F.col(f"blo{a}") - F.col(a), F.col(a) - F.col(f"bhi{a}")
            gap, span = F.greatest(F.lit(0.0), under, over), F.greatest(F.abs(under), F.abs(over))
            near, far = near + gap * gap, far + span * span
        return out.join(boxes, ["bag_id", *keys]).select(*some.columns, *keys, near.alias("_near"), far.alias("_far"))

    limit = F.col("limit")
    spots = vertices.select("bag_id", "vid", "x", "y", "z").join(finite, "bag_id")
    kept = cut(met(spots, 1).filter(F.sqrt("_far") <= limit).select("bag_id", "vid").distinct())
    pairs = cut(met(spots.join(kept, ["bag_id", "vid"], "left_anti"), 5).filter(F.sqrt("_near") <= limit))
    sure = pairs.filter(F.sqrt("_far") <= limit).select("bag_id", "vid").distinct()
    straddling = pairs.join(sure, ["bag_id", "vid"], "left_anti").select(
        "bag_id", "vid", *keys, *[F.col(a).alias(f"_v{a}") for a in "xyz"])
    inside = celled.join(straddling.select("bag_id", *keys).distinct(), ["bag_id", *keys], "left_semi")
    close = straddling.join(inside, ["bag_id", *keys]).filter(rot.distance3(["_vx", "_vy", "_vz"], ["x", "y", "z"]) <= limit)
    # without a limit a log's points keep all of its vertices
    free = limits.filter(limit == float("inf")).join(points.select("bag_id"), "bag_id", "left_semi")
    spared = vertices.join(free, "bag_id", "left_semi").select("bag_id", "vid")
    stay = cut(reduce(DataFrame.unionByName, [kept, sure, close.select("bag_id", "vid").distinct(), spared]))
    return _drop_faces(vertices.join(stay, ["bag_id", "vid"], "left_semi"), faces)


def trim_limits(spacing: DataFrame, multiplier: float, cap: float | None = None) -> DataFrame:
    """Smaller of multiplier·spacing and the cap; infinite where neither applies."""
    adaptive = F.when((F.col("spacing") > 0) & F.lit(multiplier > 0), F.col("spacing") * multiplier).otherwise(float("inf"))
    return spacing.select("bag_id", F.least(adaptive, F.lit(float(cap) if cap and cap > 0 else float("inf"))).alias("limit"))


def _drop_faces(kept: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    full = corners(faces).join(kept.select("bag_id", "vid"), ["bag_id", "vid"], "left_semi").groupBy("bag_id", "fid").agg(
        F.count(F.lit(1)).alias("_n")).filter("_n = 3").select("bag_id", "fid")
    return kept, faces.join(full, ["bag_id", "fid"], "left_semi")


def center_mesh(vertices: DataFrame) -> DataFrame:
    """Centroid to x = y = 0, lowest point to z = 0, per mesh."""
    c = vertices.groupBy("bag_id").agg(F.avg("x").alias("_x"), F.avg("y").alias("_y"), F.min("z").alias("_z"))
    moved = {a: (F.col(a) - F.col(f"_{a}")).alias(a) for a in "xyz"}
    return vertices.join(c, "bag_id").select(*[moved.get(n, F.col(n)) for n in vertices.columns])


def height_colors(vertices: DataFrame, name: str = "jet") -> DataFrame:
    """Colours (r, g, b) from the height within each mesh; a flat mesh takes the middle of the map."""
    box = vertices.groupBy("bag_id").agg(F.min("z").alias("_lo"), F.max("z").alias("_hi"))
    joined = vertices.join(box, "bag_id")
    span = F.col("_hi") - F.col("_lo")
    joined = joined.withColumn("_t", F.when(span <= 1e-12, 0.5).otherwise((F.col("z") - F.col("_lo")) / span))
    return joined.withColumns(dict(zip("rgb", colormap(F.col("_t"), name)))).drop("_lo", "_hi", "_t")


def transfer_colors(vertices: DataFrame, points: DataFrame, spacing: float) -> DataFrame:
    """Colour of the nearest coloured point per vertex."""
    near = nearest(vertices.withColumn("point_idx", F.col("vid")), points, 1, spacing)
    near = near.withColumn("_id", F.get("neighbours", F.lit(0))["id"]).select(*vertices.columns, "_id")
    return near.join(points.select("bag_id", F.col("point_idx").cast("long").alias("_id"), "r", "g", "b"), ["bag_id", "_id"]).drop("_id")


def stl_facets(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """One seven-line text facet per face."""
    g = face_vertices(vertices, faces).join(face_geometry(vertices, faces).select("bag_id", "fid", "nx", "ny", "nz"), ["bag_id", "fid"])
    fmt = "facet normal %.6f %.6f %.6f\nouter loop\n" + "vertex %.6f %.6f %.6f\n" * 3 + "endloop\nendfacet"
    args = ["nx", "ny", "nz"] + [f"{a}{k}" for k in range(3) for a in "xyz"]
    return g.select("bag_id", "fid", F.format_string(fmt, *args).alias("facet"))


def write_stl(vertices: DataFrame, faces: DataFrame, path: str) -> None:
    stl_facets(vertices, faces).select("bag_id", "facet").write.partitionBy("bag_id").mode("overwrite").text(path)


def write_mesh(vertices: DataFrame, faces: DataFrame, path: str) -> None:
    vertices.write.partitionBy("bag_id").mode("overwrite").parquet(f"{path}/vertices")
    faces.write.partitionBy("bag_id").mode("overwrite").parquet(f"{path}/faces")
