"""Faces and cameras: visibility, best views, texture charts and atlas texels."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import camera, rotation as rot
from waymark.functions.grid import cell
from waymark.operators import graph
from waymark.operators.fold import ordered_fold
from waymark.operators.mesh import corners
from waymark.operators.odometry import exact_percentile
from waymark.operators.timejoin import within_time
from waymark.session import cut

CAM = ("cam_x", "cam_y", "cam_z")


def camera_table(keyframes: DataFrame) -> DataFrame:
    """Keyframes with camera position and rotation matrix columns."""
    m = rot.quat_to_matrix()
    keep = [c for c in keyframes.columns if c not in (*rot.POSITION, *rot.QUAT)]
    return keyframes.select(*keep, *[F.col(p).alias(c) for p, c in zip(rot.POSITION, CAM)], *[c.alias(n) for n, c in m.items()])


def face_view_pairs(faces: DataFrame, cameras: DataFrame, reach: float) -> DataFrame:
    """Faces (centre x, y, z) with the cameras at most `reach` away, by cells of that size.

    Cameras, the smaller side, are listed in their cell and its neighbours; faces keep one row.
    """
    names = ("_gx", "_gy", "_gz")
    f = faces.withColumns({n: cell(a, reach) for n, a in zip(names, "xyz")})
    c = cameras.withColumns({n: cell(a, reach) for n, a in zip(names, CAM)})
    for n in names:
        c = c.withColumn(n, F.explode(F.sequence(F.col(n) - 1, F.col(n) + 1)))
    pairs = f.join(c, ["bag_id", *names]).drop(*names)
    return pairs.filter(rot.distance3(("x", "y", "z"), CAM) <= reach)


def view_geometry(pairs: DataFrame, k: dict) -> DataFrame:
    """Adds depth, distance, pixel (u, v) and alignment of the face normal with the view direction."""
    optical = camera.world_to_optical(list(rot.MATRIX), CAM, ("x", "y", "z"))
    normal = camera.direction_to_optical(list(rot.MATRIX), ("nx", "ny", "nz"))
    p = pairs.withColumns({f"_o{a}": o for a, o in zip("xyz", optical)}).withColumns({f"_n{a}": n for a, n in zip("xyz", normal)})
    p = p.withColumn("dist", rot.norm3("_ox", "_oy", "_oz"))
    u, v = camera.project((F.col("_ox"), F.col("_oy"), F.col("_oz")), *[F.lit(float(k[n])) for n in ("fx", "fy", "cx", "cy")])
    align = -rot.dot3(("_nx", "_ny", "_nz"), ("_ox", "_oy", "_oz")) / (F.col("dist") + 1e-9)
    return p.withColumns({"u": u, "v": v, "depth": F.col("_oz"), "align": align}).drop(
        *[f"_{o}{a}" for o in "on" for a in "xyz"])


def _cells_in_view(cells: DataFrame, cameras: DataFrame, k: dict, reach: float, done: float) -> DataFrame:
    """Cells of faces with the cameras whose widened image may show some of their box, for boxes that come within `reach` of the camera
    and do not lie wholly within `done`."""
    names = ("_gx", "_gy", "_gz")
    c = cameras.withColumns({n: cell(a, reach) for n, a in zip(names, CAM)})
    for n in names:
        c = c.withColumn(n, F.explode(F.sequence(F.col(n) - 1, F.col(n) + 1)))
    held = cells.withColumns({n: F.floor(F.col(f"c{a}") / 8).cast("long") for n, a in zip(names, "xyz")})
    pairs = held.join(c, ["bag_id", *names]).drop(*names)
    gap, far = F.lit(0.0), F.lit(0.0)
    for a, p in zip("xyz", CAM):
        g = F.greatest(F.lit(0.0), F.col(f"lo{a}") - F.col(p), F.col(p) - F.col(f"hi{a}"))
        h = F.greatest(F.col(f"hi{a}") - F.col(p), F.col(p) - F.col(f"lo{a}"))
        gap, far = gap + g * g, far + h * h
    pairs = pairs.filter((gap <= reach * reach) & (far > done * done))
    # Each side of the widened view is a plane through the camera; a box wholly behind one of them cannot be seen.
    fx, fy, cx, cy, w, h = (float(k[n]) for n in ("fx", "fy", "cx", "cy", "width", "height"))
    behind = None
    for side in range(5):
        all_out = None
        for corner in range(8):
            at = [F.col(f"{'hi' if corner >> i & 1 else 'lo'}{a}") for i, a in enumerate("xyz")]
            x, y, z = camera.world_to_optical(list(rot.MATRIX), CAM, at)
            value = (z - 0.1, fx * x + (cx + 0.5 * w) * z, (1.5 * w - cx) * z - fx * x, fy * y + (cy + 0.5 * h) * z, (1.5 * h - cy) * z - fy * y)[side]
            out = value < -1e-9
            all_out = out if all_out is None else all_out & out
        behind = all_out if behind is None else behind | all_out
    return pairs.filter(~behind)


def cull_faces(faces: DataFrame, cameras: DataFrame, k: dict, max_angle: float = 75.0, start: float = 8.0) -> DataFrame:
    """Faces in front of, turned to and within a half-image margin of at least one camera, at whatever distance.

    Rounds of growing reach, the first `start`: faces seen in one are done, and only boxes of the others' cells are tried against farther
    cameras before any face is. The last reach spans the scene.
    """
    span = [f(c).alias(f"{n}{a}") for a in "xyz" for n, f in (("lo", F.min), ("hi", F.max)) for c in [a]]
    eyes = [f(c).alias(f"{n}{a}") for a, c in zip("xyz", CAM) for n, f in (("lo", F.min), ("hi", F.max))]
    ends = faces.groupBy("bag_id").agg(*span).unionByName(cameras.groupBy("bag_id").agg(*eyes)).groupBy("bag_id").agg(
        *[F.min(f"lo{a}").alias(f"lo{a}") for a in "xyz"], *[F.max(f"hi{a}").alias(f"hi{a}") for a in "xyz"])
    width = ends.agg(F.max(sum((F.pow(F.col(f"hi{a}") - F.col(f"lo{a}"), 2) for a in "yz"), F.pow(F.col("hix") - F.col("lox"), 2)))).first()[0]
    widest = math.sqrt(width or 0.0) * (1 + 1e-9) + 1e-6
    w, h = F.lit(float(k["width"])), F.lit(float(k["height"]))
    eye = cameras.select("bag_id", "kf_idx", *CAM, *rot.MATRIX)
    open_ = faces.select("bag_id", "fid", "x", "y", "z", "nx", "ny", "nz")
    found, done, reach = [], 0.0, start
    while True:
        named = cut(open_.withColumns({f"c{a}": cell(a, reach / 8) for a in "xyz"}))
        key = ["bag_id", "cx", "cy", "cz"]
        boxes = named.groupBy(*key).agg(*[F.min(a).alias(f"lo{a}") for a in "xyz"], *[F.max(a).alias(f"hi{a}") for a in "xyz"])
        pairs = _cells_in_view(boxes, eye, k, reach, done).select(*key, "kf_idx")
        tried = named.join(pairs, key).drop("cx", "cy", "cz").join(eye, ["bag_id", "kf_idx"])
        g = view_geometry(tried, k)
        seen = (F.col("depth") > 0.1) & (F.col("align") > math.cos(math.radians(max_angle))) & camera.in_image(F.col("u"), F.col("v"), w, h, 0.5)
        seen = cut(g.filter(seen).select("bag_id", "fid").distinct())
        found.append(seen)
        if reach >= widest:
            return faces.join(reduce(DataFrame.unionByName, found), ["bag_id", "fid"], "left_semi")
        open_ = named.drop("cx", "cy", "cz").join(seen, ["bag_id", "fid"], "left_anti")
        done, reach = reach, reach * 4


def visible_pairs(faces: DataFrame, cameras: DataFrame, k: dict, max_angle: float = 75.0, near: float = 0.4,
                  far: float = 4.0, slack: float = 0.02) -> DataFrame:
    """Face and camera pairs that pass angle, distance and image bounds and lie at the front of their pixel."""
    g = view_geometry(face_view_pairs(faces, cameras, far), k)
    w, h = k["width"], k["height"]
    d2 = F.col("dist") * F.col("dist")
    ok = (
        (F.col("depth") > 0.1) & (F.col("align") > math.cos(math.radians(max_angle))) & (d2 < far * far) & (d2 > near * near)
        & camera.in_image(F.col("u"), F.col("v"), F.lit(float(w)), F.lit(float(h)))
    )
    g = g.filter(ok).withColumns({"pu": F.floor("u").cast("int"), "pv": F.floor("v").cast("int")})
    pixel = ["bag_id", "kf_idx", "pv", "pu"]
    front = g.groupBy(*pixel).agg(F.min("depth").alias("_z"))
    return g.join(front, pixel).filter(F.col("depth") < F.col("_z") + slack).drop("_z")


def sharpness_weights(keyframes: DataFrame) -> DataFrame:
    """Sharpness over the log's median, between one half and two."""
    med = exact_percentile(keyframes, "sharpness", 0.5, ["bag_id"], "med")
    weight = rot.clipped(F.col("sharpness") / (F.col("med") + 1e-6), 0.5, 2.0)
    return keyframes.join(med.select("bag_id", "med"), "bag_id").withColumn("sharp_w", weight).drop("med")


def assign_views(visible: DataFrame, k: dict) -> DataFrame:
    """Best camera per face (lowest index on a tie) and the number of cameras that see it."""
    vig = camera.vignette(F.col("u"), F.col("v"), F.lit(k["cx"]), F.lit(k["cy"]), F.lit(float(k["width"])), F.lit(float(k["height"])))
    score = F.col("align") * F.col("align") * vig * F.col("sharp_w") / (F.col("dist") * F.col("dist") + 1e-6)
    best = F.max(F.struct(score.alias("score"), (-F.col("kf_idx")).alias("neg")))
    return visible.groupBy("bag_id", "fid").agg(best.alias("b"), F.count(F.lit(1)).alias("views")).select(
        "bag_id", "fid", (-F.col("b.neg")).alias("kf_idx"), F.col("b.score").alias("score"), "views")


def nearest_camera(faces: DataFrame, cameras: DataFrame, spacing: float) -> DataFrame:
    """Index of the camera nearest to each face centre."""
    from waymark.operators.spacejoin import nearest

    spots = cameras.select("bag_id", F.col("kf_idx").cast("long").alias("point_idx"), *[F.col(c).alias(a) for c, a in zip(CAM, "xyz")])
    near = nearest(faces.withColumn("point_idx", F.col("fid")), spots, 1, spacing)
    return near.select("bag_id", "fid", F.get("neighbours", F.lit(0))["id"].cast("int").alias("kf_idx"))


def fill_unassigned(faces: DataFrame, assigned: DataFrame, cameras: DataFrame, spacing: float) -> DataFrame:
    """Every face gets a camera: its assigned one, else the nearest."""
    open_ = faces.join(assigned.filter(F.col("kf_idx").isNotNull()).select("bag_id", "fid"), ["bag_id", "fid"], "left_anti")
    near = nearest_camera(open_, cameras, spacing)
    return assigned.filter(F.col("kf_idx").isNotNull()).select("bag_id", "fid", F.col("kf_idx").cast("int").alias("kf_idx")).unionByName(near)


def visible_frames(points: DataFrame, keyframes: DataFrame, k: dict, tol_ns: int) -> DataFrame:
    """Scans (bag_id, ts_ns) with at least one world point in the image of a keyframe at most `tol_ns` away."""
    scans = points.select("bag_id", "ts_ns").distinct()
    cams = camera_table(keyframes)
    columns = [c for c in cams.columns if c not in ("bag_id", "ts_ns")]
    near = within_time(scans, cams, tol_ns, how="inner", right_payload=columns)
    p = points.select("bag_id", "ts_ns", "x", "y", "z").join(near, ["bag_id", "ts_ns"])
    o = camera.world_to_optical(list(rot.MATRIX), CAM, ("x", "y", "z"))
    p = p.withColumns({f"_o{a}": c for a, c in zip("xyz", o)})
    u, v = camera.project((F.col("_ox"), F.col("_oy"), F.col("_oz")), *[F.lit(float(k[n])) for n in ("fx", "fy", "cx", "cy")])
    seen = (F.col("_oz") > 0.1) & camera.in_image(u, v, F.lit(float(k["width"])), F.lit(float(k["height"])))
    return p.filter(seen).select("bag_id", "ts_ns").distinct()


def face_charts(assigned: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Connected faces of one camera form a chart: (bag_id, fid, kf_idx, chart)."""
    a = assigned.filter(F.col("kf_idx").isNotNull()).select("bag_id", "fid", "kf_idx")
    left = a.select("bag_id", F.col("fid").alias("u"), F.col("kf_idx").alias("_ku"))
    right = a.select("bag_id", F.col("fid").alias("v"), F.col("kf_idx").alias("_kv"))
    same = adjacency.join(left, ["bag_id", "u"]).join(right, ["bag_id", "v"]).filter("_ku = _kv").select("bag_id", "u", "v")
    labels = graph.components(a.select("bag_id", F.col("fid").alias("id")), same)
    return a.join(labels.select("bag_id", F.col("id").alias("fid"), F.col("label").alias("chart")), ["bag_id", "fid"])


def chart_uv(charts: DataFrame, faces: DataFrame, vertices: DataFrame, cameras: DataFrame, k: dict) -> DataFrame:
    """Image position of every chart vertex, clamped to half an image beyond the borders."""
    c = corners(faces).join(charts, ["bag_id", "fid"]).select("bag_id", "chart", "kf_idx", "vid").distinct()
    p = c.join(vertices.select("bag_id", "vid", "x", "y", "z"), ["bag_id", "vid"]).join(
        cameras.select("bag_id", "kf_idx", *CAM, *rot.MATRIX), ["bag_id", "kf_idx"])
    ox, oy, oz = camera.world_to_optical(list(rot.MATRIX), CAM, ("x", "y", "z"))
    z = F.greatest(oz, F.lit(0.1))
    w, h = float(k["width"]), float(k["height"])
    return p.select("bag_id", "chart", "kf_idx", "vid", rot.clipped(k["fx"] * ox / z + k["cx"], -w * 0.5, w * 1.5).alias("u"),
                    rot.clipped(k["fy"] * oy / z + k["cy"], -h * 0.5, h * 1.5).alias("v"))


def chart_boxes(uv: DataFrame, min_side: float = 64.0) -> DataFrame:
    """Bounds per chart; charts under `min_side` pixels in either direction are dropped."""
    box = uv.groupBy("bag_id", "chart", "kf_idx").agg(*[f(c).alias(n + c) for c in "uv" for n, f in (("min", F.min), ("max", F.max))])
    box = box.withColumns({"w": F.col("maxu") - F.col("minu"), "h": F.col("maxv") - F.col("minv")})
    return box.filter((F.col("w") >= min_side) & (F.col("h") >= min_side))


# Padding in pixels, share of the atlas to fill, largest side share, aspect limit, smallest side.
PAD, FILL, SIDE_SHARE, ASPECT, SMALLEST = 2, 0.6, 0.30, 4.0, 8


def size_charts(boxes: DataFrame, atlas: int) -> DataFrame:
    """Scale and block size of each chart: shared scale to fit the area, own scale for oversized ones, aspect limit."""
    area = boxes.groupBy("bag_id").agg(F.sum(F.col("w") * F.col("h")).alias("_area"))
    target = atlas * atlas * FILL
    b = boxes.join(area, "bag_id").withColumn("_g", F.when(F.col("_area") > target, F.sqrt(target / F.col("_area"))).otherwise(1.0))
    for side in "wh":
        b = b.withColumn(f"_{side}", F.greatest(F.lit(1), F.least(F.lit(atlas), F.ceil(F.col(side) * F.col("_g")).cast("int") + 2 * PAD)))
    limit = int(atlas * SIDE_SHARE)
    over = (F.col("_w") > limit) | (F.col("_h") > limit)
    b = b.withColumn("_cap", F.when(over, F.least(F.lit(limit) / F.col("_w"), F.lit(limit) / F.col("_h"))).otherwise(1.0))
    b = b.withColumn("scale", F.col("_g") * F.col("_cap"))
    for side in "wh":
        capped = F.greatest(F.lit(1), F.ceil(F.col(side) * F.col("scale")).cast("int") + 2 * PAD)
        b = b.withColumn(f"_{side}", F.when(F.col("_cap") < 1.0, capped).otherwise(F.col(f"_{side}")))
    wide = F.col("_w") / F.col("_h") > ASPECT
    tall = F.col("_h") / F.col("_w") > ASPECT
    b = b.withColumns({"_w2": F.when(wide, F.greatest(F.lit(1), (F.col("_h") * ASPECT).cast("int"))).otherwise(F.col("_w")),
                       "_h2": F.when(~wide & tall, F.greatest(F.lit(1), (F.col("_w") * ASPECT).cast("int"))).otherwise(F.col("_h"))})
    b = b.filter((F.col("_w2") >= SMALLEST) & (F.col("_h2") >= SMALLEST)).withColumn("rotated", F.col("_w2") > F.col("_h2"))
    return b.select("bag_id", "chart", "kf_idx", "minu", "minv", "w", "h", "scale", "rotated",
                    F.least("_w2", "_h2").alias("w_int"), F.greatest("_w2", "_h2").alias("h_int"))


def shelf_pack(charts: DataFrame, atlas: int, partitions: int | None = None) -> DataFrame:
    """Place charts on shelves, tallest first; a chart that does not fit the width starts a new shelf."""
    def step(state, row):
        chart, w, h = row
        x, y, shelf = state or (0.0, 0.0, 0.0)
        if x + w > atlas:
            x, y, shelf = 0.0, y + shelf, 0.0
        return (x + w, y, max(shelf, float(h))), (chart, int(x), int(y))

    placed = ordered_fold(charts, ["bag_id"], [F.desc("h_int"), F.desc("w_int"), "chart"], ["chart", "w_int", "h_int"], step,
                          "chart long, px int, py int", partitions)
    return charts.join(placed, ["bag_id", "chart"])


def atlas_height(packed: DataFrame) -> DataFrame:
    top = F.max(F.col("py") + F.col("h_int"))
    return packed.groupBy("bag_id").agg((F.ceil(top / 1024.0) * 1024).cast("int").alias("final_h"))


def face_uvs(faces: DataFrame, charts: DataFrame, uv: DataFrame, packed: DataFrame, atlas: int) -> DataFrame:
    """Texture coordinates (ua, va) of every face corner."""
    c = corners(faces).join(charts.select("bag_id", "fid", "chart"), ["bag_id", "fid"])
    p = packed.select("bag_id", "chart", "px", "py", "scale", "rotated", "minu", "minv").join(atlas_height(packed), "bag_id")
    j = c.join(uv.select("bag_id", "chart", "vid", "u", "v"), ["bag_id", "chart", "vid"]).join(p, ["bag_id", "chart"])
    du, dv = (F.col("u") - F.col("minu")) * F.col("scale"), (F.col("v") - F.col("minv")) * F.col("scale")
    across, down = F.when(F.col("rotated"), dv).otherwise(du), F.when(F.col("rotated"), du).otherwise(dv)
    return j.select("bag_id", "fid", "corner", ((F.col("px") + PAD + across) / atlas).alias("ua"),
                    (1.0 - (F.col("py") + PAD + down) / F.col("final_h")).alias("va"))


def bake_texels(packed: DataFrame, pixels: DataFrame, keyframes: DataFrame, atlas: int, k: dict,
                channels=("r", "g", "b")) -> DataFrame:
    """Atlas texels with their source colour; of overlapping charts the one packed later wins.

    Rows of a block are listed first and spread over tasks before their columns are.
    """
    p = packed.join(keyframes.select("bag_id", "kf_idx", F.col("ts_ns").alias("image_ts_ns")), ["bag_id", "kf_idx"]).join(
        atlas_height(packed), "bag_id")
    rows = p.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("h_int") - 1))).repartition("bag_id", "chart", "j")
    t = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("w_int") - 1)))
    across, down = (F.col("i") - PAD) / F.col("scale"), (F.col("j") - PAD) / F.col("scale")
    su = (F.col("minu") + F.when(F.col("rotated"), down).otherwise(across)).cast("int")
    sv = (F.col("minv") + F.when(F.col("rotated"), across).otherwise(down)).cast("int")
    t = t.withColumns({"u": su, "v": sv, "ax": F.col("px") + F.col("i"), "ay": F.col("py") + F.col("j")})
    ok = (F.col("u") >= 0) & (F.col("u") < k["width"]) & (F.col("v") >= 0) & (F.col("v") < k["height"]) & (F.col("ax") < atlas) & (
        F.col("ay") < F.col("final_h"))
    hit = t.filter(ok).join(pixels.select("bag_id", "image_ts_ns", "v", "u", *channels), ["bag_id", "image_ts_ns", "v", "u"])
    # later means lower on the sort order of the packer
    last = F.struct(-F.col("h_int"), -F.col("w_int"), F.col("chart"))
    return hit.groupBy("bag_id", "ax", "ay").agg(F.max_by(F.struct(*channels), last).alias("c")).select("bag_id", "ax", "ay", "c.*")


def face_coverage(faces: DataFrame, assigned: DataFrame) -> DataFrame:
    """Cameras per face and the share of five, clipped to one, that colours a coverage picture."""
    seen = assigned.select("bag_id", "fid", "views")
    return faces.select("bag_id", "fid").join(seen, ["bag_id", "fid"], "left").select(
        "bag_id", "fid", F.coalesce("views", F.lit(0)).alias("views"),
        rot.clipped(F.coalesce("views", F.lit(0)) / 5.0, 0.0, 1.0).alias("level"))
