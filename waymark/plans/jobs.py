"""Whole jobs over message-derived tables, for all logs at once.

Inputs are points(bag_id, ts_ns, point_idx, x, y, z) in the sensor frame, odom, and where needed images,
camera calibrations and fixes. Intermediate tables that several later steps read are written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators import colour, floor, gating, graph, mesh, occupancy, outliers, points as pts, registration, timejoin, views
from waymark.session import cut
from waymark.sources import messages


@dataclass(frozen=True)
class CloudConfig:
    """Defaults of the registered-cloud jobs."""

    voxel: float = 0.05
    min_frame_points: int = 100
    mode: str = "local"
    min_move: float = 0.10
    min_rotation_deg: float = 5.0
    max_frames: int = 0
    max_latency_ns: int = 500_000_000
    loss_multiplier: float = 6.0
    level: bool = False
    clean: bool = True
    icp: bool = False
    icp_dist: float = 0.2
    bucket_ns: int = timejoin.BUCKET_NS


@dataclass(frozen=True)
class ColourConfig:
    max_dt_ns: int = 100_000_000
    min_depth: float = 0.1
    max_depth: float | None = None
    gray_radius: float = 0.05


@dataclass(frozen=True)
class SurfaceConfig:
    support_percentile: float = 1.0
    distance_multiplier: float = 3.0
    max_distance: float | None = None
    smooth_iterations: int = 5
    target: float | None = None
    curvature_percentile: float = 80.0
    rings: int = 1


@dataclass(frozen=True)
class MapConfig:
    voxel: float = 0.10
    res: float = 0.1
    grid_res: float = 0.1
    slope_deg: float = 15.0
    normal_radius: float = 0.2
    z_min: float = 0.1
    z_max: float = 2.0
    stride: int = 2
    max_frames: int = 0
    min_cluster: int = 20
    closing: int = 1
    max_range: float = 40.0
    max_latency_ns: int = 500_000_000
    mode: str = "local"
    bucket_ns: int = timejoin.BUCKET_NS


def registered_frames(points: DataFrame, odom: DataFrame, cfg: CloudConfig, modes: DataFrame | None = None
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Voxelised scans in the sensor frame, the pose that moves every selected scan into the world, and the odometry pose of its sensor."""
    big = pts.min_frame_points(points, cfg.min_frame_points)
    scans = pts.voxel_downsample(big, cfg.voxel, ("bag_id", "ts_ns")).select("bag_id", "ts_ns", "x", "y", "z")
    scans = cut(pts.min_frame_points(scans, cfg.min_frame_points))
    reg = registration.register_frames(
        scans, odom, cfg.mode if modes is None else modes, cfg.max_latency_ns, cfg.min_move, cfg.min_rotation_deg, cfg.max_frames,
        loss_multiplier=cfg.loss_multiplier, bucket_ns=cfg.bucket_ns)
    poses = cut(reg.poses)
    if cfg.icp:
        pairs = registration.frame_pairs(poses, cfg.bucket_ns)
        refined = registration.icp_refine(scans, pairs, cfg.icp_dist, max(cfg.voxel * 2.0, 1e-4))
        poses = cut(registration.refined_poses(poses, registration.gate_correction(refined)))
    return scans, poses, reg.sensors


def registered_cloud(points: DataFrame, odom: DataFrame, cfg: CloudConfig = CloudConfig(), modes: DataFrame | None = None) -> DataFrame:
    """One cleaned world cloud per log with the mean view ray (rx, ry, rz) of every point.

    Rays start where odometry has the sensor, in logs of either mode and with refined poses too; points of scans without odometry add
    none. `modes` (bag_id, frame_mode) tells the mode of each log; without it `cfg.mode` holds for all.
    """
    scans, poses, sensors = registered_frames(points, odom, cfg, modes)
    world = pts.attach_view_rays(pts.transform_points(scans, poses), sensors)
    world = world.withColumnsRenamed({"vx": "rx", "vy": "ry", "vz": "rz"})
    merged = pts.voxel_downsample(world, cfg.voxel, means=("rx", "ry", "rz")).withColumn("point_idx", pts.voxel_id())
    cloud = cut(merged.select("bag_id", "point_idx", "x", "y", "z", "rx", "ry", "rz"))
    if cfg.level:
        cloud = cut(floor.level_floor(cloud))
    return outliers.clean_points(cloud, cfg.voxel, downsample=False) if cfg.clean else cloud


def coloured_cloud(points: DataFrame, odom: DataFrame, images: DataFrame, info: DataFrame, cfg: CloudConfig = CloudConfig(),
                   ccfg: ColourConfig = ColourConfig(), modes: DataFrame | None = None) -> DataFrame:
    """World cloud with camera colours; placeholder-gray points near coloured ones are removed over the whole log.

    The camera stands where odometry has it, in logs of either mode and with refined poses too, and at the world's origin for scans
    without odometry. A log's first calibration holds for all its scans, also for those before it.
    """
    scans, poses, sensors = registered_frames(points, odom, cfg, modes)
    eye = {c: F.coalesce(c, F.lit(1.0 if c == "qw" else 0.0)) for c in timejoin.POSE}
    cameras = cut(poses.select("bag_id", "ts_ns").join(sensors.select("bag_id", "ts_ns", *timejoin.POSE), ["bag_id", "ts_ns"], "left").withColumns(eye))
    matched = colour.match_images(cameras, images.select("bag_id", "ts_ns"), ccfg.max_dt_ns, cfg.bucket_ns)
    cams = messages.intrinsics_for(matched.select("bag_id", "ts_ns", "image_ts_ns"), messages.decode_camera_info(info), "earliest")
    seen = cut(matched.join(cams.drop("image_ts_ns"), ["bag_id", "ts_ns"], "left"))
    world = pts.transform_points(scans, poses)
    projected = colour.project_points(world, seen, ccfg.min_depth, ccfg.max_depth)
    used = seen.select("bag_id", F.col("image_ts_ns").alias("ts_ns")).distinct()
    tinted = colour.sample_images(projected, images.join(used, ["bag_id", "ts_ns"], "left_semi"))
    merged = cut(pts.voxel_downsample(tinted, cfg.voxel, means=("r", "g", "b")).withColumn("point_idx", pts.voxel_id()).select(
        "bag_id", "point_idx", "x", "y", "z", "r", "g", "b"))
    cloud = cut(pts.drop_gray_near_color(merged, ccfg.gray_radius))
    if cfg.level:
        cloud = cut(floor.level_floor(cloud))
    return outliers.clean_points(cloud, cfg.voxel, downsample=False) if cfg.clean else cloud


def surface_mesh(cloud: DataFrame, size: float, cfg: SurfaceConfig = SurfaceConfig()) -> tuple[DataFrame, DataFrame]:
    """Voxel surface of a cloud: trimmed by support and distance, cleaned, smoothed and optionally simplified.

    `cloud` is read three times at most and not kept: hand in a table, or rows that are cheap to make again.
    """
    solid = cut(pts.voxel_downsample(cloud, size))
    v, f = mesh.voxel_surface(solid, size)
    f = cut(f)
    v = mesh.vertices_of(f, size)
    support = mesh.corners(f).groupBy("bag_id", "vid").agg(F.count(F.lit(1)).alias("support"))
    v, f = mesh.trim_low_support(cut(v.join(support, ["bag_id", "vid"])), f, cfg.support_percentile)
    limits = mesh.trim_limits(outliers.mean_spacing(solid.withColumn("point_idx", pts.voxel_id()), size * 2.0),
                              cfg.distance_multiplier, cfg.max_distance)
    v, f = mesh.trim_far_vertices(cut(v.drop("support")), cut(f), cloud, cut(limits))
    v, f = mesh.clean_mesh(cut(v), cut(f))
    v, f = cut(v), cut(f)
    v = mesh.smooth_mesh(v, f, "laplacian", cfg.smooth_iterations)
    if cfg.target is not None:
        v, f = mesh.simplify_mesh(v, f, cfg.target, size, cfg.curvature_percentile, cfg.rings)
    return v, f


def model_export(cloud: DataFrame, size: float, path: str, cfg: SurfaceConfig = SurfaceConfig()) -> DataFrame:
    """Centred mesh written as facet text; returns its vertices."""
    v, f = surface_mesh(cloud, size, cfg)
    v = cut(mesh.center_mesh(v))
    mesh.write_stl(v, f, path)
    return v


def geo_tiles(cloud: DataFrame, fixes: DataFrame, voxel: float, tile: float, levels=pts.LOD_LEVELS, means=()) -> tuple[DataFrame, DataFrame]:
    """Levels of detail with earth-fixed coordinates, and their tile manifest."""
    layers = pts.to_ecef(pts.lod_pyramid(cut(cloud), voxel, levels, means), messages.gps_origin(fixes))
    return layers, pts.tile_manifest(layers, tile)


def write_lod_tiles(layers: DataFrame, manifest: DataFrame, tile: float, path: str) -> None:
    """Layers in folders by log and level, clustered by tile inside; the manifest beside them."""
    keyed = layers.withColumns({"tile_x": F.floor(F.col("x") / tile), "tile_y": F.floor(F.col("y") / tile)})
    keyed.repartitionByRange("bag_id", "lod", "tile_x", "tile_y").sortWithinPartitions("bag_id", "lod", "tile_x", "tile_y").write.partitionBy(
        "bag_id", "lod").mode("overwrite").parquet(f"{path}/layers")
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")


def occupancy_map(points: DataFrame, odom: DataFrame, cfg: MapConfig = MapConfig()) -> tuple[DataFrame, DataFrame]:
    """Occupancy grid (bag_id, gx, gy, value) and raster extents per log."""
    frames = gating.stride_frames(points.select("bag_id", "ts_ns").distinct(), cfg.stride, cfg.max_frames)
    poses = cut(timejoin.interpolate_pose(frames, odom, cfg.max_latency_ns, bucket_ns=cfg.bucket_ns, keep_uncovered=False))
    if cfg.mode == "local":  # rays start at the odometry pose in both modes
        world = pts.transform_points(points, poses, rays=True)
    else:
        world = pts.attach_view_rays(points.join(poses.select("bag_id", "ts_ns"), ["bag_id", "ts_ns"], "left_semi"), poses)
    world = cut(world)
    rays = world.select("bag_id", "ts_ns", "x", "y", "z", *[(F.col(a) + F.col(f"v{a}")).alias(f"o{a}") for a in "xyz"])
    voxels = occupancy.occupancy(rays, cfg.res, cfg.max_range)
    scans = pts.voxel_downsample(world.drop("vx", "vy", "vz"), cfg.voxel, ("bag_id", "ts_ns"))
    cloud = cut(scans.withColumn("point_idx", F.xxhash64("ts_ns", "vx", "vy", "vz")).select("bag_id", "point_idx", "x", "y", "z"))
    small = cut(pts.voxel_downsample(cloud, cfg.voxel).withColumn("point_idx", pts.voxel_id()))
    normals = cut(pts.orient_up(outliers.estimate_normals(small, cfg.normal_radius, 30, cfg.voxel * 2.0, copies=False)))
    ground = cut(outliers.split_ground(outliers.borrow_normals(cloud, normals, cfg.voxel * 4.0), cfg.slope_deg).filter("ground"))
    ext = cut(pts.extent(cloud, cfg.grid_res))
    heights = occupancy.fill_ground(occupancy.ground_height(ground, ext, cfg.grid_res), ground, ext)
    grid = occupancy.occupancy_grid(heights, voxels, ext, cfg.grid_res, cfg.res, cfg.z_min, cfg.z_max)
    return occupancy.filter_small_clusters(grid, ext, cfg.min_cluster, cfg.closing), ext


@dataclass(frozen=True)
class TextureConfig:
    size: float = 0.05
    angle: float = 75.0
    near: float = 0.4
    far: float = 4.0
    smooth: int = 3
    atlas: int = 8192
    min_side: float = 64.0
    tol_ns: int = 500_000_000


def texture_tables(cloud: DataFrame, keyframes: DataFrame, images: DataFrame, k: dict, cfg: TextureConfig = TextureConfig()) -> dict[str, DataFrame]:
    """Mesh, view assignment, charts, texture coordinates and baked texels of a world cloud (with ts_ns).

    Scans no keyframe sees are left out first.
    """
    cloud = cut(cloud)
    keyframes = cut(views.sharpness_weights(keyframes))
    seen = views.visible_frames(cloud, keyframes, k, cfg.tol_ns)
    cloud = cut(cloud.join(seen, ["bag_id", "ts_ns"], "left_semi"))
    thin = pts.voxel_first(cloud, cfg.size, ["ts_ns"])
    v, f = mesh.voxel_surface(thin, cfg.size)
    f = cut(f)
    v = cut(mesh.smooth_mesh(mesh.vertices_of(f, cfg.size), f, "taubin", 5, 0.5))
    cams = cut(views.camera_table(keyframes))
    geo = cut(mesh.face_geometry(v, f))
    geo = cut(views.cull_faces(geo, cams, k, cfg.angle))
    best = views.assign_views(views.visible_pairs(geo, cams, k, cfg.angle, cfg.near, cfg.far), k)
    faces = cut(geo.select("bag_id", "fid", "v0", "v1", "v2"))
    adjacency = cut(mesh.face_adjacency(faces))
    start = faces.select("bag_id", "fid").join(best.select("bag_id", "fid", "kf_idx"), ["bag_id", "fid"], "left")
    labels = graph.smooth_labels(start, adjacency, cfg.smooth)
    full = cut(views.fill_unassigned(geo, labels, cams, cfg.far * 2.0))
    charts = cut(views.face_charts(full, adjacency))
    uv = cut(views.chart_uv(charts, faces, v, cams, k))
    packed = cut(views.shelf_pack(views.size_charts(views.chart_boxes(uv, cfg.min_side), cfg.atlas), cfg.atlas))
    pixel = messages.pixels(images)
    first = keyframes.groupBy("bag_id").agg(F.min("ts_ns").alias("image_ts_ns"))
    lit = colour.match_lightness(pixel, first).withColumnRenamed("l_matched", "light").drop("l")
    texels = views.bake_texels(packed, lit, keyframes, cfg.atlas, k, ("r", "g", "b", "light"))
    return {"vertices": v, "faces": faces, "views": full, "charts": packed,
            "uvs": views.face_uvs(faces, charts, uv, packed, cfg.atlas), "texels": texels}


