"""Spatial log analytics on Spark: tables of messages, poses, points, voxels, pixels and faces, keyed by log."""
