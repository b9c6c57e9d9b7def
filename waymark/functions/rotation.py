"""Quaternion and rigid-transform arithmetic as column expressions (x, y, z, w order)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUAT = ("qx", "qy", "qz", "qw")
POSITION = ("px", "py", "pz")
MATRIX = tuple(f"r{i}{j}" for i in range(3) for j in range(3))


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def norm3(x, y, z) -> Column:
    x, y, z = _cols((x, y, z))
    return F.sqrt(x * x + y * y + z * z)


def distance3(a, b) -> Column:
    a, b = _cols(a), _cols(b)
    return norm3(*(p - q for p, q in zip(a, b)))


def dot3(a, b) -> Column:
    a, b = _cols(a), _cols(b)
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross3(a, b) -> tuple[Column, Column, Column]:
    a, b = _cols(a), _cols(b)
    return (
        a[1] * b[2] - a[2] * b[1],
        a[2] * b[0] - a[0] * b[2],
        a[0] * b[1] - a[1] * b[0],
    )


def normalize3(x, y, z, eps: float = 1e-12) -> tuple[Column, Column, Column]:
    """Unit vector; a vector no longer than `eps` becomes zero."""
    n = norm3(x, y, z)
    return tuple(F.when(n > eps, c / n).otherwise(F.lit(0.0)) for c in _cols((x, y, z)))


def quat_norm(q=QUAT) -> Column:
    x, y, z, w = _cols(q)
    return F.sqrt(x * x + y * y + z * z + w * w)


def quat_to_matrix(q=QUAT) -> dict[str, Column]:
    """Nine entries of the rotation matrix of the normalised quaternion."""
    n = quat_norm(q)
    x, y, z, w = (c / n for c in _cols(q))
    return {
        "r00": 1 - 2 * (y * y + z * z), "r01": 2 * (x * y - z * w), "r02": 2 * (x * z + y * w),
        "r10": 2 * (x * y + z * w), "r11": 1 - 2 * (x * x + z * z), "r12": 2 * (y * z - x * w),
        "r20": 2 * (x * z - y * w), "r21": 2 * (y * z + x * w), "r22": 1 - 2 * (x * x + y * y),
    }


def rotate(m, v) -> tuple[Column, Column, Column]:
    """m · v for a row-major list of nine entries."""
    m, v = _cols(m), _cols(v)
    return tuple(m[3 * i] * v[0] + m[3 * i + 1] * v[1] + m[3 * i + 2] * v[2] for i in range(3))


def rotate_back(m, v) -> tuple[Column, Column, Column]:
    """mᵀ · v."""
    m, v = _cols(m), _cols(v)
    return tuple(m[i] * v[0] + m[3 + i] * v[1] + m[6 + i] * v[2] for i in range(3))


def matmul(a, b) -> list[Column]:
    a, b = _cols(a), _cols(b)
    return [
        a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j]
        for i in range(3)
        for j in range(3)
    ]


def transpose(m) -> list[Column]:
    m = _cols(m)
    return [m[3 * j + i] for i in range(3) for j in range(3)]


def relative_pose(m1, t1, m2, t2) -> tuple[list[Column], tuple[Column, ...]]:
    """inverse(pose 1) ∘ pose 2."""
    t1, t2 = _cols(t1), _cols(t2)
    return matmul(transpose(m1), m2), rotate_back(m1, tuple(b - a for a, b in zip(t1, t2)))


def compose_pose(m1, t1, m2, t2) -> tuple[list[Column], tuple[Column, ...]]:
    t1 = _cols(t1)
    moved = rotate(m1, t2)
    return matmul(m1, m2), tuple(a + b for a, b in zip(moved, t1))


def clipped(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def trace_angle_deg(trace: Column) -> Column:
    return F.degrees(F.acos(clipped((trace - 1.0) / 2.0, -1.0, 1.0)))


def relative_angle_deg(q1, q2) -> Column:
    """Angle of inverse(q1)·q2 in degrees, by the arc tangent, which stays exact for tiny turns."""
    a, b = _cols(q1), _cols(q2)
    dot = sum((p * q for p, q in zip(a[1:], b[1:])), a[0] * b[0])
    turn = cross3(b[:3], a[:3])
    vec = [a[3] * b[i] - b[3] * a[i] + turn[i] for i in range(3)]
    return F.degrees(2.0 * F.atan2(norm3(*vec), F.abs(dot)))


def quat_angle_rad(q1, q2) -> Column:
    a, b = _cols(q1), _cols(q2)
    dot = sum((p * q for p, q in zip(a[1:], b[1:])), a[0] * b[0])
    return 2.0 * F.acos(F.least(F.lit(1.0), F.abs(dot)))


def lerp(a, b, t: Column) -> Column:
    a, b = _cols((a, b))
    return a * (1.0 - t) + b * t


def with_slerp(df, q1, q2, t: str, names=QUAT):
    """Add the shortest-arc interpolation of two unit quaternions as columns `names`.

    Nearly equal rotations are blended and renormalised. Added in steps so that each angle is
    computed once and generated code stays small.
    """
    a, b = _cols(q1), _cols(q2)
    raw = sum((p * q for p, q in zip(a[1:], b[1:])), a[0] * b[0])
    df = df.withColumn("_dot", raw)
    df = df.withColumn("_cos", F.least(F.lit(1.0), F.abs("_dot")))
    df = df.withColumn("_ang", F.acos("_cos"))
    f = F.col(t)
    near = F.col("_cos") > 0.9999999
    df = df.withColumn("_wa", F.when(near, 1.0 - f).otherwise(F.sin((1.0 - f) * F.col("_ang")) / F.sin("_ang")))
    df = df.withColumn("_wb", F.when(F.col("_dot") < 0, -1.0).otherwise(1.0)
                       * F.when(near, f).otherwise(F.sin(f * F.col("_ang")) / F.sin("_ang")))
    mixed = [f"_m{i}" for i in range(4)]
    df = df.withColumns({m: F.col("_wa") * p + F.col("_wb") * q for m, p, q in zip(mixed, a, b)})
    df = df.withColumn("_len", quat_norm(mixed))
    df = df.withColumns({n: F.col(m) / F.col("_len") for n, m in zip(names, mixed)})
    return df.drop("_dot", "_cos", "_ang", "_wa", "_wb", "_len", *mixed)
