"""Closed form of the direction of least spread of a symmetric 3×3 matrix, in columns.

The least eigenvalue comes from the cosine form of the characteristic cubic, its direction from the longest cross product of two rows of the
shifted matrix. Where the two smaller eigenvalues agree every direction of their plane is one of least spread: the one closest to vertical is taken,
and where all three agree vertical itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import rotation as rot

#: Eigenvalues whose difference is below this share of their deviation count as equal.
SAME = 1e-6


def least_direction(df: DataFrame, matrix: tuple[str, ...], out: tuple[str, str, str] = ("nx", "ny", "nz")) -> DataFrame:
    """`df` with the unit vector `out`; `matrix` names the entries xx, xy, xz, yy, yz, zz. The sign is arbitrary. Names that begin with _e are used
    on the way; every step is a projection of its own, so that no term is computed twice."""
    xx, xy, xz, yy, yz, zz = (F.col(c) for c in matrix)
    q, p, a, low = (F.col(c) for c in ("_eq", "_ep", "_ea", "_elow"))
    df = df.withColumn("_eq", (xx + yy + zz) / 3.0)
    df = df.withColumn("_ep", F.sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2.0 * (xy * xy + xz * xz + yz * yz)) / 6.0))
    det = (xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)
    df = df.withColumn("_ea", F.when(p > 0, F.acos(rot.clipped(det / (2.0 * p * p * p), -1.0, 1.0)) / 3.0).otherwise(0.0))
    third = 2.0 * math.pi / 3.0
    df = df.withColumn("_eflat", F.cos(a + 2.0 * third) - F.cos(a + third) <= SAME)
    # Of two equal ones the mean is taken, which is exact where each alone is not.
    df = df.withColumn("_elow", F.when(F.col("_eflat"), q - p * F.cos(a)).otherwise(q + 2.0 * p * F.cos(a + third)))
    df = df.withColumns({"_e0": F.array(xx - low, xy, xz), "_e1": F.array(xy, yy - low, yz), "_e2": F.array(xz, yz, zz - low)})

    def at(name: str) -> list[Column]:
        return [F.get(name, F.lit(i)) for i in range(3)]

    df = df.withColumns({f"_ec{i}{j}": F.array(*rot.cross3(at(f"_e{i}"), at(f"_e{j}"))) for i, j in ((0, 1), (0, 2), (1, 2))})
    length = {c: rot.dot3(at(c), at(c)) for c in ("_e0", "_e1", "_e2", "_ec01", "_ec02", "_ec12")}
    df = df.withColumns({f"{c}l": v for c, v in length.items()})

    def longest(*names: str) -> Column:
        best = F.col(names[-1])
        for k, name in reversed(list(enumerate(names[:-1]))):
            best = F.when(F.col(f"{name}l") >= F.greatest(*[F.col(f"{n}l") for n in names[k + 1:]], F.lit(0.0)), F.col(name)).otherwise(best)
        return best

    df = df.withColumns({"_ecross": longest("_ec01", "_ec02", "_ec12"), "_erow": longest("_e0", "_e1", "_e2")})
    # Vertical without its part along the row, the one direction that is not of least spread; x where the row is vertical.
    wx, wy, wz = at("_erow")
    level = wx * wx + wy * wy
    upright = F.when(level > SAME * SAME * (level + wz * wz), F.array(-wz * wx, -wz * wy, level)).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))
    df = df.withColumn("_en", F.when(p <= 0, F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))).when(F.col("_eflat"), upright).otherwise(F.col("_ecross")))
    df = df.withColumn("_el", F.sqrt(rot.dot3(at("_en"), at("_en"))))
    temporary = [c for c in df.columns if c.startswith("_e")]
    return df.withColumns({n: F.get("_en", F.lit(i)) / F.col("_el") for i, n in enumerate(out)}).drop(*temporary)


def least_direction_sql(source: str) -> str:
    """The same for a SQL relation with the entries as columns: all its columns, nx, ny, nz and flat."""
    third = 2.0 * math.pi / 3.0
    rows = {"a": ("xx - low", "xy", "xz"), "b": ("xy", "yy - low", "yz"), "c": ("xz", "yz", "zz - low")}

    def cross(u: str, v: str) -> str:
        (a, b, c), (d, e, f) = rows[u], rows[v]
        return f"[({b}) * ({f}) - ({c}) * ({e}), ({c}) * ({d}) - ({a}) * ({f}), ({a}) * ({e}) - ({b}) * ({d})]"

    def longest(names: list[str]) -> str:
        return f"list_sort([{', '.join(f'struct_pack(l := list_dot_product({n}, {n}), v := {n})' for n in names)}], 'DESC')[1].v"

    shift = f"CASE WHEN flat THEN q - p * cos(ang) ELSE q + 2 * p * cos(ang + {third}) END"
    det = "(xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)"
    upright = f"""CASE WHEN w[1] * w[1] + w[2] * w[2] > {SAME * SAME} * list_dot_product(w, w) THEN [-w[3] * w[1], -w[3] * w[2], w[1] * w[1] + w[2] * w[2]]
      ELSE [1.0::DOUBLE, 0.0, 0.0] END"""
    return f"""
  SELECT * EXCLUDE (q, p, ang, low, k1, k2, k3, w, m), m[1] / sqrt(list_dot_product(m, m)) AS nx, m[2] / sqrt(list_dot_product(m, m)) AS ny, m[3] / sqrt(list_dot_product(m, m)) AS nz FROM (
  SELECT * EXCLUDE (r1, r2, r3), CASE WHEN p <= 0 THEN [0.0::DOUBLE, 0.0, 1.0] WHEN flat THEN {upright} ELSE {longest(['k1', 'k2', 'k3'])} END AS m FROM (
  SELECT *, {longest(['r1', 'r2', 'r3'])} AS w FROM (
  SELECT *, {cross('a', 'b')} AS k1, {cross('a', 'c')} AS k2, {cross('b', 'c')} AS k3, [xx - low, xy, xz] AS r1, [xy, yy - low, yz] AS r2, [xz, yz, zz - low] AS r3 FROM (
  SELECT *, {shift} AS low FROM (
  SELECT *, cos(ang + {2 * third}) - cos(ang + {third}) <= {SAME} AS flat FROM (
  SELECT *, CASE WHEN p > 0 THEN acos(greatest(-1.0, least(1.0, ({det}) / (2 * p * p * p)))) / 3 ELSE 0.0 END AS ang FROM (
  SELECT *, sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * (xy * xy + xz * xz + yz * yz)) / 6) AS p FROM (
  SELECT *, (xx + yy + zz) / 3 AS q FROM ({source})))))))))"""
