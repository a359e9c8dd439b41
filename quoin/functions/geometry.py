"""Column expressions for geometry. A ring is an array of structs in order, without a closing corner.

Every expression is a built-in one, so it stays in generated code or in higher-order functions of the
JVM. Literals are doubles: decimal arithmetic would round differently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lit(x: float) -> Column:
    return F.lit(float(x))


def pack(order: str, *columns: str) -> Column:
    """Aggregate: the rows of a group as a ring, in the order of a column."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, *columns))), lambda p: F.struct(*[p[c].alias(c) for c in columns]))


def corner(ring: Column, i: Column) -> Column:
    """The i-th corner, counted from 0 and around the ring."""
    return F.get(ring, F.pmod(i, F.size(ring)))


def around(ring: Column, f: Callable[[Column, Column, Column], Column]) -> Column:
    """f(corner, next, second next) for every corner of a ring."""
    return F.transform(F.sequence(F.lit(0), F.size(ring) - 1), lambda i: f(corner(ring, i), corner(ring, i + 1), corner(ring, i + 2)))


def total(values: Column) -> Column:
    return F.aggregate(values, lit(0), lambda acc, x: acc + x)


def cross(a: tuple, b: tuple) -> tuple[Column, Column, Column]:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def minus(p: Column, q: Column) -> tuple[Column, Column, Column]:
    return p["x"] - q["x"], p["y"] - q["y"], p["z"] - q["z"]


def norm(v: tuple) -> Column:
    return F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])


def crosses(ring: Column) -> Column:
    """cross(b - a, c - b) at every corner, as structs; each product is made once."""

    def one(a, b, c):
        v = cross(minus(b, a), minus(c, b))
        return F.struct(v[0].alias("x"), v[1].alias("y"), v[2].alias("z"))

    return around(ring, one)


def summed_normal(ring: Column) -> Column:
    """The sum over all corners of cross(b - a, c - b), a struct."""
    zero = F.struct(lit(0).alias("x"), lit(0).alias("y"), lit(0).alias("z"))
    return F.aggregate(crosses(ring), zero, lambda s, v: F.struct((s["x"] + v["x"]).alias("x"), (s["y"] + v["y"]).alias("y"), (s["z"] + v["z"]).alias("z")))


def length(v: Column) -> Column:
    return norm((v["x"], v["y"], v["z"]))


def first_normal(ring: Column, least: float = 1e-7) -> Column:
    """Unit normal of the first three consecutive corners that span one, else null."""
    sized = F.transform(crosses(ring), lambda v: F.struct(v.alias("v"), length(v).alias("n")))
    unit = F.transform(F.filter(sized, lambda s: s["n"] > least), lambda s: F.struct(*[(s["v"][c] / s["n"]).alias(c) for c in "xyz"]))
    return F.get(unit, F.lit(0))


def plane_area(ring: Column, u: str = "u", v: str = "v") -> Column:
    """A1: area of a plane ring, without sign."""
    return F.abs(total(around(ring, lambda a, b, c: a[u] * b[v] - b[u] * a[v]))) / lit(2)


def inside(ring: Column, px: Column, py: Column, x: str = "x", y: str = "y") -> Column:
    """Whether a point lies strictly inside a plane ring: an odd number of edges to its right, and on none."""
    crosses = F.size(F.filter(around(ring, lambda a, b, c: ((a[y] > py) != (b[y] > py)) & (px < (b[x] - a[x]) * (py - a[y]) / F.nullif(b[y] - a[y], lit(0)) + a[x])), lambda hit: hit))
    on = F.exists(around(ring, lambda a, b, c: on_segment(a[x], a[y], b[x], b[y], px, py)), lambda hit: hit)
    return (crosses % 2 == 1) & ~on


def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Sign of the turn from a over b to c: 1 left, -1 right, 0 straight."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def on_segment(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (turn(ax, ay, bx, by, px, py) == 0) & px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))


def touches(a: Column, b: Column, c: Column, d: Column, x: str = "x", y: str = "y") -> Column:
    """Segments ab and cd meet, and only at an end of at least one; a proper crossing is no touch.

    Segments on one line that share more than a point overlap, and do not touch.
    """
    t = lambda p, q, r: turn(p[x], p[y], q[x], q[y], r[x], r[y])
    on = lambda p, q, r: on_segment(p[x], p[y], q[x], q[y], r[x], r[y])
    meet = on(a, b, c) | on(a, b, d) | on(c, d, a) | on(c, d, b)
    straight = (t(a, b, c) == 0) & (t(a, b, d) == 0)
    along = lambda p: (p[x] - a[x]) * (b[x] - a[x]) + (p[y] - a[y]) * (b[y] - a[y])
    whole = along(b)
    shared = F.least(F.greatest(along(c), along(d)), F.greatest(whole, lit(0))) - F.greatest(F.least(along(c), along(d)), F.least(whole, lit(0)))
    return meet & ~(straight & (shared > 0))


def rotation(omega: Column, phi: Column, kappa: Column, mode: str = "xyz") -> dict[str, Column]:
    """G1: the nine entries of Rx(omega) Ry(phi) Rz(kappa), or of Rz Ry Rx; angles in degrees."""
    so, co, sp, cp, sk, ck = (f(F.radians(a)) for a in (omega, phi, kappa) for f in (F.sin, F.cos))
    if mode == "xyz":
        r = [[cp * ck, -cp * sk, sp], [co * sk + so * sp * ck, co * ck - so * sp * sk, -so * cp], [so * sk - co * sp * ck, so * ck + co * sp * sk, co * cp]]
    elif mode == "zyx":
        r = [[ck * cp, ck * sp * so - sk * co, ck * sp * co + sk * so], [sk * cp, sk * sp * so + ck * co, sk * sp * co - ck * so], [-sp, cp * so, cp * co]]
    else:
        raise ValueError(f"unknown rotation mode {mode!r}")
    return {f"r{i + 1}{j + 1}": r[i][j] for i in range(3) for j in range(3)}


def project(ring: Column, photo: Column, distortion: tuple[Column, Column, Column, Column] | None = None) -> Column:
    """Image positions (u, v) of a ring; null where a corner is in the camera's own plane.

    Points behind the camera project like others (Q7). distortion has the shift in x and y and the
    cubic and quintic radial terms. A missing sensor size gives null, so the point is not visible
    (Q15). Each step is a pass over the ring, so that no product is worked out twice.
    """
    away = F.transform(ring, lambda p: F.struct((p["x"] - photo["cx"]).alias("x"), (p["y"] - photo["cy"]).alias("y"), (p["z"] - photo["cz"]).alias("z")))
    turned = F.transform(away, lambda d: F.struct(*[(d["x"] * photo[f"r1{j}"] + d["y"] * photo[f"r2{j}"] + d["z"] * photo[f"r3{j}"]).alias(f"p{j}") for j in (1, 2, 3)]))
    flat = F.transform(turned, lambda p: F.struct(F.try_divide(p["p1"], p["p3"]).alias("x"), F.try_divide(p["p2"], p["p3"]).alias("y")))
    if distortion:
        far = F.transform(flat, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["x"] * p["x"] + p["y"] * p["y"]).alias("r2")))
        bent = F.transform(far, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["r2"].alias("r2"), (distortion[2] + distortion[3] * p["r2"]).alias("k")))
        flat = F.transform(bent, lambda p: F.struct((p["x"] - p["x"] * p["r2"] * p["k"] + distortion[0]).alias("x"), (p["y"] - p["y"] * p["r2"] * p["k"] + distortion[1]).alias("y")))

    def pixel(p):
        u = photo["w"] / lit(2) + F.try_divide((photo["ppx"] - p["x"] * photo["f"]) * photo["w"], photo["sensor_w"])
        v = photo["h"] - (photo["h"] / lit(2) + F.try_divide((photo["ppy"] - p["y"] * photo["f"]) * photo["h"], photo["sensor_h"]))
        return F.struct(u.alias("u"), v.alias("v"))

    return F.transform(flat, pixel)


def project_spread(pairs: DataFrame, corners: int, distortion: tuple[Column, Column, Column, Column] | None = None) -> DataFrame:
    """The ends of `project`, u_min, u_max, v_min, v_max, for rings in columns _x0, _y0, _z0, _x1, ..., with the photo's in _cx, ..., _r33.

    All are finite doubles, and focal length, image and sensor sizes above 0: u then falls with the
    position on the image plane and v rises, rounded or not, so only the ends there become pixels.
    Each step has columns of its own, so that it is worked out once. Methods of more than 8,000 bytes
    of code are never compiled, so corners must be few and columns without nulls until the ends.
    """
    c, each = F.col, range(corners)
    over = lambda x, y: F.coalesce(F.try_divide(x, y), lit(0))
    d = pairs.withColumns({f"_d{n}{i}": c(f"_{n}{i}") - c(f"_c{n}") for i in each for n in "xyz"})
    d = d.withColumns({f"_p{j}{i}": c(f"_dx{i}") * c(f"_r1{j}") + c(f"_dy{i}") * c(f"_r2{j}") + c(f"_dz{i}") * c(f"_r3{j}") for i in each for j in (1, 2, 3)})
    d = d.withColumns({f"_{a}{i}": over(c(f"_p{j}{i}"), c(f"_p3{i}")) for i in each for j, a in ((1, "a"), (2, "b"))})
    if distortion:
        d = d.withColumns({f"_q{i}": c(f"_a{i}") * c(f"_a{i}") + c(f"_b{i}") * c(f"_b{i}") for i in each})
        d = d.withColumns({f"_k{i}": distortion[2] + distortion[3] * c(f"_q{i}") for i in each})
        d = d.withColumns({f"_{a}{i}": c(f"_{a}{i}") - c(f"_{a}{i}") * c(f"_q{i}") * c(f"_k{i}") + distortion[n] for i in each for n, a in enumerate("ab")})
    d = d.withColumns({f"_{a}{i}": F.when(F.abs(c(f"_p3{i}")) > 0, c(f"_{a}{i}")) for i in each for a in "ab"})  # null in the camera's own plane
    d = d.withColumns({f"_{a}_{n}": f(*[f"_{a}{i}" for i in each]) for a in "ab" for n, f in (("min", F.least), ("max", F.greatest))})
    u = lambda a: c("_w") / lit(2) + F.try_divide((c("_ppx") - c(a) * c("_f")) * c("_w"), c("_sensor_w"))
    v = lambda b: c("_h") - (c("_h") / lit(2) + F.try_divide((c("_ppy") - c(b) * c("_f")) * c("_h"), c("_sensor_h")))
    return d.withColumns({"u_min": u("_a_max"), "u_max": u("_a_min"), "v_min": v("_b_min"), "v_max": v("_b_max")})


def rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    """Columns to so many digits, halves away from zero, by a product and a quotient of doubles as in DuckDB's round.

    Spark's own round goes through decimal text, which costs more than a projection. Steps are
    columns, so that each is worked out once. The product must not overflow.
    """
    d = df.withColumns({f"_y_{c}": F.col(c) * lit(10**digits) for c in columns})
    d = d.withColumns({f"_n_{c}": F.rint(f"_y_{c}") for c in columns})  # halves to even
    d = d.withColumns({f"_s_{c}": F.signum(f"_y_{c}") for c in columns})
    away = lambda c: F.when((F.col(f"_y_{c}") - F.col(f"_n_{c}")) * F.col(f"_s_{c}") >= lit(0.5), F.col(f"_s_{c}")).otherwise(lit(0))
    return d.withColumns({c: (F.col(f"_n_{c}") + away(c)) / lit(10**digits) for c in columns}).select(*df.columns)


def in_image(p: Column, w: Column, h: Column) -> Column:
    """half-open bounds; a null position is outside."""
    return F.coalesce((p["u"] >= 0) & (p["u"] < w) & (p["v"] >= 0) & (p["v"] < h), F.lit(False))


def next_power_of_two(n: Column) -> Column:
    """The least power of two that is not below n; 1 below 1."""
    below = F.greatest(F.ceil(n).cast("long") - 1, F.lit(0).cast("long"))  # as many binary digits as the power has zeros
    return F.when(below > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(below)))).otherwise(F.lit(1).cast("long"))


def acos_clipped(x: Column) -> Column:
    """C9."""
    return F.acos(F.greatest(F.least(x, lit(1)), lit(-1)))


def to_plane(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Df with `plane`, the ring turned so that its summed normal is +y, and `real`, whether it has a normal.

    Turned about z until the horizontal part of the normal meets +y, then about x. The angles are
    columns of their own, worked out once for each ring.
    """
    d = df.withColumn("_n", summed_normal(F.col(ring))).withColumn("_size", length(F.col("_n")))
    d = d.withColumn("_u", F.struct(*[F.try_divide(F.col(f"_n.{c}"), F.col("_size")).alias(c) for c in "xyz"]))
    d = d.withColumn("_flat", F.sqrt(F.col("_u.x") * F.col("_u.x") + F.col("_u.y") * F.col("_u.y")))
    theta = acos_clipped(F.when(F.col("_flat") > 0, F.col("_u.y") / F.nullif(F.col("_flat"), lit(0))).otherwise(lit(1)))
    d = d.withColumn("_theta", theta).withColumn("_theta", F.when(F.col("_u.x") < 0, -F.col("_theta")).otherwise(F.col("_theta")))
    d = d.withColumns({"_c": F.cos("_theta"), "_s": F.sin("_theta")})
    d = d.withColumn("_tilt", acos_clipped(F.col("_s") * F.col("_u.x") + F.col("_c") * F.col("_u.y")))
    d = d.withColumn("_tilt", F.when(F.col("_u.z") > 0, -F.col("_tilt")).otherwise(F.col("_tilt")))
    d = d.withColumns({"_cx": F.cos("_tilt"), "_sx": F.sin("_tilt")})
    c, s, cx, sx = (F.col(x) for x in ("_c", "_s", "_cx", "_sx"))
    level = F.transform(ring, lambda p: F.struct((c * p["x"] - s * p["y"]).alias("x"), (s * p["x"] + c * p["y"]).alias("y"), p["z"].alias("z")))
    plane = F.transform(level, lambda p: F.struct(p["x"].alias("x"), (cx * p["y"] - sx * p["z"]).alias("y"), (sx * p["y"] + cx * p["z"]).alias("z")))
    d = d.withColumns({"plane": plane, "real": F.col("_size") >= 1e-12})
    return d.drop("_n", "_size", "_u", "_flat", "_theta", "_c", "_s", "_tilt", "_cx", "_sx")


def field(ring: str, name: str) -> Column:
    """One field of all corners of a ring."""
    return F.transform(ring, lambda p: p[name])


def affine(src: list[tuple[Column, Column]], dst: list[tuple[Column, Column]]) -> list[Column]:
    """(a, b, c, d, e, f) with x' = a x + b y + c and y' = d x + e y + f, exact for three points; null if they are on a line."""
    (x1, y1), (x2, y2), (x3, y3) = src
    det = x1 * (y2 - y3) - y1 * (x2 - x3) + (x2 * y3 - x3 * y2)
    out = []
    for k in (0, 1):
        p, q, r = (d[k] for d in dst)
        out += [F.try_divide(p * (y2 - y3) + q * (y3 - y1) + r * (y1 - y2), det), F.try_divide(p * (x3 - x2) + q * (x1 - x3) + r * (x2 - x1), det),
                F.try_divide(p * (x2 * y3 - x3 * y2) + q * (x3 * y1 - x1 * y3) + r * (x1 * y2 - x2 * y1), det)]
    return out
