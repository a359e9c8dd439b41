"""Frontal views of faces: the plane ring, the mirror flag, the pixel polygon, crop windows, letterboxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.geometry import lit

FACE = ["bldg_id", "face_no"]


def rectified(tex: DataFrame, ppm: float = 1 / 0.16, margin: int = 4) -> DataFrame:
    """Each textured face's ring in its own plane, in pixels.

    mirrored: any edge whose source x and plane x differ in sign (G10); dst: the pixel polygon with two
    margins added (G11); win_w, win_h: the size of the warped image; crop: its window (G12). Faces
    without a normal get a one-pixel placeholder: no polygon, and a window of one.
    """
    p = tex.groupBy(*FACE).agg(g.pack("seq", "x", "y", "z", "su", "sv").alias("ring"))
    p = g.to_plane(p)
    face = W.partitionBy(*FACE)
    e = p.select(*FACE, "real", F.posexplode(F.arrays_zip("plane", "ring")).alias("seq", "q")).select(*FACE, "real", "seq", "q.plane.x", "q.plane.z", "q.ring.su")
    step = lambda c: F.col(c) - F.coalesce(F.lead(c).over(face.orderBy("seq")), F.first_value(c).over(face.orderBy("seq")))
    e = e.withColumn("mirrored", step("su") * step("x") < 0).withColumn("mirrored", F.bool_or("mirrored").over(face))
    e = e.withColumns({c: F.col(c) - F.min(c).over(face) for c in "xz"})
    turn = lambda c: (F.when(F.col("mirrored"), F.max(c).over(face) - F.col(c)).otherwise(F.col(c)) * lit(ppm) + lit(2 * margin))
    e = e.withColumns({"dx": turn("x"), "dy": turn("z")})
    d = e.groupBy(*FACE).agg(F.first("real").alias("real"), F.first("mirrored").alias("mirrored"), g.pack("seq", "dx", "dy").alias("dst"), *[f(c).alias(f"{n}_{c}") for c in ("dx", "dy") for n, f in (("min", F.min), ("max", F.max))])
    d = d.withColumns({"win_w": F.floor(F.col("max_dx") + lit(margin)).cast("int"), "win_h": F.floor(F.col("max_dy") + lit(margin)).cast("int")})
    d = d.withColumns({
        "crop_x0": F.greatest(F.floor("min_dx").cast("int") - margin, F.lit(0)), "crop_y0": F.greatest(F.floor("min_dy").cast("int") - margin, F.lit(0)),
        "crop_x1": F.least(F.ceil("max_dx").cast("int") + margin, F.col("win_w")), "crop_y1": F.least(F.ceil("max_dy").cast("int") + margin, F.col("win_h"))})
    sizes = (("win_w", 1), ("win_h", 1), ("crop_x0", 0), ("crop_y0", 0), ("crop_x1", 1), ("crop_y1", 1))
    return d.select(*FACE, "real", F.when(F.col("real"), F.col("mirrored")).alias("mirrored"), F.when(F.col("real"), F.col("dst")).alias("dst"), *[F.when(F.col("real"), F.col(c)).otherwise(F.lit(n)).alias(c) for c, n in sizes])


def letterbox(rect: DataFrame, size: int = 256, overlap: float = 0.1, low: int = 16, high: int = 256, w: str = "rw", h: str = "rh") -> DataFrame:
    """The letterboxed size of an image, whether it passes the gate, and its tiles.

    The longer side becomes `size`, the other is rounded half to even. n_h, n_w: tiles of `size` with
    an overlap; rest_h, rest_w: black pixels behind the last. back_w, back_h: what is cut out again.
    """
    space = size - round(overlap * size)
    tall = F.col(h) > F.col(w)
    box_w = F.when(tall, F.rint(F.col(w) * (lit(size) / F.col(h)))).otherwise(lit(size)).cast("int")
    box_h = F.when(tall, lit(size)).otherwise(F.rint(F.col(h) * (lit(size) / F.col(w)))).cast("int")
    n = lambda c: (1 + F.greatest(F.lit(0), F.ceil((F.col(c) - size) / lit(space)))).cast("int")
    rest = lambda c, k: F.greatest(F.lit(0), -(F.col(c) - size - (k - 1) * space)).cast("int")
    return rect.withColumns({"box_w": box_w, "box_h": box_h, "gate": F.col(w).between(low, high) & F.col(h).between(low, high), "n_w": n(w), "n_h": n(h), "rest_w": rest(w, n(w)), "rest_h": rest(h, n(h))})


def uv_box(uv: DataFrame, w: int, h: int) -> DataFrame:
    """Where a wall's UV ring begins and ends in an atlas of w x h, rows counted from the top."""
    e = lambda f, c: f(g.field("uv", c))
    return uv.withColumns({"start_x": F.floor(e(F.array_min, "u") * w).cast("int"), "start_y": F.floor((1 - e(F.array_max, "v")) * h).cast("int"), "end_x": F.ceil(e(F.array_max, "u") * w).cast("int"), "end_y": F.ceil((1 - e(F.array_min, "v")) * h).cast("int")})
