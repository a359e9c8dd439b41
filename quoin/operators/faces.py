"""Faces of buildings: rings, normals, classes, clean-up of vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.geometry import lit

FACE = ["bldg_id", "face_no"]


def rings(corner: DataFrame) -> DataFrame:
    """(bldg_id, face_no, ring) from (bldg_id, face_no, seq, x, y, z): one shuffle by building.

    Dealt by building alone, so what follows by building or face needs no further shuffle.
    """
    return corner.repartition("bldg_id").groupBy(*FACE).agg(g.pack("seq", "x", "y", "z").alias("ring"))


def unpack(faces: DataFrame) -> DataFrame:
    """The corners of rings, one row each, numbered from 0."""
    return faces.select(*FACE, F.posexplode("ring").alias("seq", "p")).select(*FACE, "seq", "p.x", "p.y", "p.z")


def normals(faces: DataFrame) -> DataFrame:
    """Summed normal (sx, sy, sz) and first unit normal (nx, ny, nz; null if degenerate)."""
    s, n = g.summed_normal(F.col("ring")), g.first_normal(F.col("ring"))
    both = faces.select(*FACE, s.alias("s"), n.alias("n"))
    return both.select(*FACE, F.col("s.x").alias("sx"), F.col("s.y").alias("sy"), F.col("s.z").alias("sz"), F.col("n.x").alias("nx"), F.col("n.y").alias("ny"), F.col("n.z").alias("nz"))


def classify(faces: DataFrame) -> DataFrame:
    """Ground is level and at the building's least height, Wall is upright, Roof is the rest.

    Faces with fewer than three corners or without a normal are dropped (F10).
    """
    low = F.array_min(F.transform("ring", lambda p: p["z"]))
    n = g.first_normal(F.col("ring"))["z"]
    f = faces.where(F.size("ring") >= 3).withColumn("low", low).withColumn("nz", n)
    f = f.withColumn("ground", F.min("low").over(W.partitionBy("bldg_id"))).where("nz is not null")
    level, upright = F.abs("nz") > F.cos(F.radians(lit(1))), F.abs("nz") < F.sin(F.radians(lit(1)))
    kind = F.when(level & (F.col("low") - F.col("ground") < 1e-7), "Ground").when(upright, "Wall").otherwise("Roof")
    return f.select(*FACE, kind.alias("element"), "ring")


def split_roofs(faces: DataFrame, threshold: float = 0.02) -> DataFrame:
    """is_roof where the unit summed normal's |z| is above the threshold, or there is no normal."""
    n = faces.withColumn("_n", g.summed_normal(F.col("ring"))).withColumn("_z", F.abs(F.try_divide(F.col("_n.z"), g.length(F.col("_n")))))
    return n.withColumn("is_roof", F.col("_z").isNull() | (F.col("_z") > threshold)).drop("_n", "_z")


def level_faces(faces: DataFrame) -> DataFrame:
    """is_level where the normal of the first three corners is within reach of upright."""
    a, b, c = (F.get("ring", F.lit(i)) for i in range(3))
    v = g.cross(g.minus(b, a), g.minus(c, a))
    n = g.norm(v)
    return faces.withColumn("is_level", F.coalesce((n > 1e-6) & (F.abs(F.try_divide(v[2], n)) > 0.9), F.lit(False)))


def clean_rings(faces: DataFrame) -> DataFrame:
    """Drops corners equal to the one before, then a last corner equal to the first; rings under three corners go."""
    r = F.col("ring")
    kept = F.filter(r, lambda p, i: (i == 0) | ~F.get(r, i - 1).eqNullSafe(p))
    f = faces.withColumn("_kept", kept)
    n = F.size("_kept")
    closed = (n > 1) & F.get("_kept", n - 1).eqNullSafe(F.get("_kept", F.lit(0)))
    return f.withColumn("ring", F.when(closed, F.slice("_kept", 1, n - 1)).otherwise(F.col("_kept"))).drop("_kept").where(F.size("ring") >= 3)


def zip_lists(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row for each place of a row's lists, which stand for each other by their place; a shorter list is null there."""
    return df.select(key, F.posexplode(F.arrays_zip(*columns)).alias("place", "z")).select(key, "place", "z.*")


def dedup_vertices(corner: DataFrame, precision: int | None = None) -> DataFrame:
    """Corners with v_idx, the building's number (from 1) of their exact point by first appearance."""
    c = corner if precision is None else corner.withColumns({a: F.bround(a, precision) for a in "xyz"})
    points = c.groupBy("bldg_id", "x", "y", "z").agg(F.min(F.struct("face_no", "seq")).alias("first"))
    points = points.withColumn("v_idx", F.row_number().over(W.partitionBy("bldg_id").orderBy("first"))).drop("first")
    return c.join(points, ["bldg_id", "x", "y", "z"])


def adjacency(classed: DataFrame, mode: str = "point") -> DataFrame:
    """The roof that each wall stands under: two roof corners or more "in" the wall, the highest first match, later roofs win ties.

    mode "point" asks for a whole corner of the wall; "coordinate" for any one coordinate equal to
    the same one of some corner. Walls without such a roof get the building's first roof and
    n_common 0 (Q6); buildings without a roof give no rows (Q5).
    """
    wall = classed.where("element = 'Wall'").select("bldg_id", F.col("face_no").alias("wall_no"), F.col("ring").alias("wall"))
    roof = classed.where("element = 'Roof'").select("bldg_id", F.col("face_no").alias("roof_no"), F.col("ring").alias("roof"))
    same = (lambda p, q: (p["x"] == q["x"]) & (p["y"] == q["y"]) & (p["z"] == q["z"])) if mode == "point" else (lambda p, q: (p["x"] == q["x"]) | (p["y"] == q["y"]) | (p["z"] == q["z"]))
    common = F.filter("roof", lambda p: F.exists("wall", lambda q: same(p, q)))
    pairs = wall.join(roof, "bldg_id").withColumn("common", common)
    hit = F.size("common") >= 2
    best = F.when(hit, F.struct(F.get("common", F.lit(0))["z"].alias("z"), F.col("roof_no").alias("roof_no"), F.col("common").alias("common")))
    return pairs.groupBy("bldg_id", "wall_no").agg(F.max(best).alias("best"), F.min("roof_no").alias("first")).select(
        "bldg_id", "wall_no", F.coalesce(F.col("best.roof_no"), F.col("first")).alias("roof_no"), F.coalesce(F.size("best.common"), F.lit(0)).alias("n_common"), F.col("best.common").alias("common"))
