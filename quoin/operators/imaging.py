"""Faces in photographs and orthorectified images: projection, visibility, the choice of an image."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.geometry import lit
from . import faces as _faces
from . import tiles
from .scale import broadcast_checked

FACE = ["bldg_id", "face_no"]
_PHOTO = ["cx", "cy", "cz", "w", "h", "sensor_w", "sensor_h", "f", "ppx", "ppy"]
_FIELDS = [*_PHOTO, *[f"r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3)]]
ORTHO_WEIGHT = 2.0
#: A footprint of this many units or more counts as one without bounds; a position, as one that is not plain.
_WIDEST = 1e12
#: Most corners of a ring whose image is worked out corner by corner in generated code.
MOST_CORNERS = 4
#: Pairs of a face and a photo that a task is to take, about.
TASK_PAIRS = 4_000_000
#: Rows of a tile's faces in all photos, about: generated code holds all that come of one tile at once.
TILE_ROWS = 200_000
#: Least and most faces that a tile is to have, about.
TILE_FACES = (6, 600)
#: Most images of a mosaic whose boxes are looked up in one row.
MOST_MEMBERS = 2_000


def oriented(photo: DataFrame, mode: str = "xyz") -> DataFrame:
    """G1: photos with their nine rotation entries, computed once for each photo."""
    return photo.withColumns(g.rotation(F.col("omega_deg"), F.col("phi_deg"), F.col("kappa_deg"), mode))


def in_photos(faces: DataFrame, photo: DataFrame, distortion: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Every ring in every photo, with n_in, the corners inside (A2).

    The photos are broadcast if they are few enough to be checked so; the faces stay where they are.
    """
    shift = tuple(lit(x) for x in distortion) if distortion else None
    return _projected(faces.crossJoin(broadcast_checked(_packed(photo))), faces.columns, shift)


def _packed(photo: DataFrame) -> DataFrame:
    return oriented(photo).select("photo_id", F.struct(*_FIELDS).alias("photo"))


def _projected(pairs: DataFrame, columns: list[str], shift: tuple | None = None, where=None) -> DataFrame:
    image = g.project(F.col("ring"), F.col("photo"), shift)
    seen = pairs.withColumn("image", image if where is None else F.when(where, image))
    inside = F.size(F.filter("image", lambda q: g.in_image(q, F.col("photo.w"), F.col("photo.h"))))
    return seen.select(*columns, "photo_id", "image", inside.alias("n_in"), F.col("photo.w").alias("img_w"), F.col("photo.h").alias("img_h"))


def ends(faces: DataFrame, photo: DataFrame, distortion: tuple[float, float, float, float] | None = None) -> DataFrame:
    """For every ring in every photo the least and greatest u and v of its image, null where it has none.

    What `in_photos` gives, without an array for each pair. A row is due for each pair, so what a pair
    costs in time and in the bytes of its row is what counts: the rings are dealt to tasks by the number
    of their pairs, as their bytes say little of the work, and those of up to MOST_CORNERS corners are
    spread into columns, where the steps of `geometry.project` become generated code. Missing corners
    are the first one again, which changes no end. Longer rings, and rings and photos with
    nulls, numbers of _WIDEST or more or sizes not above 0, go the way of `in_photos`.

    Rows come by tile, photo and face number. The faces of a building share corners, and those of
    one number mostly share their outermost corners with those of another, so files then repeat
    themselves at short distance and take a third less.
    """
    columns = [c for c in faces.columns if c != "ring"]
    shot = _packed(photo)
    usual = lambda x: F.coalesce(F.abs(x) < lit(_WIDEST), F.lit(False))  # noqa: E731 - not so for null and NaN
    whole = F.forall(F.array(*[usual(F.col(f"photo.{c}")) for c in _FIELDS]), lambda x: x) & F.forall(F.array(*[F.coalesce(F.col(f"photo.{c}") > 0, F.lit(False)) for c in ("w", "h", "sensor_w", "sensor_h", "f")]), lambda x: x)
    plain = F.coalesce(F.size("ring").between(1, MOST_CORNERS) & F.forall("ring", lambda q: usual(q["x"]) & usual(q["y"]) & usual(q["z"])), F.lit(False))
    counted = lambda df, fit: df.agg(F.count_if(fit), F.count_if(~fit)).first()
    (n_plain, n_other), (n_whole, n_broken) = counted(faces, plain), counted(shot, whole)
    tasks = max(-(-(n_plain + n_other) * (n_whole + n_broken) // TASK_PAIRS), 1)
    sure = lambda x: F.coalesce(x.cast("double"), lit(0))  # noqa: E731 - there are no nulls, and so the generated code needs no checks
    at = lambda i: F.coalesce(F.get("ring", F.lit(i)), F.get("ring", F.lit(0)))
    first = [*FACE[::-1], *[c for c in columns if c not in FACE]]  # the order of a tile's faces
    spread = faces.where(plain).select(*first, *[sure(at(i)[n]).alias(f"_{n}{i}") for i in range(MOST_CORNERS) for n in "xyz"])
    least, most = TILE_FACES
    tiled = _tiles(spread, tasks, n_plain, min(max(TILE_ROWS // max(n_whole, 1), least), most))
    flat = shot.where(whole).select("photo_id", *[sure(F.col(f"photo.{c}")).alias(f"_{c}") for c in _FIELDS])
    shift = tuple(lit(x) for x in distortion) if distortion else None
    pairs = tiled.crossJoin(broadcast_checked(flat)).select(F.inline("tile"), *flat.columns)
    found = g.project_spread(pairs, MOST_CORNERS, shift).select(*columns, "photo_id", "u_min", "u_max", "v_min", "v_max")
    dealt = faces.repartition(tasks, *columns)
    for rings, shots in ((dealt.where(~plain), shot if n_other else None), (dealt.where(plain), shot.where(~whole) if n_plain and n_broken else None)):
        if shots is not None:
            rest = _projected(rings.crossJoin(broadcast_checked(shots)), faces.columns, shift)
            found = found.unionByName(rest.select(*columns, "photo_id", *[f(g.field("image", c)).alias(f"{c}_{n}") for c in "uv" for n, f in (("min", F.array_min), ("max", F.array_max))]))
    return found


def _tiles(faces: DataFrame, tasks: int, count: int, each: int) -> DataFrame:
    """`count` faces in sorted arrays of about `each`, dealt evenly to partitions, as many as tasks, in one shuffle.

    A building's faces fall into the same tile, but for those whose numbers are `each` apart or more, so none fills a tile alone.
    """
    n = F.pmod(F.xxhash64(FACE[0], F.floor(F.col(FACE[1]) / each)), F.lit(tasks * max(-(-count // (tasks * each)), 1)))
    dealt = faces.select((n % tasks).cast("int").alias("_task"), n.alias("_tile"), F.struct(*faces.columns).alias("_face")).repartitionById(tasks, "_task")
    return dealt.groupBy("_task", "_tile").agg(F.sort_array(F.collect_list("_face")).alias("tile")).select("tile")


def _footprints(photo: DataFrame, low: float, high: float) -> DataFrame:
    """Photos with the box of all that each shows between two heights; NaN where the rays of its corners point both up and down."""
    @F.pandas_udf("x1 double, x2 double, y1 double, y2 double")
    def box(p: pd.DataFrame) -> pd.DataFrame:
        v = {c: p[c].to_numpy(dtype=float, na_value=np.nan) for c in p.columns}
        with np.errstate(all="ignore"):
            a = (v["ppx"] - np.array([[-0.5], [0.5], [-0.5], [0.5]]) * v["sensor_w"]) / v["f"]
            b = (v["ppy"] - np.array([[-0.5], [-0.5], [0.5], [0.5]]) * v["sensor_h"]) / v["f"]
            dx, dy, dz = (v[f"r{i}1"] * a + v[f"r{i}2"] * b + v[f"r{i}3"] for i in (1, 2, 3))
            one_way = (dz > 0).all(axis=0) | (dz < 0).all(axis=0)
            t = np.concatenate([(z - v["cz"]) / dz for z in (low, high)])
            x, y = v["cx"] + t * np.tile(dx, (2, 1)), v["cy"] + t * np.tile(dy, (2, 1))
        return pd.DataFrame({f"{n}{k}": np.where(one_way, f(w, axis=0), np.nan) for n, w in (("x", x), ("y", y)) for k, f in ((1, np.min), (2, np.max))})

    return photo.withColumn("box", box("photo"))


def in_view(faces: DataFrame, photo: DataFrame) -> DataFrame:
    """J1, G2 for rings that a photo may show whole: what `in_photos` gives, without pairs that can't be so.

    A photo's footprint is a box on the ground, from the rays of its corners down to the least and
    the greatest height of the faces. Footprints are put on a grid, each face in the cell of its
    first corner, and they meet by an equi-join on cells. A photo whose footprint has no bounds, or
    is very much wider than the others, is tried on every face.
    """
    z = faces.agg(F.min(F.array_min(g.field("ring", "z"))).alias("low"), F.max(F.array_max(g.field("ring", "z"))).alias("high")).first()
    low, high = (float("nan") if v is None else v for v in z)
    p = _footprints(_packed(photo), low, high).withColumn("side", F.greatest(F.col("box.x2") - F.col("box.x1"), F.col("box.y2") - F.col("box.y1")))
    bounded = F.col("side") < lit(_WIDEST)  # not so for NaN, which Spark holds to be the greatest
    cell = max(p.where(bounded).agg(F.percentile_approx("side", 0.5).alias("cell")).first()["cell"] or 0.0, 1e-3) / 2
    fits = F.coalesce(bounded & (F.col("side") <= lit(100 * cell)), F.lit(False))
    pad = F.col("side") * lit(1e-6) + lit(1e-3)
    near = p.where(fits).select("photo_id", "photo", *[(F.col(f"box.{n}{k}") + (pad if k == 2 else -pad)).alias(f"_{n}{k}") for n in "xy" for k in (1, 2)])
    for n in "xy":
        near = near.withColumn(f"_g{n}", F.explode(F.sequence(F.floor(F.col(f"_{n}1") / lit(cell)), F.floor(F.col(f"_{n}2") / lit(cell)))))
    first = F.get("ring", F.lit(0))
    put = faces.withColumns({f"_g{n}": F.floor(first[n] / lit(cell)) for n in "xy"})
    within = F.forall("ring", lambda q: q["x"].between(F.col("_x1"), F.col("_x2")) & q["y"].between(F.col("_y1"), F.col("_y2")))
    # asked twice: a later filter on the image moves into the join, where it must not project pairs that are not within
    seen = _projected(put.join(near, ["_gx", "_gy"]).where(within), faces.columns, where=within)
    wide = p.where(~fits).select("photo_id", "photo")
    if wide.head(1):
        seen = seen.unionByName(_projected(faces.crossJoin(broadcast_checked(wide)), faces.columns))
    return seen


def mosaic(ortho: DataFrame) -> DataFrame:
    """A10, Q16: bounding box, the first image's pixel size, and the size in pixels, rounded half to even."""
    m = ortho.agg(F.min("l").alias("l"), F.min("b").alias("b"), F.max("r").alias("r"), F.max("t").alias("t"), F.min(F.struct("ortho_id", "px_x", "px_y")).alias("p"))
    return m.select("l", "b", "r", "t", "p.px_x", "p.px_y").withColumns({"mw": F.rint((F.col("r") - F.col("l")) / F.col("px_x")).cast("int"), "mh": F.rint((F.col("t") - F.col("b")) / F.col("px_y")).cast("int")})


def in_mosaic(faces: DataFrame, ortho: DataFrame) -> DataFrame:
    """Every ring in the mosaic, with n_in, the corners inside it and inside some member.

    The member test looks up the members' boxes in one row, if they are no more than MOST_MEMBERS;
    those of a larger mosaic are joined on a grid.
    """
    few = len(ortho.select(F.lit(1)).head(MOST_MEMBERS + 1)) <= MOST_MEMBERS
    if few:
        member = F.transform("ring", lambda q: F.exists("boxes", lambda o: q["x"].between(o["l"], o["r"]) & q["y"].between(o["b"], o["t"])))
        m = F.broadcast(mosaic(ortho).crossJoin(ortho.agg(F.collect_list(F.struct("l", "b", "r", "t")).alias("boxes"))))
        rings = faces
    else:
        boxes = ortho.select(F.col("l").alias("x1"), F.col("b").alias("y1"), F.col("r").alias("x2"), F.col("t").alias("y2"))
        side = ortho.agg(F.percentile_approx(F.greatest(F.col("r") - F.col("l"), F.col("t") - F.col("b")), 0.5)).first()[0]
        points = faces.select(*FACE, F.posexplode("ring").alias("seq", "p")).select(*FACE, "seq", "p.x", "p.y")
        found = tiles.covered(points, [*FACE, "seq"], boxes, max(float(side), 1e-3)).groupBy(*FACE).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "covered"))), lambda s: s["covered"]).alias("_members"))
        member, m, rings = F.col("_members"), F.broadcast(mosaic(ortho)), faces.join(found, FACE)
    seen = rings.crossJoin(m).withColumn("image", F.transform("ring", lambda q: F.struct(((q["x"] - F.col("l")) / F.col("px_x")).alias("u"), ((F.col("t") - q["y"]) / F.col("px_y")).alias("v"))))
    inside = F.size(F.filter("image", lambda q, i: g.in_image(q, F.col("mw"), F.col("mh")) & F.get(member, i)))
    return seen.select(*faces.columns, "image", inside.alias("n_in"), F.col("mw").alias("img_w"), F.col("mh").alias("img_h"))


def visible(seen: DataFrame) -> DataFrame:
    """Rings with all corners inside, and their area in the image."""
    return seen.where(F.col("n_in") == F.size("image")).withColumn("area", g.plane_area(F.col("image")))


def candidates(photos: DataFrame, orthos: DataFrame | None = None) -> DataFrame:
    """Photo and mosaic candidates of each face in the order in which they are looked at: the mosaic first."""
    p = photos.withColumns({"is_ortho": F.lit(False), "weighted": F.col("area"), "src_order": F.col("photo_id")})
    if orthos is None:
        return p
    o = orthos.withColumns({"is_ortho": F.lit(True), "weighted": F.col("area") * lit(ORTHO_WEIGHT), "src_order": F.lit(-1).cast("long"), "photo_id": F.lit(None).cast("long")})
    return o.unionByName(p)


def best(found: DataFrame) -> DataFrame:
    """A3, Q1, O2: the candidate of greatest weighted area for each face; of equals the last looked at.

    The maximum of a struct, so candidates are reduced before the shuffle and no group is sorted.
    """
    rank = F.struct("weighted", "src_order", "photo_id", "is_ortho", "area", "image", "img_w", "img_h")
    return found.groupBy(*FACE).agg(F.max(rank).alias("b")).select(*FACE, "b.photo_id", "b.is_ortho", "b.area", "b.image", "b.img_w", "b.img_h")


def wall_images(classed: DataFrame, adjacent: DataFrame, photo: DataFrame, ortho: DataFrame) -> DataFrame:
    """The image of each wall: of the photos that show it unhidden and, for walls that are nearly level, the mosaic.

    The mosaic is looked at first, so a photo of the same weighted area takes its place; a mosaic
    that shows no area at all does not count.
    """
    photos = wall_candidates(classed, adjacent, photo).where(~F.col("hidden"))
    level = _faces.level_faces(classed.where("element = 'Wall'")).where("is_level")
    mosaics = visible(in_mosaic(level, ortho)).where("area > 0")
    columns = [*FACE, "photo_id", "area", "image", "img_w", "img_h"]
    return best(candidates(photos.select(columns), mosaics.withColumn("photo_id", F.lit(None).cast("long")).select(columns)))


def boxes(chosen: DataFrame, margin: int = 2) -> DataFrame:
    """The pixel box of each image ring, with a margin where the box then stays inside the image."""
    low = lambda c: F.floor(F.array_min(g.field("image", c))).cast("int")
    high = lambda c: F.ceil(F.array_max(g.field("image", c))).cast("int")
    b = chosen.withColumns({"x0": low("u"), "y0": low("v"), "x1": high("u"), "y1": high("v")})
    fits = (F.col("x0") >= margin) & (F.col("y0") >= margin) & (F.col("x1") + margin < F.col("img_w")) & (F.col("y1") + margin < F.col("img_h"))
    b = b.withColumn("margin", F.when(fits, margin).otherwise(0))
    return b.withColumns({"min_x": F.col("x0") - F.col("margin"), "min_y": F.col("y0") - F.col("margin"), "box_w": F.col("x1") - F.col("x0") + 1 + 2 * F.col("margin"), "box_h": F.col("y1") - F.col("y0") + 1 + 2 * F.col("margin")}).drop("x0", "y0", "x1", "y1")


def hidden(wall: F.Column, common: F.Column, image: F.Column, roof: F.Column, roof_image: F.Column) -> F.Column:
    """Whether a wall is hidden behind its own roof in one image.

    Around the wall, each step between a corner of the roof and one that is not gives a base point
    (the latter) and a roof corner (the former, found in the roof by its identity). The wall is hidden
    if a base point lies inside the roof's image, or the line from it to the roof corner touches a
    roof edge that does not end there (Q4: a proper crossing does not count).
    """
    of_roof = lambda p: F.exists(common, lambda q: (p["x"] == q["x"]) & (p["y"] == q["y"]) & (p["z"] == q["z"]))
    n, m = F.size(wall), F.size(roof)

    def step(i):
        j = F.pmod(i + 1, n)
        a, b = of_roof(F.get(wall, i)), of_roof(F.get(wall, j))
        top, base = F.when(a, i).otherwise(j), F.when(a, j).otherwise(i)
        corner = F.get(wall, top)
        where = F.get(F.filter(F.sequence(F.lit(0), m - 1), lambda k: (F.get(roof, k)["x"] == corner["x"]) & (F.get(roof, k)["y"] == corner["y"]) & (F.get(roof, k)["z"] == corner["z"])), F.lit(0))
        return F.when(a != b, F.struct(F.get(image, base).alias("base"), where.alias("at")))

    steps = F.filter(F.transform(F.sequence(F.lit(0), n - 1), step), lambda s: s.isNotNull() & s["at"].isNotNull())
    edge = lambda s, k: (k != s["at"]) & (F.pmod(k + 1, m) != s["at"]) & g.touches(s["base"], F.get(roof_image, s["at"]), F.get(roof_image, k), F.get(roof_image, F.pmod(k + 1, m)), "u", "v")
    return F.exists(steps, lambda s: g.inside(roof_image, s["base"]["u"], s["base"]["v"], "u", "v") | F.exists(F.sequence(F.lit(0), m - 1), lambda k: edge(s, k)))


def wall_candidates(classed: DataFrame, adjacent: DataFrame, photo: DataFrame) -> DataFrame:
    """Walls in the photos that show all of the wall and of its roof and do not hide it."""
    seen = in_view(classed, photo)
    walls = visible(seen.where("element = 'Wall'")).withColumnRenamed("face_no", "wall_no")
    roofs = seen.where((F.col("element") == "Roof") & (F.col("n_in") == F.size("image"))).select("bldg_id", F.col("face_no").alias("roof_no"), "photo_id", F.col("ring").alias("roof"), F.col("image").alias("roof_image"))
    both = walls.join(adjacent, ["bldg_id", "wall_no"]).join(roofs, ["bldg_id", "roof_no", "photo_id"])
    none = F.array().cast("array<struct<x:double,y:double,z:double>>")
    return both.withColumn("hidden", hidden(F.col("ring"), F.coalesce("common", none), F.col("image"), F.col("roof"), F.col("roof_image"))).withColumnRenamed("wall_no", "face_no")
