"""Texture atlases: ordered folds over each building's rectangles, one building a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import next_power_of_two

_L = "cast({} as bigint)"


def registered(chosen: DataFrame) -> DataFrame:
    """The order in which a building's faces enter the atlas: by the first use of their image, roofs before walls, then by face."""
    use = F.struct(F.when(F.col("element") == "Roof", 0).otherwise(1).alias("kind"), F.col("face_no").alias("face_no"))
    first = F.min(use).over(W.partitionBy("bldg_id", "photo_id", "is_ortho"))
    return chosen.withColumn("order_no", F.row_number().over(W.partitionBy("bldg_id").orderBy(first, use)))


def _sizes(rect: DataFrame, order: str, w: str, h: str) -> DataFrame:
    item = F.struct(F.col(order).alias("o"), F.col(w).cast("long").alias("w"), F.col(h).cast("long").alias("h"))
    return rect.groupBy("bldg_id").agg(F.array_sort(F.collect_list(item)).alias("items"))


def shelf_pack(rect: DataFrame, max_width: int = 4096, order: str = "face_no", w: str = "rw", h: str = "rh") -> DataFrame:
    """Rectangles on shelves; a new shelf begins where max_width would be passed, then placing wraps at the atlas width.

    Two passes, as sizes are known only after the first: the first finds the atlas (powers of two that
    hold the longest shelf and all shelves), the second places within its width. Returns
    (bldg_id, order, off_x, off_y, atlas_w, atlas_h).
    """
    packed = _sizes(rect, order, w, h)
    first = f"""aggregate(items, struct({_L.format(0)} as x, {_L.format(0)} as y, {_L.format(0)} as high, {_L.format(0)} as wide), (a, r) -> struct(
        if({max_width} < a.x + r.w, r.w, a.x + r.w) as x, if({max_width} < a.x + r.w, a.y + a.high, a.y) as y,
        if({max_width} < a.x + r.w, r.h, greatest(a.high, r.h)) as high, greatest(a.wide, if({max_width} < a.x + r.w, r.w, a.x + r.w)) as wide))"""
    sized = packed.withColumn("f", F.expr(first)).withColumn("atlas_w", next_power_of_two(F.col("f.wide"))).withColumn("atlas_h", next_power_of_two(F.col("f.y") + F.col("f.high")))
    second = f"""aggregate(items, struct({_L.format(0)} as x, {_L.format(0)} as y, {_L.format(0)} as high, cast(array() as array<struct<o:int,x:bigint,y:bigint>>) as out), (a, r) -> struct(
        if(atlas_w < a.x + r.w, r.w, a.x + r.w) as x, if(atlas_w < a.x + r.w, a.y + a.high, a.y) as y, if(atlas_w < a.x + r.w, r.h, greatest(a.high, r.h)) as high,
        concat(a.out, array(named_struct('o', cast(r.o as int), 'x', if(atlas_w < a.x + r.w, {_L.format(0)}, a.x), 'y', if(atlas_w < a.x + r.w, a.y + a.high, a.y)))) as out)).out"""
    return sized.select("bldg_id", "atlas_w", "atlas_h", F.explode(F.expr(second)).alias("p")).select("bldg_id", F.col("p.o").alias(order), F.col("p.x").alias("off_x"), F.col("p.y").alias("off_y"), "atlas_w", "atlas_h")


_ROWS = """aggregate(items, struct(transform(sequence(1, n_row), i -> cast(0 as bigint)) as ws, transform(sequence(1, n_row), i -> cast(0 as bigint)) as hs, cast(array() as array<struct<o:int,row:int,x:bigint>>) as out), (a, r) -> struct(
    transform(a.ws, (v, i) -> if(i = array_position(a.ws, array_min(a.ws)) - 1, v + r.w, v)) as ws,
    transform(a.hs, (v, i) -> if(i = array_position(a.ws, array_min(a.ws)) - 1, greatest(v, r.h), v)) as hs,
    concat(a.out, array(named_struct('o', cast(r.o as int), 'row', cast(array_position(a.ws, array_min(a.ws)) - 1 as int), 'x', array_min(a.ws)))) as out))"""


def row_layouts(rect: DataFrame, order: str = "face_no", w: str = "rw", h: str = "rh") -> DataFrame:
    """For every number of rows from 1 to that of the rectangles, each put into the narrowest row so far (the first of equals)."""
    tried = _sizes(rect, order, w, h).withColumn("n_row", F.explode(F.sequence(F.lit(1), F.size("items")))).withColumn("s", F.expr(_ROWS))
    return tried.select("bldg_id", "n_row", next_power_of_two(F.array_max("s.ws")).alias("width"), next_power_of_two(F.aggregate("s.hs", F.lit(0).cast("long"), lambda a, x: a + x)).alias("height"), "s")


def row_pack(rect: DataFrame, order: str = "face_no", w: str = "rw", h: str = "rh") -> DataFrame:
    """The layout of least area, then of least width + height, then of fewest rows, with every rectangle's place."""
    rank = F.struct((F.col("width") * F.col("height")).alias("a"), (F.col("width") + F.col("height")).alias("p"), "n_row", "width", "height", "s")
    found = row_layouts(rect, order, w, h).groupBy("bldg_id").agg(F.min(rank).alias("b"))
    e = found.select("bldg_id", "b.n_row", "b.width", "b.height", F.col("b.s.hs").alias("hs"), F.explode("b.s.out").alias("p"))
    y = F.aggregate(F.slice("hs", F.lit(1), F.col("p.row")), F.lit(0).cast("long"), lambda a, x: a + x)
    return e.select("bldg_id", "n_row", "width", "height", F.col("p.o").alias(order), F.col("p.x").alias("off_x"), y.alias("off_y"))


def atlas_uv(placed: DataFrame) -> DataFrame:
    """Texture coordinates of ring corners placed in an atlas, origin at the lower left; zero areas take room but get none."""
    return placed.where("area <> 0").select("*", F.transform("image", lambda p: F.struct(((p["u"] - F.col("min_x") + F.col("off_x")) / F.col("atlas_w")).alias("u"), F.abs((p["v"] - F.col("min_y") + F.col("off_y")) / F.col("atlas_h") - F.lit(1e0)).alias("v"))).alias("uv"))


def rectified_uv(x, y, w, h) -> tuple:
    """Texture coordinates of a pixel of a frontal view's atlas of w x h, rows counted from the top."""
    return x / w, (h - y) / h
