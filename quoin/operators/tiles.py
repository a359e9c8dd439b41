"""Tiled photographs and ortho mosaics: layout by window functions, overlaps by binned range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import lit


def layout(tile: DataFrame) -> DataFrame:
    """Tiles (col, row_no, w, h) with offsets and the whole image's size.

    A column is as wide as its first tile from the top, a row as high as its first from the left;
    offsets are the sums of what is before.
    """
    wide = tile.groupBy("col").agg(F.min(F.struct("row_no", "w"))["w"].alias("cw"))
    high = tile.groupBy("row_no").agg(F.min(F.struct("col", "h"))["h"].alias("rh"))
    before = lambda c: W.orderBy(c).rowsBetween(W.unboundedPreceding, -1)
    wide = wide.withColumn("off_x", F.coalesce(F.sum("cw").over(before("col")), F.lit(0))).withColumn("total_w", F.sum("cw").over(W.partitionBy()))
    high = high.withColumn("off_y", F.coalesce(F.sum("rh").over(before("row_no")), F.lit(0))).withColumn("total_h", F.sum("rh").over(W.partitionBy()))
    return tile.join(wide, "col").join(high, "row_no").select("col", "row_no", "w", "h", "off_x", "off_y", "total_w", "total_h")


def _cells(low: str, high: str, cell: float):
    return F.sequence(F.floor(F.col(low) / lit(cell)), F.floor(F.col(high) / lit(cell)))


def overlaps(left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: float) -> DataFrame:
    """Pairs of boxes (x1, y1, x2, y2) that share an area, with the shared box (strict: no shared edge counts).

    Boxes are put on a grid of `cell`, and pairs meet by an equi-join on grid cells; a pair is kept in
    the one cell that holds its shared box's least corner, so nothing is removed afterwards.
    """
    grid = lambda df: df.withColumn("gx", F.explode(_cells("x1", "x2", cell))).withColumn("gy", F.explode(_cells("y1", "y2", cell)))
    a = grid(left.select(left_id, "x1", "y1", "x2", "y2"))
    b = grid(right.select(right_id, *[F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")]).withColumnsRenamed({f"_{c}": c for c in ("x1", "y1", "x2", "y2")})).withColumnsRenamed({c: f"_{c}" for c in ("x1", "y1", "x2", "y2")})
    both = a.join(b, ["gx", "gy"]).select(left_id, right_id, "gx", "gy", F.greatest("x1", "_x1").alias("ix1"), F.greatest("y1", "_y1").alias("iy1"), F.least("x2", "_x2").alias("ix2"), F.least("y2", "_y2").alias("iy2"))
    here = (F.floor(F.col("ix1") / lit(cell)) == F.col("gx")) & (F.floor(F.col("iy1") / lit(cell)) == F.col("gy"))
    return both.where((F.col("ix1") < F.col("ix2")) & (F.col("iy1") < F.col("iy2")) & here).drop("gx", "gy")


def covered(points: DataFrame, keys: list[str], boxes: DataFrame, cell: float) -> DataFrame:
    """Points (keys, x, y) with `covered`, whether they lie in some box (x1, y1, x2, y2), edges included.

    Boxes are put on a grid of `cell`, each point in one cell, and they meet by an equi-join.
    """
    b = boxes.select("x1", "y1", "x2", "y2").withColumn("gx", F.explode(_cells("x1", "x2", cell))).withColumn("gy", F.explode(_cells("y1", "y2", cell)))
    put = points.withColumns({"gx": F.floor(F.col("x") / lit(cell)), "gy": F.floor(F.col("y") / lit(cell))})
    hit = put.join(b, ["gx", "gy"]).where(F.col("x").between(F.col("x1"), F.col("x2")) & F.col("y").between(F.col("y1"), F.col("y2"))).select(keys).distinct()
    return points.join(hit.withColumn("covered", F.lit(True)), keys, "left").fillna(False, ["covered"])


def tile_name(path: str = "path") -> F.Column:
    """(base, col, row_no) of a tile's file name base_col_row.ext; null for other names."""
    p = F.regexp_extract(F.col(path), r"([^/]+)$", 1)
    part = lambda i: F.regexp_extract(p, r"^(.+)_(\d+)_(\d+)\.[^.]+$", i)
    return F.when(part(1) != "", F.struct(part(1).alias("base"), part(2).cast("int").alias("col"), part(3).cast("int").alias("row_no")))


def grid(image: DataFrame, size: int = 1000) -> DataFrame:
    """The tiles of an image (name, w, h) in squares of `size`, the last of a row or column narrower."""
    n = lambda c: F.sequence(F.lit(0), F.ceil(F.col(c) / lit(size)).cast("int") - 1)
    t = image.withColumn("col", F.explode(n("w"))).withColumn("row_no", F.explode(n("h")))
    return t.select(F.concat_ws("_", "name", "col", "row_no").alias("tile"), "col", "row_no", F.least(F.lit(size), F.col("w") - F.col("col") * size).alias("tw"), F.least(F.lit(size), F.col("h") - F.col("row_no") * size).alias("th"))
