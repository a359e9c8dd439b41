"""OBJ, MTL and PNG output: text is made in columns, files by a writer with one building to a file."""

from __future__ import annotations

import os
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .meshes import index_text, suffix


def vertex_line(x: Column, y: Column, z: Column, swap: bool = False) -> Column:
    """A `v` line with six decimals; x and y change places on request."""
    return F.format_string("v %.6f %.6f %.6f", *((y, x, z) if swap else (x, y, z)))


def face_line(corners: Column, swap: bool = False) -> Column:
    """An `f` line; a swap of x and y also turns the corners' order."""
    c = F.reverse(corners) if swap else corners
    return F.concat(F.lit("f "), F.array_join(F.transform(c, index_text), " "))


def obj_text(vertex: DataFrame, faces: DataFrame, key: str = "bldg_id", mtl: str | None = None, swap: bool = False) -> DataFrame:
    """K1, K2: (key, text): vertices by index, then each element's section; mtllib and usemtl come first if there is a material."""
    v = vertex.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "x", "y", "z"))), lambda p: vertex_line(p["x"], p["y"], p["z"], swap)).alias("v"))
    order = F.array_position(F.array(F.lit("Roof"), F.lit("Wall"), F.lit("Ground")), F.col("element"))
    f = faces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "element", "face_no", face_line(F.col("corners"), swap).alias("line")))).alias("f"))
    section = lambda name: F.concat(F.array(F.lit(f"# {name}")), F.transform(F.filter("f", lambda x: x["element"] == name), lambda x: x["line"]))
    head = F.array(*([F.lit(f"mtllib {mtl}"), F.lit("usemtl texture")] if mtl else [])).cast("array<string>")
    return v.join(f, key).select(key, F.concat(F.array_join(F.concat(head, "v", section("Roof"), section("Wall"), section("Ground")), "\n"), F.lit("\n")).alias("text"))


def mtl_text(name: Column, map_kd: Column) -> Column:
    """K4, Q18: a material file's text, always whole."""
    return F.concat(F.lit("newmtl "), name, F.lit("\nKa 0.000000 0.000000 0.000000\nKd 1.000000 1.000000 1.000000\nmap_Kd "), map_kd, F.lit("\n"))


def retarget(line: Column, folder: str, suffix: str) -> Column:
    """K5: a map_Kd line led to folder/stem.suffix; other lines as they are."""
    return F.when(F.lower(line).startswith("map_kd "), F.concat(F.lit(f"map_Kd {folder}/"), F.regexp_replace(F.regexp_extract(line, r"([^/\s]+)\s*$", 1), r"\.[^.]*$", ""), F.lit(f".{suffix}"))).otherwise(line)


def replace_block(lines: DataFrame, fresh: DataFrame, key: str, what: str = "vt") -> DataFrame:
    """K3: lines with all `what` lines gone and the fresh ones (key, sub_no, line) at the first one's place."""
    is_old = F.startswith(F.col("line"), F.lit(f"{what} "))
    at = lines.where(is_old).groupBy(key).agg(F.min("line_no").alias("line_no"))
    kept = lines.where(~is_old).select(key, "line_no", F.lit(0).alias("sub_no"), "line")
    return kept.unionByName(fresh.join(at, key).select(key, "line_no", "sub_no", "line"))


def rectified_obj(lines: DataFrame, vt: DataFrame, faces: DataFrame, key: str) -> DataFrame:
    """K3: (key, line_no, line): lines with the vt block replaced at its first line and textured `f` lines written anew.

    vt (key, idx, u, v); faces (key, line_no, corners) with pos and tex. Each building's own material
    comes first; other `mtllib ` and `usemtl ` lines go.
    """
    fresh = vt.select(key, F.col("idx").alias("sub_no"), F.concat_ws(" ", F.lit("vt"), F.col("u").cast("string"), F.col("v").cast("string")).alias("line"))
    kept = replace_block(lines, fresh, key)
    made = faces.select(key, "line_no", F.concat(F.lit("f "), F.array_join(F.transform("corners", lambda c: F.concat_ws("/", c["pos"].cast("string"), c["tex"].cast("string"))), " ")).alias("_made"))
    kept = kept.join(made, [key, "line_no"], "left").select(key, "line_no", "sub_no", F.coalesce("_made", "line").alias("line"))
    kept = kept.where(~F.startswith("line", F.lit("mtllib ")) & ~F.startswith("line", F.lit("usemtl ")) & (F.col("line") != ""))
    name = F.col(key).cast("string")
    head = lines.select(key).distinct().select(key, F.explode(F.array(F.struct(F.lit(-2).alias("line_no"), F.lit(0).alias("sub_no"), F.concat(F.lit("mtllib "), name, F.lit(".mtl")).alias("line")), F.struct(F.lit(-1).alias("line_no"), F.lit(0).alias("sub_no"), F.concat(F.lit("usemtl "), name).alias("line")))).alias("h")).select(key, "h.*")
    every = head.unionByName(kept)
    return every.select(key, F.row_number().over(W.partitionBy(key).orderBy("line_no", "sub_no")).alias("line_no"), "line")


def short_mtl(name: Column, map_kd: Column) -> Column:
    """K4: a material file of one texture."""
    return F.concat(F.lit("newmtl "), name, F.lit("\nmap_Kd "), map_kd, F.lit("\n"))


def obj_copies(lines: DataFrame, texture: DataFrame, key: str, new_suffix: str | None = None) -> DataFrame:
    """K6: (key, text, mtl): an OBJ whose mtllib lines lead to {key}.mtl, and that file's text if the OBJ has a texture (key, map_kd)."""
    name = F.col(key).cast("string")
    line = F.when(F.lower(F.trim("line")).startswith("mtllib "), F.concat(F.lit("mtllib "), name, F.lit(".mtl"))).otherwise(F.col("line"))
    text = lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    end = F.lit(f".{new_suffix.lstrip('.')}") if new_suffix else suffix(F.col("map_kd"))
    return text.join(texture, key, "left").select(key, "text", F.when(F.col("map_kd").isNotNull(), short_mtl(name, F.concat(F.lit("../appearance/"), name, end))).alias("mtl"))


def ordered(files: DataFrame, key: str = "bldg_id") -> DataFrame:
    """O1: files in the order of their ids as text, as a listing gives them."""
    return files.orderBy(F.col(key).cast("string"))


def run_status(results: DataFrame) -> DataFrame:
    """(n_processed, n_assigned, status) of with_fallback's rows; status 1 if any building kept its original."""
    return results.agg(F.count("*").alias("n_processed"), F.count(F.when(F.col("status") == 0, 1)).alias("n_assigned"), F.max("status").alias("status"))


def result_zip(folder: str, out: str, marker: str = "completed") -> list[str]:
    """K9: the files of obj/ and appearance/ in one archive on the driver, then the marker file beside it."""
    names = sorted(os.path.relpath(os.path.join(at, f), folder) for part in ("obj", "appearance") for at, _, files in os.walk(os.path.join(folder, part)) for f in files)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in names:
            z.write(os.path.join(folder, n), n)
    with open(os.path.join(os.path.dirname(out), marker), "w"):
        pass
    return names


def with_fallback(original: DataFrame, made: DataFrame, key: str = "bldg_id") -> DataFrame:
    """K8, Q22, Q23: each building's new text, or its original where there is none; status 1 marks the latter."""
    both = original.withColumnRenamed("text", "_old").join(made, key, "left")
    return both.select(key, F.coalesce("text", "_old").alias("text"), F.when(F.col("text").isNull(), 1).otherwise(0).alias("status"))


def png(pixels: np.ndarray) -> bytes:
    """K7: a PNG of height x width x 3 bytes in BGR order."""
    rgb = np.ascontiguousarray(pixels[:, :, ::-1])
    h, w, _ = rgb.shape
    rows = np.concatenate([np.zeros((h, 1), np.uint8), rgb.reshape(h, 3 * w)], axis=1).tobytes()
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """One file for each row (name, data): tasks write through the cluster's file system and report (name, bytes).

    A name is first written beside its place and then moved there, so a task that runs twice leaves
    one whole file.
    """
    from pyarrow import fs as pafs

    def write(batches: Iterator) -> Iterator:
        import pandas as pd

        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for pdf in batches:
            for name, data in zip(pdf["name"], pdf["data"]):
                part = f"{base}/.{name}.{np.random.default_rng().integers(1 << 62)}"
                with system.open_output_stream(part) as out:
                    out.write(bytes(data))
                system.move(part, f"{base}/{name}")
            yield pd.DataFrame({"name": pdf["name"], "n_bytes": [len(d) for d in pdf["data"]]})

    return files.select("name", "data").mapInPandas(write, "name string, n_bytes long")
