"""Queries on OBJ, MTL, orientation, camera and world-file text, and on what is written of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import faces
from ..sources import fixtures, meshes, sinks
from . import settings
from .registry import _IDX, _obj_texts, query

KEY = "bldg_id"


def _objs(spark, sf_dir) -> DataFrame:
    """Textured OBJ lines of every building, with gaps: see the query's SQL (`_FACES`)."""
    c = faces.dedup_vertices(fixtures.table(spark, sf_dir, "corner"))
    v = c.select(KEY, F.col("v_idx").alias("idx"), "x", "y", "z").distinct()
    v = v.groupBy(KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "x", "y", "z"))), lambda p: sinks.vertex_line(p["x"], p["y"], p["z"])).alias("v"))
    n = F.col("v_idx") + F.when((F.col(KEY) % 7 == 0) & (F.col("face_no") == 0) & (F.col("seq") == 0), 100).otherwise(0)
    corner = F.concat(n.cast("string"), F.when(F.col("face_no").isin(0, 1, 3), F.concat(F.lit("/"), (F.col("seq") + 1).cast("string"))).when(F.col("face_no") == 4, F.concat(F.lit("/"), (4 - F.col("seq")).cast("string"), F.lit("/7"))).when(F.col("face_no") == 5, "//9").otherwise(""))
    c = c.where(~((F.col(KEY) % 3 == 0) & (F.col("face_no") == 3) & (F.col("seq") > 1)))
    f = c.groupBy(KEY, "face_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", corner.alias("c")))), lambda p: p["c"]), " ").alias("f"))
    line = lambda i: F.concat(F.lit("F " if i == 1 else "f "), F.max(F.when(F.col("face_no") == i, F.col("f"))))
    f = f.groupBy(KEY).agg(*[line(i).alias(f"f{i}") for i in range(6)])
    text = F.concat_ws("\n", F.concat(F.lit("mtllib m"), F.col(KEY), F.lit(".mtl")), F.array_join("v", "\n"), F.lit("vt 0 0\nvt 1 0\nvt 1 1\nvt 0 1"), F.lit("# Roof\nusemtl roof"), "f0", F.lit("# Wall\nUSEMTL wall"), "f1", "f2", "f3", "f4", F.when(F.col(KEY) % 5 == 0, "#").otherwise("# Ground"), "f5")
    return meshes.text_lines(v.join(f, KEY).select(KEY, text.alias("text")), KEY, "text")


#: The corners of those texts: face 2 has no texture, face 5 a normal only, face 3 of every third building two corners.
_FACES = _IDX + """,
fc as (select bldg_id, face_no, cast(seq as int) seq, cast(v_idx + case when bldg_id % 7 = 0 and face_no = 0 and seq = 0 then 100 else 0 end as int) pos, x, y, z,
  cast(case when face_no in (0, 1, 3) then seq + 1 when face_no = 4 then 4 - seq end as int) tex, case face_no when 4 then 7 when 5 then 9 end norm, case when face_no = 0 then 'roof' else 'wall' end material
  from ix where not (bldg_id % 3 = 0 and face_no = 3 and seq > 1))"""
_RANK = "(case face_no when 0 then 1 when 1 then 2 when 3 then 3 else 4 end)"


def _with_rank(rows: DataFrame) -> DataFrame:
    """Faces numbered from 1 in the order of their lines."""
    from pyspark.sql import Window as W

    return rows.withColumn("face", F.dense_rank().over(W.partitionBy(KEY).orderBy("line_no")))


@query(f"with {_FACES} select bldg_id, case when bldg_id % 5 = 0 then 'Ground' else '' end missing, cast(case when bldg_id % 7 = 0 then 1 else 0 end as bigint) n_bad_pos, cast(0 as bigint) n_bad_tex, bldg_id % 5 <> 0 and bldg_id % 7 <> 0 ok from fc group by bldg_id", "corner")
def obj_strict_check(spark, sf_dir):
    """Sections that must be there, and indices beyond the pools."""
    return meshes.obj_check(_objs(spark, sf_dir), KEY)


@query(f"with {_FACES} select bldg_id, case when face_no = 0 then 'Roof' when face_no = 5 and bldg_id % 5 <> 0 then 'Ground' else 'Wall' end label, seq, pos, tex, norm, count(*) n from fc where face_no <> 1 group by all", "corner")
def obj_strict_faces(spark, sf_dir):
    """Faces by section, with exact commands, so a line `F` is none."""
    return meshes.strict_faces(_objs(spark, sf_dir), KEY).groupBy(KEY, "label", "seq", "pos", "tex", "norm").agg(F.count("*").alias("n"))


@query(f"with {_FACES} select bldg_id, {_RANK} face, material, seq, pos, tex, norm, string_agg(case when face_no = 4 then pos || '/' || tex || '/7' else pos || '/' || tex end, ' ') over (partition by bldg_id, face_no order by seq rows between unbounded preceding and unbounded following) line from fc where tex is not null", "corner")
def obj_textured_faces(spark, sf_dir):
    """Textured faces with commands in any case and the raw line."""
    rows = _with_rank(meshes.textured_faces(_objs(spark, sf_dir), KEY))
    return rows.select(KEY, "face", "material", "seq", "pos", "tex", "norm", F.substr("line", F.lit(3)).alias("line"))


@query(f"with {_FACES} select bldg_id, {_RANK} - case when face_no = 4 and bldg_id % 3 = 0 then 1 else 0 end face, material, seq, pos, tex from fc where tex is not null and not (bldg_id % 3 = 0 and face_no = 3)", "corner")
def obj_wall_faces(spark, sf_dir):
    """From bytes that are not all UTF-8, textured faces of three corners or more."""
    lines = _objs(spark, sf_dir)
    broken = lines.select(KEY, "line_no", meshes.lenient_text(F.concat(F.col("line").cast("binary"), F.unhex(F.lit("FF")))).alias("line"))
    return _with_rank(meshes.textured_faces(broken, KEY, 3)).select(KEY, "face", "material", "seq", "pos", "tex")


@query(f"with {_FACES} select bldg_id, {_RANK} face, seq, x, y, z, case when tex in (2, 3) then 1e0 else 0e0 end u, case when tex > 2 then 1e0 else 0e0 end v from fc where tex is not null and pos < 100", "corner")
def obj_corner_points(spark, sf_dir):
    """Corners with their point and texture place; an index beyond the pool has none."""
    lines = _objs(spark, sf_dir)
    rows = _with_rank(meshes.textured_faces(lines, KEY))
    return meshes.placed_corners(rows, lines, KEY).select(KEY, "face", "seq", "x", "y", "z", "u", "v")


@query(f"with {_FACES} select bldg_id, {_RANK} face, seq, case when material = 'wall' then 'w' || bldg_id || '.png' when bldg_id % 4 <> 0 then 'r' || bldg_id || '.png' end by_face, 'w' || bldg_id || '.png' by_object from fc where tex is not null", "corner")
def face_texture(spark, sf_dir):
    """The texture of each face by its own material, and by the object's last one; every fourth roof's material has none."""
    rows = _with_rank(meshes.textured_faces(_objs(spark, sf_dir), KEY))
    b = F.col(KEY).cast("string")
    text = F.concat_ws("\n", F.lit("newmtl roof"), F.when(F.col(KEY) % 4 != 0, F.concat(F.lit("map_Kd r"), b, F.lit(".png"))), F.concat(F.lit("newmtl wall\nmap_Kd w"), b, F.lit(".png")))
    found = meshes.materials(meshes.text_lines(fixtures.table(spark, sf_dir, "part").select(F.col("p_partkey").alias(KEY)).withColumn("text", text), KEY, "text"), KEY)
    one, whole = (meshes.textured(rows, found, KEY, w).select(KEY, "face", "seq", F.col("map_kd").alias(n)) for w, n in ((False, "by_face"), (True, "by_object")))
    return one.join(whole, [KEY, "face", "seq"])


@query(f"""with {_FACES}, vl as (select distinct bldg_id, 100 + v_idx o, printf('v %.6f %.6f %.6f', x, y, z) line from ix),
fl as (select bldg_id, face_no, case when any_value(tex) is null then case when face_no = 5 then string_agg(pos || '//9', ' ' order by seq) else string_agg(cast(pos as varchar), ' ' order by seq) end else string_agg(pos || '/' || tex, ' ' order by seq) end line from fc group by bldg_id, face_no),
l as (select bldg_id, 1 o, 'mtllib ' || bldg_id || '.mtl' line from fl where face_no = 0 union all select bldg_id, 2, 'usemtl ' || bldg_id from fl where face_no = 0 union all select * from vl
 union all select bldg_id, 200 + i, 'vt 0.' || i || ' 0.5' from fl, (select unnest([1,2,3,4,5]) i) where face_no = 0 union all select bldg_id, 300, '# Roof' from fl where face_no = 0 union all select bldg_id, 302, '# Wall' from fl where face_no = 0
 union all select bldg_id, 303, 'USEMTL wall' from fl where face_no = 0 union all select bldg_id, 320, case when bldg_id % 5 = 0 then '#' else '# Ground' end from fl where face_no = 0 union all select bldg_id, case face_no when 0 then 301 when 5 then 330 else 310 + face_no end, 'f ' || line from fl)
select bldg_id, row_number() over (partition by bldg_id order by o) line_no, line from l""", "corner")
def obj_rectified(spark, sf_dir):
    """K3: the vt block and the textured faces written anew, and the building's own material in front."""
    lines = _objs(spark, sf_dir)
    corners = meshes.textured_faces(lines, KEY).groupBy(KEY, "line_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", "tex"))), lambda c: F.struct(c["pos"].alias("pos"), c["tex"].alias("tex"))).alias("corners"))
    vt = lines.select(KEY).distinct().select(KEY, F.explode(F.sequence(F.lit(1), F.lit(5))).alias("idx")).select(KEY, "idx", (F.col("idx") / F.lit(1e1)).alias("u"), F.lit(0.5).alias("v"))
    return sinks.rectified_obj(lines, vt, corners, KEY)


@query(f"""with {_IDX}, l as (select distinct bldg_id, 100 + v_idx o, printf('v %.6f %.6f %.6f', y, x, z) line from ix union all select bldg_id, o, s from (select distinct bldg_id from ix), (values (1, 'mtllib a.mtl'), (2, 'usemtl texture'), (200, '# Roof'), (210, '# Wall'), (220, '# Ground')) t(o, s)
 union all select bldg_id, case face_no when 0 then 201 when 5 then 221 else 210 + face_no end, 'f ' || string_agg(cast(v_idx as varchar), ' ' order by seq desc) from ix group by bldg_id, face_no)
select bldg_id, string_agg(line, chr(10) order by o) || chr(10) as text from l group by bldg_id""", "corner")
def obj_swapped(spark, sf_dir):
    """Whole texts with x and y in each other's place and corners turned over."""
    return _obj_texts(spark, sf_dir, mtl="a.mtl", swap=True)


@query("select n_nationkey n, case when n_nationkey % 2 = 1 then n_nationkey || '/' || case when n_nationkey % 3 = 0 then '' else cast(n_nationkey + 1 as varchar) end || '/' || (n_nationkey + 2) when n_nationkey % 3 = 0 then cast(n_nationkey as varchar) else n_nationkey || '/' || (n_nationkey + 1) end said, case when n_nationkey % 3 <> 0 then n_nationkey + 1 end tex from nation")
def corner_text(spark, sf_dir):
    """Corners written with and without texture and normal, and read again."""
    k = F.col("n_nationkey").cast("int")
    c = F.struct(k.alias("pos"), F.when(k % 3 != 0, k + 1).alias("tex"), F.when(k % 2 == 1, k + 2).alias("norm"))
    n = fixtures.table(spark, sf_dir, "nation").select(k.alias("n"), c.alias("c")).withColumn("said", meshes.index_text(F.col("c")))
    return n.select("n", "said", meshes.index(F.col("said"))["tex"].alias("tex"))


@query("""with p as (select s_suppkey k, case when s_suppkey % 4 = 0 then '/abs/' else './rel/' end || 'b.' || s_suppkey || case when s_suppkey % 3 = 0 then '' else '.TIFF' end as path from supplier)
select k, 'b.' || k || case when k % 3 = 0 then '' else '.TIFF' end as name, case when k % 3 = 0 then 'b' else 'b.' || k end stem, case when k % 3 = 0 then '.' || k else '.TIFF' end suffix, k % 3 <> 0 as image, case when k % 4 = 0 then path else '/base/' || substr(path, 3) end whole from p""")
def path_parts(spark, sf_dir):
    """Name, stem, suffix, image test and absolute path."""
    k = F.col("s_suppkey")
    p = fixtures.table(spark, sf_dir, "supplier").select(k.alias("k"), F.concat(F.when(k % 4 == 0, "/abs/").otherwise("./rel/"), F.lit("b."), k, F.when(k % 3 == 0, "").otherwise(".TIFF")).alias("path"))
    c = F.col("path")
    return p.select("k", meshes.file_name(c).alias("name"), meshes.stem(c).alias("stem"), meshes.suffix(c).alias("suffix"), meshes.is_image(c).alias("image"), meshes.absolute(c, F.lit("/base/")).alias("whole"))


def _materials(spark, sf_dir) -> DataFrame:
    """Material files, one a supplier: some with a name of two words, a texture before any material, or none at all."""
    k = F.col("s_suppkey")
    s = k.cast("string")
    text = F.when(k % 4 == 1, F.concat(F.lit("newmtl a\nmap_Kd x y"), s)).when(k % 4 == 2, F.concat(F.lit("map_Kd z.png\nnewmtl a\nmap_Kd q"), s, F.lit(".jpg"))).otherwise(F.concat(F.lit("newmtl a\nmap_Kd t"), s, F.lit(".png\nmap_Kd u.png\nnewmtl b c")))
    return meshes.text_lines(fixtures.table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("select s_suppkey, cast(case s_suppkey % 4 when 1 then 1 when 2 then 0 else 3 end as int) line_no, case when s_suppkey % 4 = 2 then 'no material' else 'words' end problem from supplier")
def material_problems(spark, sf_dir):
    """Lines that a strict reader refuses."""
    return meshes.material_errors(_materials(spark, sf_dir), "s_suppkey")


def _obj_heads(spark, sf_dir) -> DataFrame:
    """OBJ texts that name two material files, of which every third's first one does not exist."""
    k = F.col("s_suppkey")
    text = F.concat(F.lit("# a\n MTLLIB "), F.when(k % 3 == 0, F.lit("none.mtl")).otherwise(F.concat(F.lit("m"), k, F.lit(".mtl"))), F.lit("\nmtllib m"), k, F.lit(".mtl\nv 0 0 0"))
    return meshes.text_lines(fixtures.table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text").withColumn("line", F.trim("line"))


_TEXTURE = "case when s_suppkey % 3 <> 0 then case s_suppkey % 4 when 1 then 'x y' || s_suppkey when 2 then 'z.png' else 't' || s_suppkey || '.png' end end"


@query(f"select s_suppkey, {_TEXTURE} map_kd from supplier")
def first_texture(spark, sf_dir):
    """The first texture of the first material file that is named."""
    files = _materials(spark, sf_dir).withColumn("mtl", F.concat(F.lit("m"), "s_suppkey", F.lit(".mtl"))).drop("s_suppkey")
    return meshes.first_textures(_obj_heads(spark, sf_dir), files, "s_suppkey", "mtl")


@query(f"""with t as (select s_suppkey, {_TEXTURE} m from supplier) select s_suppkey, '# a' || chr(10) || 'mtllib ' || s_suppkey || '.mtl' || chr(10) || 'mtllib ' || s_suppkey || '.mtl' || chr(10) || 'v 0 0 0' as text,
'newmtl ' || s_suppkey || chr(10) || 'map_Kd ../appearance/' || s_suppkey || case when m like '%.png' then '.png' else '' end || chr(10) || '' as mtl from t where m is not null
union all select s_suppkey, '# a' || chr(10) || 'mtllib ' || s_suppkey || '.mtl' || chr(10) || 'mtllib ' || s_suppkey || '.mtl' || chr(10) || 'v 0 0 0', null from t where m is null""")
def obj_copy(spark, sf_dir):
    """K6 K4: OBJ texts led to their own material file, and that file where there is a texture."""
    return sinks.obj_copies(_obj_heads(spark, sf_dir), first_texture(spark, sf_dir), "s_suppkey")


@query("select bldg_id, case when bldg_id % 3 = 0 then 1 else 0 end status, case when bldg_id % 3 = 0 then 'old' else 'new' end as text from corner group by bldg_id", "corner")
def obj_fallback(spark, sf_dir):
    """K8 Q22 Q23: the original of every building without a new text."""
    b = fixtures.table(spark, sf_dir, "corner").select(KEY).distinct()
    return sinks.with_fallback(b.withColumn("text", F.lit("old")), b.where(F.col(KEY) % 3 != 0).withColumn("text", F.lit("new")))


@query("select count(*) n_processed, count(*) filter (p_partkey % 3 <> 0) n_assigned, 1 status from part")
def run_status(spark, sf_dir):
    """Processed and assigned buildings, and the run's status."""
    return sinks.run_status(obj_fallback(spark, sf_dir))


@query("select p_partkey as bldg_id, row_number() over (order by cast(p_partkey as varchar)) - 1 place from part")
def ordered_buildings(spark, sf_dir):
    """O1: buildings in the order of their ids as text, numbered across the sorted partitions."""
    b = sinks.ordered(fixtures.table(spark, sf_dir, "part").select(F.col("p_partkey").alias(KEY)))
    sorted_ = b.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    sizes = sorted_.groupBy("part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    from pyspark.sql import Window as W

    before = sizes.select("part", "first", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return sorted_.join(F.broadcast(before), "part").select(KEY, (F.col("row") - F.col("first") + F.col("before")).alias("place"))


# --- photos ---


def _orientation(spark, sf_dir) -> DataFrame:
    s = fixtures.table(spark, sf_dir, "supplier")
    raw = s.selectExpr("concat('p', s_suppkey, '.tif') file", "cast(s_suppkey as string) x", "case when s_suppkey % 9 = 0 then '' else '7' end y", "'500' z", "'1' omega", "'2' phi", "cast(s_nationkey as string) kappa")
    return meshes.check_orientation(raw)


def _images(spark, sf_dir) -> DataFrame:
    return fixtures.table(spark, sf_dir, "supplier").where("s_suppkey % 5 <> 0").selectExpr("concat('p', s_suppkey, '.tif') file", "6000 + cast(s_suppkey % 3 as int) * 600 w", "4000 h")


def _cameras(spark, sf_dir) -> DataFrame:
    """Camera files: one a nation, some with further columns, some with a gap."""
    k = F.col("n_nationkey")
    row = F.concat_ws("\t", F.lit("50"), F.lit("36"), F.lit("24"), F.when(k % 4 == 0, "").otherwise("6"), F.lit("4"), F.lit("0.5"), F.lit("-0.25"), F.when(k % 3 == 0, "0.01\t\t0.02\t0.03").when(k % 3 == 1, "0.01\t0.02"))
    return meshes.text_lines(fixtures.table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("f\tw\th\n"), row).alias("text")), "n_nationkey", "text")


@query("select n_nationkey, n_nationkey % 4 <> 0 complete, 50e0 f, 36e0 sensor_w, 24e0 sensor_h, case when n_nationkey % 4 <> 0 then 6e0 end pixel_x, 4e0 pixel_y, 5e-1 ppx, -25e-2 ppy, n_nationkey % 3 = 0 calibrated, 4e0 shift_x, 5e-1 shift_y, -25e-2 cubic, case when n_nationkey % 3 <> 2 then 1e-2 end quintic from nation")
def camera_files(spark, sf_dir):
    """Camera rows, calibrated by exactly three further columns."""
    return meshes.camera_rows(_cameras(spark, sf_dir), "n_nationkey")


@query("select 'p' || s_suppkey || '.tif' file, cast(s_suppkey as double) x, cast(s_nationkey as double) kappa, cast(6000 + s_suppkey % 3 * 600 as int) w, 4000 h, case when s_suppkey % 3 = 0 then 36e0 end sensor_w, case when s_suppkey % 3 = 0 then 16e0 end sensor_h, 50e0 f from supplier where s_suppkey % 9 <> 0 and s_suppkey % 5 <> 0")
def photo_open(spark, sf_dir):
    """Photos with orientation, image and camera; a sensor side is null where it agrees with none of the camera's."""
    camera = meshes.camera_rows(_cameras(spark, sf_dir), "n_nationkey").where("n_nationkey = 3")
    return meshes.opened(_orientation(spark, sf_dir), camera, _images(spark, sf_dir)).select("file", "x", "kappa", "w", "h", "sensor_w", "sensor_h", "f")


@query("select 'p' || s_suppkey || '.tif' file from supplier where s_suppkey % 9 <> 0 and s_suppkey % 5 = 0")
def photo_missing(spark, sf_dir):
    """Orientation rows without an image."""
    return meshes.without_image(_orientation(spark, sf_dir), _images(spark, sf_dir))


@query("""with c as (select r_regionkey ortho_id, 5e-1 a, 1e-2 * r_regionkey b, r_regionkey * 160e0 + 25e-2 + 5e-3 * r_regionkey c0, 0e0 d, -5e-1 e, 9995e-1 - 25e-2 + 5e-1 f0 from region),
w as (select ortho_id, a, b, c0 - a / 2 - b / 2 c, d, e, f0 - d / 2 - e / 2 f from c),
i as (select *, e / (a * e - b * d) ia, -b / (a * e - b * d) ib, -d / (a * e - b * d) id_, a / (a * e - b * d) ie from w)
select ortho_id, bldg_id, seq, round(ia * x + ib * y - (ia * c + ib * f), 4) + 0e0 px, round(id_ * x + ie * y - (id_ * c + ie * f), 4) + 0e0 p_y,
  ia * x + ib * y - (ia * c + ib * f) >= 0 and ia * x + ib * y - (ia * c + ib * f) < 320 and id_ * x + ie * y - (id_ * c + ie * f) >= 0 and id_ * x + ie * y - (id_ * c + ie * f) < 2000 inside
from i cross join (select bldg_id, seq, x + 1e-3 x, y + 1e-3 y from corner where face_no = 0)""", "corner")
def world_file_pixels(spark, sf_dir):
    """Roof corners in single orthos, by the inverse of the world file's affine."""
    k = F.col("r_regionkey")
    text = F.concat_ws("\n", F.lit("0.5"), F.lit("0.0"), (k * F.lit(0.01)).cast("string"), F.lit("-0.5"), (k * F.lit(160e0) + F.lit(0.25) + F.lit(0.005) * k).cast("string"), F.lit("999.75"))
    region = fixtures.table(spark, sf_dir, "region")
    world = meshes.world_file(meshes.text_lines(region.select(k.alias("ortho_id"), text.alias("text")), "ortho_id", "text"), "ortho_id")
    g = meshes.georeferenced(world, region.select(k.alias("ortho_id"), F.lit(320).alias("w"), F.lit(2000).alias("h")), "ortho_id")
    c = fixtures.table(spark, sf_dir, "corner").where("face_no = 0").selectExpr("bldg_id", "seq", "x + 1e-3 x", "y + 1e-3 y")
    at = c.crossJoin(F.broadcast(g)).withColumns({"px": F.col("ia") * F.col("x") + F.col("ib") * F.col("y") + F.col("ic"), "p_y": F.col("id_") * F.col("x") + F.col("ie") * F.col("y") + F.col("if_")})
    inside = (F.col("px") >= 0) & (F.col("px") < F.col("w")) & (F.col("p_y") >= 0) & (F.col("p_y") < F.col("h"))
    return at.select("ortho_id", KEY, "seq", (F.round("px", 4) + F.lit(0e0)).alias("px"), (F.round("p_y", 4) + F.lit(0e0)).alias("p_y"), inside.alias("inside"))


# --- lists, settings, logs ---


@query("select id, roof_class from (values ('b1', 'others'), ('b2', 'lod2'), ('b3', null)) t(id, roof_class)")
def building_list(spark, sf_dir):
    """S18."""
    return meshes.buildings(spark, "buildings:\n- {id: b1, roof_class: others}\n- {id: b2, roof_class: lod2}\n- id: b3\n")


@query("""with p as (select o_orderkey % 250 bldg, o_orderkey % 2 has, 'root/' || (o_orderkey % 7) || '/' || (o_orderkey % 250) || case when o_orderkey % 2 = 0 then '/lod2.obj' else '/lod1.obj' end as path from orders)
select cast(bldg as varchar) id, case when has = 0 then 'lod2.obj' else 'lod1.obj' end as name, min(path) path from p group by all""")
def candidate_files(spark, sf_dir):
    """The first path of each building's file, at whatever depth."""
    o = fixtures.table(spark, sf_dir, "orders").selectExpr("concat('root/', o_orderkey % 7, '/', o_orderkey % 250, case when o_orderkey % 2 = 0 then '/lod2.obj' else '/lod1.obj' end) path")
    return meshes.candidate_paths(o)


@query("select * from (values (0, 'OutputFormat', 'jpg'), (0, 'MeterPerPixel', '0.04'), (0, 'InputDir', '/in'), (0, 'OutputDir', '/out'), (0, 'Device', 'cpu'), (1, 'OutputFormat', 'png'), (1, 'MeterPerPixel', '0.16'), (1, 'InputDir', '/a'), (1, 'OutputDir', '/b'), (1, 'Device', 'cuda')) t(run, name, said)")
def run_settings(spark, sf_dir):
    """The command line over the file over the defaults; an unknown device becomes the first known one."""
    given = [({"InputDir": "/in", "OutputFormat": "PNG", "Device": "cpu"}, {"OutputDir": "/out", "OutputFormat": "JPG", "MeterPerPixel": 0.04}), ({"InputDir": "/a", "OutputDir": "/b", "Device": "tpu"}, {"Device": None})]
    return spark.createDataFrame([(i, k, v) for i, g in enumerate(given) for k, v in settings.checked(settings.merged(*g)).items()], "run int, name string, said string")


@query("select 'a/t' || n_nationkey || '.jpg' uri, false handled from nation")
def city_image_uris(spark, sf_dir):
    """S22."""
    k = F.col("n_nationkey").cast("string")
    xml = F.concat(F.lit('<c xmlns:app="http://www.opengis.net/citygml/appearance/2.0"><app:t><app:imageURI>a/t'), k, F.lit(".jpg</app:imageURI></app:t><app:imageURI>a/t"), k, F.lit(".jpg</app:imageURI></c>"))
    return meshes.image_uris(fixtures.table(spark, sf_dir, "nation").select(xml.alias("xml")))


@query("select s_suppkey, 'wall ' || s_suppkey as name, cast(s_suppkey * 2 as bigint) n from supplier where s_suppkey % 5 <> 0")
def json_records(spark, sf_dir):
    """Records of JSON lines; every fifth line is broken."""
    k = F.col("s_suppkey")
    line = F.when(k % 5 == 0, "{broken").otherwise(F.to_json(F.struct(F.concat(F.lit("wall "), k).alias("name"), (k * 2).alias("n"))))
    return meshes.json_log(fixtures.table(spark, sf_dir, "supplier").select("s_suppkey", line.alias("line")), "name string, n long").select("s_suppkey", "name", "n")


