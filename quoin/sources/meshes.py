"""OBJ, MTL and orientation text as DataFrames. Files are read whole, so line numbers are the file's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def file_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, stem, line_no, line) of text files: S5, S19."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=recursive).select(F.col("_metadata.file_path").alias("path"), "value")
    return text_lines(files.withColumn("stem", stem(F.col("path"))), "stem", "value", "path")


def text_lines(texts: DataFrame, key: str, text: str, *more: str) -> DataFrame:
    """(key, more, line_no, line) of a column of file texts."""
    return texts.select(key, *more, F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line"))


def stem(path: Column) -> Column:
    """C4: a file's name without folder and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def tokens(line: Column, strict: bool = False) -> Column:
    """Words of a line, cut at single spaces (strict) or at any white space."""
    return F.split(F.trim(line), " " if strict else r"\s+")


def command(line: Column) -> Column:
    return F.get(tokens(line), F.lit(0))


def numbers(line: Column) -> Column:
    return F.transform(after_first(tokens(line)), lambda t: t.try_cast("double"))


def after_first(items: Column) -> Column:
    return F.filter(items, lambda _, i: i > 0)


def file_name(path: Column) -> Column:
    """C4: a file's name without its folder."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def suffix(path: Column) -> Column:
    """C4: the last extension of a file's name with its dot; empty where it has none."""
    return F.regexp_extract(file_name(path), r"[^.](\.[^.]*)$", 1)


def absolute(path: Column, base: Column) -> Column:
    """C4: a path as it is if absolute, else below base."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.regexp_replace(path, r"^\./", "")))


def lenient_text(data: Column) -> Column:
    """The text of bytes, without those that are no UTF-8."""
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("\ufffd"), F.lit(""))


def obj_folder(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all OBJ files of a folder; an error where there is none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.obj").load(path)
    if not files.select("path").head(1):
        raise FileNotFoundError(f"no OBJ file in {path}")
    return text_lines(files.select(stem(F.col("path")).alias("stem"), "path", lenient_text(F.col("content")).alias("value")), "stem", "value", "path")


def vertices(lines: DataFrame, key: str, what: str = "v") -> DataFrame:
    """(key, idx, x, y, z) of `v` lines, or u, v of `vt` lines, numbered from 1 in each file."""
    n = numbers(F.col("line"))
    own = lines.where(command(F.col("line")) == what).withColumn("idx", F.row_number().over(W.partitionBy(key).orderBy("line_no")))
    names = ("x", "y", "z") if what == "v" else ("u", "v")
    return own.select(key, "idx", *[F.get(n, F.lit(i)).alias(c) for i, c in enumerate(names)])


def index(token: Column) -> Column:
    """pos[/tex[/norm]] as (pos, tex, norm); a missing part is null, more than three parts make all null."""
    parts = F.split(token, "/")
    part = lambda i: F.when(F.size(parts) <= 3, F.get(parts, F.lit(i)).try_cast("int"))
    return F.struct(part(0).alias("pos"), part(1).alias("tex"), part(2).alias("norm"))


def index_text(c: Column) -> Column:
    """The text of a corner; a normal without a texture is pos//norm."""
    s = lambda n: c[n].cast("string")
    return F.when(c["norm"].isNotNull(), F.concat(s("pos"), F.lit("/"), F.coalesce(s("tex"), F.lit("")), F.lit("/"), s("norm"))).when(c["tex"].isNotNull(), F.concat(s("pos"), F.lit("/"), s("tex"))).otherwise(s("pos"))


def face_corners(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, label, material, seq, pos, tex, norm) of `f` lines, with the label and material in force.

    A label is a line `# Roof`, `# Wall` or `# Ground`; a later section of the same label stands in
    for the earlier one (Q20), and other labels lead to no element.
    """
    line = F.col("line")
    label = F.when(line.startswith("#"), F.trim(F.substr(line, F.lit(2))))
    material = F.when(F.lower(command(line)) == "usemtl", F.get(tokens(line), F.lit(1)))
    before = W.partitionBy(key).orderBy("line_no")
    ruled = lines.withColumn("label", F.last(label, ignorenulls=True).over(before)).withColumn("label_line", F.last(F.when(label.isNotNull(), F.col("line_no")), ignorenulls=True).over(before)).withColumn("material", F.last(material, ignorenulls=True).over(before))
    faces = ruled.where(F.lower(command(line)) == "f")
    faces = faces.withColumn("last_section", F.max("label_line").over(W.partitionBy(key, "label"))).where(F.col("label_line").eqNullSafe(F.col("last_section")))
    return faces.select(key, "line_no", "label", "material", F.posexplode(F.transform(after_first(tokens(line)), index)).alias("seq", "c")).select(key, "line_no", "label", "material", "seq", "c.*")


def out_of_range(corners: DataFrame, pool: DataFrame, key: str, idx: str = "pos") -> DataFrame:
    """F16: corners whose index is not in the pool."""
    return corners.where(F.col(idx).isNotNull()).join(pool.select(key, F.col("idx").alias(idx)), [key, idx], "left_anti")


def strict_faces(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, label, seq, pos, tex, norm) of lines `f` in a section, cut at single spaces and by exact commands.

    As in `face_corners` a later section of the same label stands in for the earlier one. A corner of
    more than three parts, or one that is no number, has a null pos.
    """
    line = F.col("line")
    words = tokens(line, strict=True)
    name = F.initcap(F.get(words, F.lit(1)))
    label = F.when(line.startswith("#") & name.isin("Roof", "Wall", "Ground"), name)
    before = W.partitionBy(key).orderBy("line_no")
    ruled = lines.withColumn("label", F.last(label, ignorenulls=True).over(before)).withColumn("label_line", F.last(F.when(label.isNotNull(), F.col("line_no")), ignorenulls=True).over(before))
    ruled = ruled.withColumn("last_section", F.max("label_line").over(W.partitionBy(key, "label")))
    own = ruled.where((F.get(words, F.lit(0)) == "f") & (F.col("label_line") == F.col("last_section")))
    return own.select(key, "line_no", "label", F.posexplode(F.transform(after_first(words), index)).alias("seq", "c")).select(key, "line_no", "label", "seq", "c.*")


def obj_check(lines: DataFrame, key: str) -> DataFrame:
    """(key, missing, n_bad_pos, n_bad_tex, ok): sections that a strict file must have, and indices beyond its pools."""
    line = F.col("line")
    words = tokens(line, strict=True)
    is_ = lambda c: F.get(words, F.lit(0)) == c
    name = F.initcap(F.get(words, F.lit(1)))
    seen = lines.groupBy(key).agg(F.collect_set(F.when(line.startswith("#"), name)).alias("sections"))
    missing = F.array_join(F.filter(F.array(F.lit("Roof"), F.lit("Wall"), F.lit("Ground")), lambda s: ~F.array_contains("sections", s)), ",")
    pool = lambda c: lines.where(is_(c)).select(key, F.row_number().over(W.partitionBy(key).orderBy("line_no")).alias("idx"))
    corners = strict_faces(lines, key)
    bad = lambda idx, c: out_of_range(corners, pool(c), key, idx).groupBy(key).agg(F.count("*").alias(f"n_bad_{idx}"))
    both = seen.select(key, missing.alias("missing")).join(bad("pos", "v"), key, "left").join(bad("tex", "vt"), key, "left").fillna(0, ["n_bad_pos", "n_bad_tex"])
    return both.withColumn("ok", (F.col("missing") == "") & (F.col("n_bad_pos") == 0) & (F.col("n_bad_tex") == 0))


def textured_faces(lines: DataFrame, key: str, least: int = 0) -> DataFrame:
    """(key, line_no, line, material, seq, pos, tex, norm) of faces whose corners all have a texture.

    Commands in any case; the raw line is kept. least: faces of fewer corners are left out, 3 for walls.
    """
    line = F.col("line")
    material = F.when(F.lower(command(line)) == "usemtl", F.get(tokens(line), F.lit(1)))
    ruled = lines.withColumn("material", F.last(material, ignorenulls=True).over(W.partitionBy(key).orderBy("line_no")))
    own = ruled.where(F.lower(command(line)) == "f").withColumn("corners", F.transform(after_first(tokens(line)), index))
    own = own.where((F.size("corners") >= max(1, least)) & F.forall("corners", lambda c: c["tex"].isNotNull()))
    return own.select(key, "line_no", "line", "material", F.posexplode("corners").alias("seq", "c")).select(key, "line_no", "line", "material", "seq", "c.*")


def placed_corners(corners: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Corners with the point (x, y, z) of their pos and the texture place (u, v) of their tex; corners beyond the pools go."""
    points = vertices(lines, key).withColumnRenamed("idx", "pos")
    return corners.join(points, [key, "pos"]).join(vertices(lines, key, "vt").withColumnRenamed("idx", "tex"), [key, "tex"])


def material_errors(lines: DataFrame, key: str) -> DataFrame:
    """(key, line_no, problem) of lines that a strict reader refuses: other than two words, or a texture before any material."""
    line = F.col("line")
    words = F.filter(F.split(line, r"\s+"), lambda t: t != "")
    what = F.get(words, F.lit(0))
    begun = F.coalesce(F.max(F.when(what == "newmtl", 1)).over(W.partitionBy(key).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ruled = lines.withColumn("begun", begun)
    problem = F.when(what.isin("newmtl", "map_Kd") & (F.size(words) != 2), "words").when((what == "map_Kd") & (F.col("begun") == 0), "no material")
    return ruled.select(key, "line_no", problem.alias("problem")).where("problem is not null")


def first_textures(lines: DataFrame, mtl_lines: DataFrame, key: str, mtl: str) -> DataFrame:
    """(key, map_kd): the first texture of the material file that an OBJ's first mtllib line names; null where there is none."""
    line = F.col("line")
    named = lines.where(F.lower(line).startswith("mtllib ")).groupBy(key).agg(F.min(F.struct("line_no", F.regexp_extract(F.trim(line), r"^\S+\s+(.*)$", 1).alias("name")))["name"].alias(mtl))
    found = mtl_lines.where(F.lower(command(line)) == "map_kd").groupBy(mtl).agg(F.min(F.struct("line_no", F.regexp_extract(F.trim(line), r"^\S+\s+(.*)$", 1).alias("m")))["m"].alias("map_kd"))
    return lines.select(key).distinct().join(named, key, "left").join(found, mtl, "left").select(key, "map_kd")


def materials(lines: DataFrame, key: str, keep: str = "last") -> DataFrame:
    """(key, name, map_kd), one row for each material name that has a texture.

    The texture line belongs to the `newmtl` before it. keep "first" takes a name's first texture,
    "last" the last; names of several blocks count as one.
    """
    line = F.col("line")
    word = F.get(tokens(line), F.lit(1))
    name = F.last(F.when(F.lower(command(line)) == "newmtl", word), ignorenulls=True).over(W.partitionBy(key).orderBy("line_no"))
    own = lines.withColumn("name", name).where((F.lower(command(line)) == "map_kd") & F.col("name").isNotNull()).withColumn("map_kd", word)
    pick = F.min if keep == "first" else F.max
    return own.groupBy(key, "name").agg(pick(F.struct("line_no", "map_kd"))["map_kd"].alias("map_kd"))


def textures(lines: DataFrame, key: str) -> DataFrame:
    """Distinct texture paths of each file."""
    return lines.where(F.lower(command(F.col("line"))) == "map_kd").select(key, F.get(tokens(F.col("line")), F.lit(1)).alias("map_kd")).distinct()


def textured(corners: DataFrame, materials_: DataFrame, key: str, whole_object: bool = False) -> DataFrame:
    """Textured corners with their material's path; whole_object gives all faces the file's last material."""
    c = corners.where("tex is not null")
    if whole_object:
        last = corners.groupBy(key).agg(F.max(F.struct("line_no", "material"))["material"].alias("material"))
        c = c.drop("material").join(last, key)
    return c.join(materials_.withColumnRenamed("name", "material"), [key, "material"], "left")


ORIENTATION = "file string, x string, y string, z string, omega string, phi string, kappa string"


def orientation(spark: SparkSession, path: str) -> DataFrame:
    """Exterior orientation; ok is false where a column is empty or no number."""
    return check_orientation(spark.read.csv(path, sep="\t", header=True, schema=ORIENTATION))


def check_orientation(raw: DataFrame) -> DataFrame:
    n = ["x", "y", "z", "omega", "phi", "kappa"]
    cast = raw.select("file", *[F.col(c).try_cast("double").alias(c) for c in n])
    ok = F.coalesce(F.trim("file") != "", F.lit(False))
    for c in n:
        ok = ok & F.col(c).isNotNull()
    return cast.withColumn("ok", ok)


def camera(spark: SparkSession, path: str) -> DataFrame:
    """The first row of a camera file; calibrated where exactly three further columns are filled.

    shift_x, shift_y, cubic, quintic are the columns that the radial correction reads (Q11): those
    numbered 4 to 7 from 0.
    """
    return camera_rows(file_lines(spark, path), "stem").drop("stem")


def camera_rows(lines: DataFrame, key: str) -> DataFrame:
    """The camera of each file's lines; `complete` says that the first seven columns are filled."""
    lines = lines.where("line_no = 1")
    cells = F.transform(F.split("line", "\t"), lambda t: F.trim(t))
    n = lambda i: F.get(cells, F.lit(i)).try_cast("double")
    extra = F.size(F.filter(cells, lambda t, i: (i > 6) & (t != "")))
    complete = (F.size(cells) >= 7) & F.forall(F.filter(cells, lambda _, i: i < 7), lambda t: t != "")
    names = ["f", "sensor_w", "sensor_h", "pixel_x", "pixel_y", "ppx", "ppy"]
    return lines.select(key, complete.alias("complete"), *[n(i).alias(c) for i, c in enumerate(names)], (extra == 3).alias("calibrated"), n(4).alias("shift_x"), n(5).alias("shift_y"), n(6).alias("cubic"), n(7).alias("quintic"))


def images(spark: SparkSession, path: str) -> DataFrame:
    """Raster images as BGR bytes; files that can't be decoded are left out."""
    return spark.read.format("image").option("dropInvalid", True).load(path).select("image.*")


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """Image files of a folder by suffix, whatever its case."""
    return spark.read.format("binaryFile").load(path).where(is_image(F.col("path")))


def is_image(path: Column) -> Column:
    return path.rlike(r"(?i)\.(tif|tiff|jpg|jpeg|png)$")


def opened(orientation_: DataFrame, camera_: DataFrame, images_: DataFrame) -> DataFrame:
    """Photos: a usable orientation, the image of that name (file, w, h) and the one camera.

    A sensor side is the image's size times the pixel's, if the image's width times it comes within
    1 % of either side that the camera names (also for the height, Q17); else it is null and nothing
    is seen in the photo.
    """
    close = lambda a, b: F.abs(a - b) <= F.lit(0.01) * F.greatest(F.abs(a), F.abs(b))
    c = camera_.select("f", F.col("sensor_w").alias("_cw"), F.col("sensor_h").alias("_ch"), "pixel_x", "pixel_y", "ppx", "ppy", "calibrated", "shift_x", "shift_y", "cubic", "quintic")
    p = orientation_.where("ok").join(images_.select("file", "w", "h"), "file").crossJoin(F.broadcast(c.limit(1)))
    fits = lambda px: close(F.col("w") * F.col(px) / F.lit(1e3), F.col("_cw")) | close(F.col("w") * F.col(px) / F.lit(1e3), F.col("_ch"))
    return p.withColumns({"sensor_w": F.when(fits("pixel_x"), F.col("w") * F.col("pixel_x") / F.lit(1e3)), "sensor_h": F.when(fits("pixel_y"), F.col("h") * F.col("pixel_y") / F.lit(1e3))}).drop("_cw", "_ch")


def without_image(orientation_: DataFrame, images_: DataFrame) -> DataFrame:
    """Orientation rows whose image is missing."""
    return orientation_.where("ok").join(images_.select("file"), "file", "left_anti").select("file")


def world_file(lines: DataFrame, key: str) -> DataFrame:
    """The affine (a, b, c, d, e, f) of a world file's six lines, pixel corner based."""
    n = F.collect_list(F.struct("line_no", F.col("line").try_cast("double").alias("x")))
    v = lines.where("trim(line) <> ''").groupBy(key).agg(F.transform(F.array_sort(n), lambda s: s["x"]).alias("n"))
    g = lambda i: F.get("n", F.lit(i))
    return v.select(key, g(0).alias("a"), g(2).alias("b"), (g(4) - g(0) / 2 - g(2) / 2).alias("c"), g(1).alias("d"), g(3).alias("e"), (g(5) - g(1) / 2 - g(3) / 2).alias("f"))


def inverse_affine(world: DataFrame) -> DataFrame:
    """World-file affines with the inverse (ia, ib, ic, id_, ie, if_) that leads a place to a pixel."""
    det = F.col("a") * F.col("e") - F.col("b") * F.col("d")
    w = world.withColumn("_det", det)
    d = lambda c: F.try_divide(c, F.col("_det"))
    w = w.withColumns({"ia": d(F.col("e")), "ib": d(-F.col("b")), "id_": d(-F.col("d")), "ie": d(F.col("a"))})
    return w.withColumns({"ic": -(F.col("ia") * F.col("c") + F.col("ib") * F.col("f")), "if_": -(F.col("id_") * F.col("c") + F.col("ie") * F.col("f"))}).drop("_det")


def georeferenced(world: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Rasters of known affine and size (w, h), with their inverse and bounds (l, b, r, t) from all four corners."""
    g = inverse_affine(world).join(sizes.select(key, "w", "h"), key)
    at = lambda m, n, o, i, j: F.col(m) * i + F.col(n) * j + F.col(o)
    ends = [(F.lit(0e0), F.lit(0e0)), (F.col("w"), F.lit(0e0)), (F.lit(0e0), F.col("h")), (F.col("w"), F.col("h"))]
    x, y = [at("a", "b", "c", i, j) for i, j in ends], [at("d", "e", "f", i, j) for i, j in ends]
    return g.withColumns({"l": F.least(*x), "r": F.greatest(*x), "b_": F.least(*y), "t": F.greatest(*y)})


def image_uris(xml: DataFrame, column: str = "xml") -> DataFrame:
    """The texture addresses of a city model, each with the flag that it is not yet handled."""
    return xml.select(F.explode(F.expr(f"xpath({column}, \"//*[local-name()='imageURI']/text()\")")).alias("uri")).distinct().withColumn("handled", F.lit(False))


def json_log(lines: DataFrame, schema: str, column: str = "line") -> DataFrame:
    """The records of a log of JSON lines; lines that are none are left out."""
    parsed = lines.withColumn("_r", F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.where(F.get_json_object(column, "$").isNotNull()).select("*", "_r.*").drop("_r")


def candidate_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """(id, name, path) of files {any folders}/{id}/{name}, the first path of each, as a recursive lookup finds it."""
    p = F.col(column)
    own = paths.select(F.regexp_extract(p, r"([^/]+)/[^/]+$", 1).alias("id"), file_name(p).alias("name"), p.alias("path")).where("id <> ''")
    return own.groupBy("id", "name").agg(F.min("path").alias("path"))


def buildings(spark: SparkSession, text: str) -> DataFrame:
    """The building list `buildings: [{id, roof_class}]`."""
    import yaml

    rows = [(str(b.get("id")), b.get("roof_class")) for b in (yaml.safe_load(text) or {}).get("buildings") or []]
    return spark.createDataFrame(rows, "id string, roof_class string")


def first_candidates(request: DataFrame, files: DataFrame) -> DataFrame:
    """The file of each request by priority; class `others` may be one of two names in turn, the rest one. Null where none exists."""
    names = F.when(F.col("roof_class") == "others", F.array(F.lit("lod2"), F.lit("lod1"))).otherwise(F.array(F.lit("lod2")))
    wanted = request.select("req_id", F.posexplode(names).alias("rank", "name"))
    found = wanted.join(files, ["req_id", "name"]).groupBy("req_id").agg(F.min(F.struct("rank", "name"))["name"].alias("name"))
    return request.select("req_id").join(found, "req_id", "left")
