"""Queries on frontal views, atlases, the choice of images for level walls, and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.geometry import lit
from ..operators import faces, imaging, packing, raster, rectify
from ..sources import fixtures
from .registry import _HIDE, _KIND, _MSEEN, _PLANE, FACE, _placed, _r, _rings, query

# --- level walls ---

_LEVEL = _KIND.replace("then 'Ground' when", "then 'Wall' when")
_LEVEL_HIDE = _HIDE.replace(_KIND, _LEVEL)


@query(f"""with {_LEVEL_HIDE}, {_MSEEN}, p3 as (select bldg_id, face_no, max(x) filter (seq=0) x0, max(y) filter (seq=0) y0, max(z) filter (seq=0) z0, max(x) filter (seq=1) x1, max(y) filter (seq=1) y1, max(z) filter (seq=1) z1, max(x) filter (seq=2) x2, max(y) filter (seq=2) y2, max(z) filter (seq=2) z2 from corner group by all),
v3 as (select bldg_id, face_no, (y1-y0)*(z2-z0) - (z1-z0)*(y2-y0) a, (z1-z0)*(x2-x0) - (x1-x0)*(z2-z0) b, (x1-x0)*(y2-y0) - (y1-y0)*(x2-x0) c from p3),
flat as (select bldg_id, face_no from v3 join kind using (bldg_id, face_no) where element = 'Wall' and sqrt(a*a+b*b+c*c) > 1e-6 and abs(c / sqrt(a*a+b*b+c*c)) > 9e-1),
both_ as (select bldg_id, wall_no as face_no, photo_id, false is_ortho, area, area weighted, photo_id o from hid where not hidden union all select bldg_id, face_no, null, true, area, area * 2e0, -1 from mseen join flat using (bldg_id, face_no) where n_in = n and area > 0),
k as (select *, row_number() over (partition by bldg_id, face_no order by weighted desc, o desc) k from both_)
select bldg_id, face_no, photo_id, is_ortho, round(area, 4) area from k where k = 1""", "corner", "photo", "ortho")
def level_wall_image(spark, sf_dir):
    """Photo or mosaic for every wall, where ground faces count as level walls."""
    classed = faces.classify(_rings(spark, sf_dir)).withColumn("element", F.when(F.col("element") == "Ground", "Wall").otherwise(F.col("element")))
    made = imaging.wall_images(classed, faces.adjacency(classed), fixtures.table(spark, sf_dir, "photo"), fixtures.table(spark, sf_dir, "ortho"))
    return made.select(*FACE, "photo_id", "is_ortho", _r("area", 4).alias("area"))


# --- atlases ---

_POWER = "list_min(list_filter([1,2,4,8,16,32,64,128,256,512,1024,2048,4096,8192,16384,32768,65536,131072], lambda p: p >= {0}))"
_NUM = f"""{_HIDE}, roofs as (select s.bldg_id, s.face_no, s.photo_id, s.area, 0 kd, row_number() over (partition by s.bldg_id, s.face_no order by area desc, photo_id desc) k from seen s join kind using (bldg_id, face_no) where element = 'Roof' and n_in = n),
walls as (select bldg_id, wall_no as face_no, photo_id, area, 1 kd, row_number() over (partition by bldg_id, wall_no order by area desc, photo_id desc) k from hid where not hidden),
chosen as (select * from roofs where k = 1 union all select * from walls where k = 1),
ord as (select *, kd * 100 + face_no use_, min(kd * 100 + face_no) over (partition by bldg_id, photo_id) fu from chosen),
num as (select *, row_number() over (partition by bldg_id order by fu, use_) i from ord)"""


@query(f"""with {_NUM}, b0 as (select n.bldg_id, n.face_no, n.photo_id, n.i, n.area, cast(floor(s.u0) as bigint) a, cast(floor(s.v0) as bigint) b, cast(ceil(s.u1) as bigint) c, cast(ceil(s.v1) as bigint) d, s.w iw, s.h ih from num n join seen s on s.bldg_id = n.bldg_id and s.face_no = n.face_no and s.photo_id = n.photo_id),
b1 as (select *, case when a >= 2 and b >= 2 and c + 2 < iw and d + 2 < ih then 2 else 0 end m from b0),
it as materialized (select bldg_id, face_no, photo_id, i, area, a - m min_x, b - m min_y, c - a + 1 + 2 * m w, d - b + 1 + 2 * m h from b1),
f1 as (select bldg_id, cast(0 as bigint) i, cast(0 as bigint) x, cast(0 as bigint) y, cast(0 as bigint) hi, cast(0 as bigint) wide from it where i = 1 union all
  select f.bldg_id, it.i, case when 4096 < x + w then w else x + w end, case when 4096 < x + w then y + hi else y end, case when 4096 < x + w then h else greatest(hi, h) end, greatest(wide, case when 4096 < x + w then w else x + w end) from f1 f join it on it.bldg_id = f.bldg_id and it.i = f.i + 1),
sz as materialized (select bldg_id, {_POWER.format('arg_max(wide, i)')} atlas_w, {_POWER.format('(arg_max(y, i) + arg_max(hi, i))')} atlas_h from f1 group by bldg_id),
f2 as (select bldg_id, cast(0 as bigint) i, cast(0 as bigint) x, cast(0 as bigint) y, cast(0 as bigint) hi, cast(0 as bigint) px, cast(0 as bigint) p_y from it where i = 1 union all
  select f.bldg_id, it.i, case when atlas_w < x + w then w else x + w end, case when atlas_w < x + w then y + hi else y end, case when atlas_w < x + w then h else greatest(hi, h) end, case when atlas_w < x + w then 0 else x end, case when atlas_w < x + w then y + hi else y end from f2 f join it on it.bldg_id = f.bldg_id and it.i = f.i + 1 join sz on sz.bldg_id = f.bldg_id)
select it.bldg_id, it.face_no, it.photo_id, cast(p.seq as int) seq, f2.px off_x, f2.p_y off_y, cast(atlas_w as bigint) atlas_w, cast(atlas_h as bigint) atlas_h, round((p.u - min_x + f2.px) / atlas_w, 6) u, round(abs((p.v - min_y + f2.p_y) / atlas_h - 1), 6) v
from it join f2 on f2.bldg_id = it.bldg_id and f2.i = it.i join sz on sz.bldg_id = it.bldg_id join pr p on p.bldg_id = it.bldg_id and p.face_no = it.face_no and p.photo_id = it.photo_id where it.area <> 0""", "corner", "photo")
def atlas_uv(spark, sf_dir):
    """The whole mapping stage, from corners to texture coordinates."""
    p = _placed(spark, sf_dir)
    return p.select(*FACE, "photo_id", "off_x", "off_y", "atlas_w", "atlas_h", F.posexplode("uv").alias("seq", "t")).select(*FACE, "photo_id", "seq", "off_x", "off_y", "atlas_w", "atlas_h", _r("t.u").alias("u"), _r("t.v").alias("v"))


@query(f"with {_NUM} select distinct bldg_id, photo_id, false is_ortho from num where area <> 0", "corner", "photo")
def atlas_images(spark, sf_dir):
    """The distinct images of each building."""
    return _placed(spark, sf_dir).select("bldg_id", "photo_id", "is_ortho").distinct()


@query("select bldg_id, face_no, cast(seq as int) seq, round((sx + 3e0) / 64, 6) u, round((128 - (sy + 5e0)) / 128, 6) v from (select *, x - (p_partkey_x) sx, y - (p_partkey_y) sy from (select c.*, min(x) over (partition by bldg_id, face_no) p_partkey_x, min(y) over (partition by bldg_id, face_no) p_partkey_y from corner c))", "corner")
def rectified_uv(spark, sf_dir):
    """Texture coordinates of pixels placed in a frontal view's atlas, rows counted from the top."""
    from pyspark.sql import Window as W

    face = W.partitionBy(*FACE)
    c = fixtures.table(spark, sf_dir, "corner").withColumns({"px": F.col("x") - F.min("x").over(face), "p_y": F.col("y") - F.min("y").over(face)})
    u, v = packing.rectified_uv(F.col("px") + lit(3), F.col("p_y") + lit(5), lit(64), lit(128))
    return c.select(*FACE, F.col("seq").cast("int").alias("seq"), _r(u).alias("u"), _r(v).alias("v"))


_WIDE_PLANE = _PLANE.replace("625e-2", "637e-2").replace(" + 8 d", " + 8e0 d")


@query(f"""with {_WIDE_PLANE}, e as (select bldg_id, face_no, min(dx) x0, min(dy) y0, max(dx) x1, max(dy) y1 from dst group by all), w as (select *, cast(floor(x1 + 4) as int) win_w, cast(floor(y1 + 4) as int) win_h from e)
select bldg_id, face_no, true as real, win_w, win_h, greatest(cast(floor(x0 + 1e-9) as int) - 4, 0) crop_x0, greatest(cast(floor(y0 + 1e-9) as int) - 4, 0) crop_y0, least(cast(ceil(x1) as int) + 4, win_w) crop_x1, least(cast(ceil(y1) as int) + 4, win_h) crop_y1 from w
union all select distinct bldg_id, 9, false, 1, 1, 0, 0, 1, 1 from corner""", "tex_corner")
def crop_windows(spark, sf_dir):
    """Image sizes and crop windows; a face of one point gets a placeholder of one pixel."""
    t = fixtures.table(spark, sf_dir, "tex_corner")
    point = t.where("face_no = 0").withColumns({"face_no": F.lit(9), "x": lit(1), "y": lit(2), "z": lit(3)})
    r = rectify.rectified(t.unionByName(point), ppm=6.37)
    return r.select(*FACE, "real", "win_w", "win_h", "crop_x0", "crop_y0", "crop_x1", "crop_y1")


@query("select bldg_id, face_no, cast(floor(min(su) * 8) as int) start_x, cast(floor((1 - max(sv) / 64) * 256) as int) start_y, cast(ceil(max(su) * 8) as int) end_x, cast(ceil((1 - min(sv) / 64) * 256) as int) end_y from tex_corner group by all", "tex_corner")
def uv_boxes(spark, sf_dir):
    """Where each wall's ring begins and ends in an atlas of 512 x 256."""
    t = fixtures.table(spark, sf_dir, "tex_corner").selectExpr(*FACE, "seq", "su / 64e0 u", "sv / 64e0 v").groupBy(*FACE).agg(g.pack("seq", "u", "v").alias("uv"))
    return rectify.uv_box(t, 512, 256).select(*FACE, "start_x", "start_y", "end_x", "end_y")


@query("select bldg_id, cast(row_number() over (partition by bldg_id order by face_no) - 1 as int) place, face_no, rw, case when face_no < 4 then rh end rh from rect_size where face_no between 1 and 4", "rect_size")
def wall_logs(spark, sf_dir):
    """A building's lists of walls, widths and heights, joined by their place; the last is one shorter."""
    by_face = lambda c, n: F.transform(F.array_sort(F.collect_list(F.when(F.col("face_no") <= n, F.struct("face_no", F.col(c).alias("v"))))), lambda s: s["v"]).alias(c)
    lists = fixtures.table(spark, sf_dir, "rect_size").where("face_no between 1 and 4").withColumn("no", F.col("face_no")).groupBy("bldg_id").agg(by_face("no", 4), by_face("rw", 4), by_face("rh", 3))
    return faces.zip_lists(lists.withColumnRenamed("no", "face"), "bldg_id", "face", "rw", "rh").withColumnRenamed("face", "face_no")


@query("""with c as (select bldg_id, face_no, seq, round_even(x + seq * 25e-2, 0) x, round_even(y, 0) y, round_even(z, 0) z from corner), f as (select bldg_id, x, y, z, min(face_no * 100 + seq) o from c group by all), k as (select *, row_number() over (partition by bldg_id order by o) v_idx from f)
select c.bldg_id, c.face_no, c.seq, x, cast(v_idx as int) v_idx from c join k using (bldg_id, x, y, z)""", "corner")
def vertex_dedup_rounded(spark, sf_dir):
    """Vertices that fall together when rounded half to even."""
    c = fixtures.table(spark, sf_dir, "corner").withColumn("x", F.col("x") + F.col("seq") * lit(0.25))
    return faces.dedup_vertices(c, 0).select(*FACE, "seq", "x", "v_idx")


@query("select bldg_id, face_no, cast(count(*) as int) n, true fits from tex_corner group by all", "tex_corner")
def homography(spark, sf_dir):
    """For every face the map from its texture to its own plane, which leads its corners to their places."""
    import numpy as np

    def fit(batches):
        for pdf in batches:
            fits = []
            for r, plane in zip(pdf["ring"], pdf["plane"]):
                src, dst = np.array([[p["su"], p["sv"]] for p in r]), np.array([[p["x"], p["z"]] for p in plane])
                q = np.hstack([src, np.ones((len(src), 1))]) @ raster.homography(src, dst).T
                fits.append(bool(np.abs(q[:, :2] / q[:, 2:] - dst).max() < 1e-6))
            yield pdf[["bldg_id", "face_no"]].assign(n=[len(r) for r in pdf["ring"]], fits=fits)

    t = fixtures.table(spark, sf_dir, "tex_corner").groupBy(*FACE).agg(g.pack("seq", "x", "y", "z", "su", "sv").alias("ring"))
    return g.to_plane(t).select(*FACE, "ring", "plane").mapInPandas(fit, "bldg_id long, face_no int, n int, fits boolean")


# --- pixels ---

_PX = "px as (select vec_id, cast(floor((i-1)/8e0) as int) y, cast((i-1)%8 as int) x, c, (cast(trunc(greatest(least((cast(embedding[i] as double)+1)/2*255, 255e0), 0e0)) as int) + c*40) % 256 v from (select vec_id, embedding, unnest(range(1,65)) i from embeddings), (select unnest([0,1,2]) c))"


def _grid(h: int, w: int) -> str:
    return f"gr as (select vec_id, y, x, c from (select vec_id from embeddings), (select unnest(range(0, {h})) y), (select unnest(range(0, {w})) x), (select unnest([0, 1, 2]) c))"


def _hex(h: int, w: int, out: str) -> str:
    """SQL of whole images, as the hex digits of their bytes, from the (vec_id, y, x, c, v) of `out`."""
    return f"with {_PX}, {_grid(h, w)}, res as ({out}) select vec_id, {h} height, {w} width, string_agg(printf('%02X', cast(v as int)), '' order by y, x, c) pixels from res group by vec_id"


def _images(spark, sf_dir) -> DataFrame:
    """Every 8 x 8 patch as an image of three channels."""

    def draw(batches):
        import numpy as np

        for pdf in batches:
            data = []
            for v in pdf["embedding"]:
                b = np.trunc(np.clip((np.asarray(v, dtype=np.float64) + 1) / 2 * 255, 0, 255)).astype(int).reshape(8, 8, 1)
                data.append(((b + np.array([0, 40, 80])) % 256).astype(np.uint8).tobytes())
            yield pdf[["vec_id"]].assign(height=8, width=8, channels=3, data=data)

    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").mapInPandas(draw, f"vec_id long, {raster.IMAGE}")


def _made(spark, sf_dir, f, rows: bool = False) -> DataFrame:
    return raster.map_images(_images(spark, sf_dir), f, "vec_id long", rows).select("vec_id", "height", "width", F.hex("data").alias("pixels"))


@query(_hex(9, 10, "select gr.*, coalesce(px.v, 255) v from gr left join px on px.vec_id = gr.vec_id and px.c = gr.c and px.x = gr.x - 2 and px.y = gr.y + 3").replace("'%02X'", "'%02X'"))
def image_window(spark, sf_dir):
    """A patch that reaches beyond the image is white there."""
    return _made(spark, sf_dir, lambda image: raster.window(image, -2, 3, 10, 9))


@query(_hex(12, 12, "select gr.*, coalesce(b.v, a.v, 255) v from gr left join px a on a.vec_id = gr.vec_id and a.c = gr.c and a.x = gr.x - 1 and a.y = gr.y - 1 left join px b on b.vec_id = gr.vec_id and b.c = gr.c and b.x = gr.x - 5 and b.y = gr.y - 6"))
def image_assemble(spark, sf_dir):
    """Parts on white, the later over the earlier, cut at the edge."""
    return _made(spark, sf_dir, lambda image: raster.assemble([(1, 1, image), (5, 6, image)], 12, 12))


_RING = "ed(ax, ay, bx, b_y) as (values (1e0, 1e0, 6e0, 1e0), (6e0, 1e0, 6e0, 6e0), (6e0, 6e0, 1e0, 5e0), (1e0, 5e0, 1e0, 1e0))"
_INSIDE = """select y, x, (count(*) filter ((ay > y) <> (b_y > y) and x < (bx - ax) * (y - ay) / nullif(b_y - ay, 0) + ax) % 2 = 1) or min(sqrt(pow(x - ax - t * (bx - ax), 2) + pow(y - ay - t * (b_y - ay), 2))) <= {0} hit
  from (select *, greatest(0e0, least(1e0, ((x - ax) * (bx - ax) + (y - ay) * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) t from (select unnest(range(0, 8)) y), (select unnest(range(0, 8)) x), ed) group by y, x"""


@query(_hex(8, 8, f"with {_RING}, m as ({_INSIDE.format('5e-1')}) select gr.*, case when hit then px.v else 255 end v from gr join px using (vec_id, y, x, c) join m using (y, x)"))
def image_mask(spark, sf_dir):
    """White outside a ring whose corners are cut to whole pixels."""
    ring = [[1.7, 1.2], [6.9, 1.9], [6.1, 6.8], [1.0, 5.0]]
    return _made(spark, sf_dir, lambda image: raster.cut_out(image, ring, 0, 0, 8, 8))


@query(_hex(8, 8, "with m as (select a.vec_id, a.y, a.x, bool_or(b.v > 128) hit from px a join px b on b.vec_id = a.vec_id and a.c = 0 and b.c = 0 and abs(a.x - b.x) <= 2 and abs(a.y - b.y) <= 2 group by all) select px.vec_id, y, x, c, case when hit then v else 255 end v from px join m using (vec_id, y, x)"))
def image_dilate(spark, sf_dir):
    """White but for what lies near a bright pixel."""
    return _made(spark, sf_dir, lambda image: raster.compose(image, raster.dilate(image[:, :, 0] > 128, 5)))


@query(_hex(8, 8, "select a.vec_id, a.y, a.x, c, trunc(m) v from (select vec_id, y, x, sum(v) / 3e0 m from px group by all) a, (select unnest([0, 1, 2]) c)"))
def image_grey(spark, sf_dir):
    """The mean of the channels in all of them."""
    return _made(spark, sf_dir, raster.grey_mean)


@query(_hex(8, 8, "select vec_id, y, 7 - x x, 2 - c c, v from px"))
def image_flip(spark, sf_dir):
    """Turned over, and channels in the other order."""
    return _made(spark, sf_dir, lambda image: raster.swap_channels(raster.flip(image)))


@query(_hex(4, 4, "select vec_id, y - 2 y, x - 3 x, c, v from px where y between 2 and 5 and x between 3 and 6"))
def image_crop(spark, sf_dir):
    """R17."""
    return _made(spark, sf_dir, lambda image: raster.crop(image, 3, 2, 4))


def _at(dy: str, dx: str) -> str:
    """SQL of a pixel of the patch, white outside it."""
    return f"left join px p{dy}{dx} on p{dy}{dx}.vec_id = gr.vec_id and p{dy}{dx}.c = gr.c and p{dy}{dx}.y = gr.y - {dy} and p{dy}{dx}.x = gr.x - {dx}"


@query(_hex(9, 9, "select gr.*, round_even((coalesce(p11.v, 255) * 5e-1 + coalesce(p10.v, 255) * 5e-1) * 25e-2 + (coalesce(p01.v, 255) * 5e-1 + coalesce(p00.v, 255) * 5e-1) * 75e-2, 0) v from gr " + " ".join(_at(y, x) for y in "01" for x in "01")))
def image_warp(spark, sf_dir):
    """Moved by half a pixel and a quarter, bilinear, with a white border."""
    return _made(spark, sf_dir, lambda image: raster.warp(image, [[1, 0, 0.5], [0, 1, 0.25], [0, 0, 1]], 9, 9))


#: Places in a source of n pixels of the pixels of one twice as long, held within it.
_HALF = "greatest(0e0, least({1} - 1e0, ({0} + 5e-1) * 5e-1 - 5e-1))"


def _twice(rows: int, out_h: int) -> str:
    """SQL of the first `rows` rows of the patch at twice the size, black below."""
    sy, sx = _HALF.format("gr.y", f"{rows}e0"), _HALF.format("gr.x", "8e0")
    p = lambda dy, dx: f"join px p{dy}{dx} on p{dy}{dx}.vec_id = s.vec_id and p{dy}{dx}.c = s.c and p{dy}{dx}.y = least(cast(floor(sy) as int) + {dy}, {rows - 1}) and p{dy}{dx}.x = least(cast(floor(sx) as int) + {dx}, 7)"
    inner = f"select s.vec_id, s.y, s.x, s.c, case when s.y < {2 * rows} then round_even((p00.v * (1 - (sx - floor(sx))) + p01.v * (sx - floor(sx))) * (1 - (sy - floor(sy))) + (p10.v * (1 - (sx - floor(sx))) + p11.v * (sx - floor(sx))) * (sy - floor(sy)), 0) else 0 end v"
    return f"{inner} from (select gr.*, {sy} sy, {sx} sx from gr where gr.y < {out_h}) s " + " ".join(p(a, b) for a in (0, 1) for b in (0, 1))


@query(_hex(16, 16, _twice(8, 16)))
def image_resize(spark, sf_dir):
    """Scaled to twice the width, bilinear; both sides are then multiples of four."""
    return _made(spark, sf_dir, lambda image: raster.multiple_of(raster.scale_width(image, 16)))


@query(_hex(16, 16, _twice(4, 16)))
def image_letterbox(spark, sf_dir):
    """A wide image on a square, black below."""
    return _made(spark, sf_dir, lambda image: raster.letterbox(image[:4], 16))


def _there_and_back() -> str:
    """SQL of the patch at four times the size, rounded, and of the mean of the middle four of each sixteen."""
    p = lambda dy, dx: f"join px p{dy}{dx} on p{dy}{dx}.vec_id = s.vec_id and p{dy}{dx}.c = s.c and p{dy}{dx}.y = least(cast(floor(sy) as int) + {dy}, 7) and p{dy}{dx}.x = least(cast(floor(sx) as int) + {dx}, 7)"
    at = "case {0} when 0 then greatest(0e0, {1} - 125e-3) else least(7e0, {1} + 125e-3) end"
    large = f"select s.vec_id, s.y, s.x, s.c, round_even((p00.v * (1 - (sx - floor(sx))) + p01.v * (sx - floor(sx))) * (1 - (sy - floor(sy))) + (p10.v * (1 - (sx - floor(sx))) + p11.v * (sx - floor(sx))) * (sy - floor(sy)), 0) v from (select gr.*, {at.format('i', 'gr.y')} sy, {at.format('j', 'gr.x')} sx from gr, (values (0), (1)) a(i), (values (0), (1)) b(j)) s " + " ".join(p(i, j) for i in (0, 1) for j in (0, 1))
    return f"select vec_id, y, x, c, round_even(sum(v) / 4, 0) v from ({large}) group by vec_id, y, x, c"


@query(_hex(8, 8, _there_and_back()))
def warp_patch(spark, sf_dir):
    """Every patch letterboxed to 32 and taken back."""
    return _made(spark, sf_dir, lambda image: raster.unletterbox(raster.letterbox(image, 32), 8, 8))


@query(_hex(8, 8, "select * from px"))
def image_cut_merge(spark, sf_dir):
    """Cut into overlapping tiles and merged again."""
    return _made(spark, sf_dir, lambda image: raster.merge(raster.cut(image, 4, 0.25), 8, 8))


@query(_hex(16, 16, "select gr.vec_id, gr.y, gr.x, gr.c, case when gr.vec_id % 7 <> 0 then coalesce(px.v, 255) else 255 end v from gr left join px on px.vec_id = gr.vec_id and px.c = gr.c and px.x = gr.x - gr.vec_id % 5 and px.y = gr.y - gr.vec_id % 3"))
def image_paste(spark, sf_dir):
    """A wall over the atlas at its texture place; a part of one pixel is left out."""

    def put(image, k):
        return raster.atlas([(int(k % 5), int(k % 3), image if k % 7 else image[:1, :1])], 16, 16)

    return _made(spark, sf_dir, put, rows=True)


@query(_hex(8, 8, "select * from px"))
def image_back(spark, sf_dir):
    """A frontal wall led back to a square of the same size in an atlas."""
    import numpy as np

    src, dst = np.array([[2, 3], [10, 3], [10, 11], [2, 11.0]]), np.array([[0, 0], [8, 0], [8, 8], [0, 8.0]])
    return _made(spark, sf_dir, lambda image: raster.back_to_atlas(image, src, dst, 16, 16)[2])


@query(_hex(8, 8, "select * from px"))
def image_files(spark, sf_dir):
    """Every patch written as a PNG file and read again."""
    from ..sources import meshes, scratch, sinks

    def encode(batches):
        for pdf in batches:
            yield pdf[[]].assign(name=[f"{k}.png" for k in pdf["vec_id"]], data=[sinks.png(raster.to_array(h, w, c, d)) for h, w, c, d in zip(pdf["height"], pdf["width"], pdf["channels"], pdf["data"])])

    folder = scratch.folder(spark, "images")
    written = sinks.write_files(_images(spark, sf_dir).mapInPandas(encode, "name string, data binary"), folder)
    written.write.format("noop").mode("overwrite").save()
    read = meshes.images(spark, folder)
    return read.select(meshes.stem(F.col("origin")).cast("long").alias("vec_id"), "height", "width", F.hex("data").alias("pixels"))
