"""All queries of the library, each over its whole tables, with the DuckDB SQL that says what it returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.geometry import lit
from ..operators import faces, imaging, packing, rectify, tiles
from ..sources import fixtures, meshes, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
FACE = ["bldg_id", "face_no"]


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Registers a query; views are the derived tables that its SQL starts from."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            text = sql.strip()
            if views:
                head = fixtures.ctes(*views)
                text = head + ", " + text[5:] if text.startswith("with ") else head + " " + text
            _SQL[f.__name__] = text
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return faces.rings(fixtures.table(spark, sf_dir, "corner"))


def _r(c, n: int = 6):
    return F.round(c, n)


# --- SQL that several queries share ---

#: Ring corners with the next and second next ones, cyclic.
_NEXT = """n1 as (select *, coalesce(lead(x) over w, first_value(x) over w) bx, coalesce(lead(y) over w, first_value(y) over w) b_y, coalesce(lead(z) over w, first_value(z) over w) bz
  from corner window w as (partition by bldg_id, face_no order by seq rows between unbounded preceding and unbounded following)),
n2 as (select *, coalesce(lead(bx) over w, first_value(bx) over w) cx, coalesce(lead(b_y) over w, first_value(b_y) over w) cy, coalesce(lead(bz) over w, first_value(bz) over w) cz
  from n1 window w as (partition by bldg_id, face_no order by seq rows between unbounded preceding and unbounded following)),
cr as (select *, (b_y - y) * (cz - bz) - (bz - z) * (cy - b_y) vx, (bz - z) * (cx - bx) - (bx - x) * (cz - bz) vy, (bx - x) * (cy - b_y) - (b_y - y) * (cx - bx) vz from n2)"""
_ROT = """rad as (select *, sin(radians(omega_deg)) so, cos(radians(omega_deg)) co, sin(radians(phi_deg)) sp, cos(radians(phi_deg)) cp, sin(radians(kappa_deg)) sk, cos(radians(kappa_deg)) ck from photo),
rot as (select *, cp*ck r11, -cp*sk r12, sp r13, co*sk + so*sp*ck r21, co*ck - so*sp*sk r22, -so*cp r23, so*sk - co*sp*ck r31, so*ck + co*sp*sk r32, co*cp r33 from rad)"""
_PROJ = _ROT + """,
pr as (select bldg_id, face_no, seq, photo_id, w, h, x, y, z,
  w/2e0 + (ppx - ((x-cx)*r11 + (y-cy)*r21 + (z-cz)*r31) / ((x-cx)*r13 + (y-cy)*r23 + (z-cz)*r33) * f) * w / sensor_w u,
  h - (h/2e0 + (ppy - ((x-cx)*r12 + (y-cy)*r22 + (z-cz)*r32) / ((x-cx)*r13 + (y-cy)*r23 + (z-cz)*r33) * f) * h / sensor_h) v
  from corner cross join rot)"""
_SEEN = _PROJ + """,
nx as (select *, coalesce(lead(u) over k, first_value(u) over k) u2, coalesce(lead(v) over k, first_value(v) over k) v2 from pr
  window k as (partition by bldg_id, face_no, photo_id order by seq rows between unbounded preceding and unbounded following)),
seen as (select bldg_id, face_no, photo_id, count(*) filter (u >= 0 and u < w and v >= 0 and v < h) n_in, count(*) n, abs(sum(u*v2 - u2*v)) / 2 area, min(u) u0, max(u) u1, min(v) v0, max(v) v1, any_value(w) w, any_value(h) h from nx group by all)"""
_KIND = _NEXT + """,
nrm as (select bldg_id, face_no, seq, vz / sqrt(vx*vx + vy*vy + vz*vz) nz from cr where sqrt(vx*vx + vy*vy + vz*vz) > 1e-7),
fn as (select bldg_id, face_no, arg_min(nz, seq) nz from nrm group by all),
lo as (select bldg_id, face_no, min(z) low from corner group by all),
kind as (select bldg_id, face_no, case when abs(nz) > cos(radians(1e0)) and low - ground < 1e-7 then 'Ground' when abs(nz) < sin(radians(1e0)) then 'Wall' else 'Roof' end element
  from fn join (select *, min(low) over (partition by bldg_id) ground from lo) using (bldg_id, face_no))"""


# --- projection and choice of images ---


@query(f"with {_SEEN}, {_KIND}, rk as (select s.*, row_number() over (partition by bldg_id, face_no order by area desc, photo_id desc) k from seen s join kind using (bldg_id, face_no) where element = 'Roof' and n_in = n) select bldg_id, face_no, photo_id, round(area, 4) area from rk where k = 1", "corner", "photo")
def roof_best_photo(spark, sf_dir):
    """For every roof the photo that shows all of it at the most pixels."""
    roofs = faces.classify(_rings(spark, sf_dir)).where("element = 'Roof'")
    seen = imaging.visible(imaging.in_view(roofs, fixtures.table(spark, sf_dir, "photo")))
    return imaging.best(imaging.candidates(seen)).select(*FACE, "photo_id", _r("area", 4).alias("area"))


_R9 = ", ".join(f"round(r{i}{j}, 9) r{i}{j}" for i in (1, 2, 3) for j in (1, 2, 3))


@query(f"with {_ROT} select photo_id, {_R9} from rot", "photo")
def rotation_matrix_xyz(spark, sf_dir):
    """G1."""
    p = imaging.oriented(fixtures.table(spark, sf_dir, "photo"))
    return p.select("photo_id", *[_r(f"r{i}{j}", 9).alias(f"r{i}{j}") for i in (1, 2, 3) for j in (1, 2, 3)])


@query(f"""with {_ROT.split(chr(10))[0].rstrip(',')},
rx as (select photo_id, unnest([1,2,3]) i, unnest([[1e0,0e0,0e0],[0e0,co,-so],[0e0,so,co]]) m from rad),
ry as (select photo_id, unnest([1,2,3]) i, unnest([[cp,0e0,sp],[0e0,1e0,0e0],[-sp,0e0,cp]]) m from rad),
rz as (select photo_id, unnest([1,2,3]) i, unnest([[ck,-sk,0e0],[sk,ck,0e0],[0e0,0e0,1e0]]) m from rad),
zy as (select rz.photo_id, rz.i, list(v order by j) m from (select rz.photo_id, rz.i, j, sum(rz.m[ry.i] * ry.m[j]) v from rz join ry using (photo_id), (select unnest([1,2,3]) j) group by all) rz group by all),
zyx as (select zy.photo_id, zy.i, j, sum(zy.m[rx.i] * rx.m[j]) v from zy join rx using (photo_id), (select unnest([1,2,3]) j) group by all)
select photo_id, {', '.join(f'round(max(v) filter (i = {i} and j = {j}), 9) r{i}{j}' for i in (1, 2, 3) for j in (1, 2, 3))} from zyx group by photo_id""", "photo")
def rotation_matrix_zyx(spark, sf_dir):
    """G1, Q28: the other order, against a plain matrix product."""
    p = imaging.oriented(fixtures.table(spark, sf_dir, "photo"), "zyx")
    return p.select("photo_id", *[_r(f"r{i}{j}", 9).alias(f"r{i}{j}") for i in (1, 2, 3) for j in (1, 2, 3)])


#: One row for each face and photo: the corners' image, by its least and greatest columns and rows.
_ENDS = "select bldg_id, face_no, photo_id, round(min(u), 3) u_min, round(max(u), 3) u_max, round(min(v), 3) v_min, round(max(v), 3) v_max from {0} group by all"


def _ends(ends: DataFrame) -> DataFrame:
    return g.rounded(ends, ["u_min", "u_max", "v_min", "v_max"], 3)


@query(f"with {_PROJ} " + _ENDS.format("pr"), "corner", "photo")
def projected_corners(spark, sf_dir):
    """Every face in every photo."""
    return _ends(imaging.ends(_rings(spark, sf_dir), fixtures.table(spark, sf_dir, "photo")))


@query(f"""with {_ROT}, c as (select bldg_id, face_no, photo_id, w, h, f, sensor_w, sensor_h, ppx, ppy, ((x-cx)*r11 + (y-cy)*r21 + (z-cz)*r31) / ((x-cx)*r13 + (y-cy)*r23 + (z-cz)*r33) a, ((x-cx)*r12 + (y-cy)*r22 + (z-cz)*r32) / ((x-cx)*r13 + (y-cy)*r23 + (z-cz)*r33) b from corner cross join rot),
d as (select *, a - a * (a*a + b*b) * (3e-2 + 1e-3 * (a*a + b*b)) + 1e-3 da, b - b * (a*a + b*b) * (3e-2 + 1e-3 * (a*a + b*b)) + 2e-3 db from c),
pd as (select bldg_id, face_no, photo_id, w/2e0 + (ppx - da * f) * w / sensor_w u, h - (h/2e0 + (ppy - db * f) * h / sensor_h) v from d) {_ENDS.format('pd')}""", "corner", "photo")
def projected_distorted(spark, sf_dir):
    """The same with radial distortion."""
    return _ends(imaging.ends(_rings(spark, sf_dir), fixtures.table(spark, sf_dir, "photo"), (1e-3, 2e-3, 3e-2, 1e-3)))


@query(f"with {_SEEN} select bldg_id, face_no, photo_id, cast(n_in as int) n_in, round(area, 4) area from seen where n_in = n", "corner", "photo")
def polygon_area(spark, sf_dir):
    """A1, A2, F5."""
    return imaging.visible(imaging.in_view(_rings(spark, sf_dir), fixtures.table(spark, sf_dir, "photo"))).select(*FACE, "photo_id", "n_in", _r("area", 4).alias("area"))


@query(f"""with {_SEEN}, bx as (select *, cast(floor(u0) as int) a, cast(floor(v0) as int) b, cast(ceil(u1) as int) c, cast(ceil(v1) as int) d from seen where n_in = n),
m as (select *, case when a >= 2 and b >= 2 and c + 2 < w and d + 2 < h then 2 else 0 end margin from bx)
select bldg_id, face_no, photo_id, margin, a - margin min_x, b - margin min_y, c - a + 1 + 2 * margin box_w, d - b + 1 + 2 * margin box_h from m""", "corner", "photo")
def polygon_bbox(spark, sf_dir):
    """A4, F19."""
    seen = imaging.visible(imaging.in_view(_rings(spark, sf_dir), fixtures.table(spark, sf_dir, "photo")))
    return imaging.boxes(seen).select(*FACE, "photo_id", "margin", "min_x", "min_y", "box_w", "box_h")


_MOSAIC = "mo as (select min(l) l, min(b) b, max(r) r, max(t) t, arg_min(px_x, ortho_id) sx, arg_min(px_y, ortho_id) sy from ortho), mosaic as (select *, cast(round_even((r - l) / sx, 0) as int) mw, cast(round_even((t - b) / sy, 0) as int) mh from mo)"
_MSEEN = _MOSAIC + """, mp as (select bldg_id, face_no, seq, x, y, (x - l) / sx u, (t - y) / sy v, mw, mh, exists (select 1 from ortho o where x between o.l and o.r and y between o.b and o.t) mem from corner cross join mosaic),
mn as (select *, coalesce(lead(u) over k, first_value(u) over k) u2, coalesce(lead(v) over k, first_value(v) over k) v2 from mp window k as (partition by bldg_id, face_no order by seq rows between unbounded preceding and unbounded following)),
mseen as (select bldg_id, face_no, count(*) filter (u >= 0 and u < mw and v >= 0 and v < mh and mem) n_in, count(*) n, abs(sum(u*v2 - u2*v)) / 2 area from mn group by all)"""


@query(f"with {_MSEEN} select bldg_id, face_no, cast(n_in as int) n_in, round(area, 4) area from mseen", "corner", "ortho")
def ortho_visibility(spark, sf_dir):
    """J2 G5 F4 J10 A10."""
    seen = imaging.in_mosaic(_rings(spark, sf_dir), fixtures.table(spark, sf_dir, "ortho"))
    return seen.select(*FACE, "n_in", _r(g.plane_area(F.col("image")), 4).alias("area"))


@query(f"""with {_SEEN}, {_MSEEN}, {_KIND}, c as (select bldg_id, face_no, photo_id, false is_ortho, area, area weighted, photo_id o from seen where n_in = n union all select bldg_id, face_no, null, true, area, area * 2e0, -1 from mseen where n_in = n),
k as (select c.*, element, row_number() over (partition by bldg_id, face_no order by weighted desc, o desc) k from c join kind using (bldg_id, face_no) where element = 'Roof')
select bldg_id, face_no, photo_id, is_ortho, round(area, 4) area from k where k = 1""", "corner", "photo", "ortho")
def best_image_with_ortho(spark, sf_dir):
    """Photo or mosaic for every roof."""
    roofs = faces.classify(_rings(spark, sf_dir)).where("element = 'Roof'")
    photos = imaging.visible(imaging.in_view(roofs, fixtures.table(spark, sf_dir, "photo")))
    orthos = imaging.visible(imaging.in_mosaic(roofs, fixtures.table(spark, sf_dir, "ortho")))
    return imaging.best(imaging.candidates(photos, orthos)).select(*FACE, "photo_id", "is_ortho", _r("area", 4).alias("area"))


# --- faces ---


@query(f"with {_NEXT}, u as (select bldg_id, face_no, seq, vx, vy, vz, sqrt(vx*vx + vy*vy + vz*vz) n from cr) select bldg_id, face_no, sum(vx) sx, sum(vy) sy, sum(vz) sz, round(arg_min(vx / n, seq) filter (n > 1e-7), 9) nx, round(arg_min(vy / n, seq) filter (n > 1e-7), 9) ny, round(arg_min(vz / n, seq) filter (n > 1e-7), 9) nz from u group by all", "corner")
def face_normals(spark, sf_dir):
    """A6 A7 W1 W2."""
    return faces.normals(_rings(spark, sf_dir)).select(*FACE, "sx", "sy", "sz", *[_r(c, 9).alias(c) for c in ("nx", "ny", "nz")])


@query(f"with {_KIND} select * from kind", "corner")
def face_class(spark, sf_dir):
    """F9 A5."""
    return faces.classify(_rings(spark, sf_dir)).select(*FACE, "element")


@query(f"with {_KIND} select element, count(*) n from kind group by all", "corner")
def element_counts(spark, sf_dir):
    """F1 A17."""
    return faces.classify(_rings(spark, sf_dir)).groupBy("element").agg(F.count("*").alias("n"))


@query(f"with {_NEXT} select bldg_id, face_no, abs(sum(vz) / sqrt(sum(vx)*sum(vx) + sum(vy)*sum(vy) + sum(vz)*sum(vz))) > 2e-2 is_roof from cr group by all", "corner")
def roof_wall_split(spark, sf_dir):
    """F11."""
    return faces.split_roofs(_rings(spark, sf_dir)).select(*FACE, "is_roof")


@query(f"""with p as (select bldg_id, face_no, max(x) filter (seq=0) x0, max(y) filter (seq=0) y0, max(z) filter (seq=0) z0, max(x) filter (seq=1) x1, max(y) filter (seq=1) y1, max(z) filter (seq=1) z1, max(x) filter (seq=2) x2, max(y) filter (seq=2) y2, max(z) filter (seq=2) z2 from corner group by all),
v as (select bldg_id, face_no, (y1-y0)*(z2-z0) - (z1-z0)*(y2-y0) a, (z1-z0)*(x2-x0) - (x1-x0)*(z2-z0) b, (x1-x0)*(y2-y0) - (y1-y0)*(x2-x0) c from p)
select bldg_id, face_no, sqrt(a*a+b*b+c*c) > 1e-6 and abs(c / sqrt(a*a+b*b+c*c)) > 9e-1 is_level from v""", "corner")
def horizontal_walls(spark, sf_dir):
    """F7."""
    return faces.level_faces(_rings(spark, sf_dir)).select(*FACE, "is_level")


@query("""with f as (select bldg_id, x, y, z, min(face_no * 100 + seq) o from corner group by all), k as (select *, row_number() over (partition by bldg_id order by o) v_idx from f)
select c.bldg_id, c.face_no, c.seq, cast(v_idx as int) v_idx from corner c join k using (bldg_id, x, y, z)""", "corner")
def vertex_dedup(spark, sf_dir):
    """A13 C16 J4."""
    return faces.dedup_vertices(fixtures.table(spark, sf_dir, "corner")).select(*FACE, "seq", "v_idx")


#: Rings with repeated corners and a closing one, to be cleaned.
_DIRTY = "dirty as (select bldg_id, face_no, seq * 10 seq, x, y, z from corner union all select bldg_id, face_no, seq * 10 + 1, x, y, z from corner where (bldg_id + seq) % 3 = 0 union all select bldg_id, face_no, 99, x, y, z from corner where seq = 0 and face_no % 2 = 0)"


@query(f"""with {_DIRTY}, l as (select *, lag(x) over k px, lag(y) over k py, lag(z) over k pz from dirty window k as (partition by bldg_id, face_no order by seq)),
a as (select * from l where px is null or x <> px or y <> py or z <> pz),
e as (select *, row_number() over (partition by bldg_id, face_no order by seq) i, count(*) over (partition by bldg_id, face_no) n, first_value(x) over k fx, first_value(y) over k fy, first_value(z) over k fz from a window k as (partition by bldg_id, face_no order by seq)),
b as (select * from e where not (i = n and n > 1 and x = fx and y = fy and z = fz))
select bldg_id, face_no, cast(i - 1 as int) seq, x, y, z from b""", "corner")
def corner_dedup(spark, sf_dir):
    """W4 F10."""
    c = fixtures.table(spark, sf_dir, "corner")
    dirty = c.withColumn("seq", F.col("seq") * 10).unionByName(c.where((F.col("bldg_id") + F.col("seq")) % 3 == 0).withColumn("seq", F.col("seq") * 10 + 1)).unionByName(c.where("seq = 0 and face_no % 2 = 0").withColumn("seq", F.lit(99)))
    return faces.unpack(faces.clean_rings(faces.rings(dirty)))


_ADJ = """pairs as (select w.bldg_id, w.face_no wall_no, r.face_no roof_no, r.seq, r.z, bool_or({same}) hit from corner w join kind kw on kw.bldg_id = w.bldg_id and kw.face_no = w.face_no and kw.element = 'Wall' join corner r on r.bldg_id = w.bldg_id join kind kr on kr.bldg_id = r.bldg_id and kr.face_no = r.face_no and kr.element = 'Roof' group by all),
pr2 as (select bldg_id, wall_no, roof_no, count(*) filter (hit) n, arg_min(z, seq) filter (hit) z from pairs group by all),
adj as (select bldg_id, wall_no, coalesce(arg_max(roof_no, struct_pack(z := z, r := roof_no)) filter (n >= 2), min(roof_no)) roof_no, cast(coalesce(arg_max(n, struct_pack(z := z, r := roof_no)) filter (n >= 2), 0) as int) n_common from pr2 group by all)"""


@query(f"with {_KIND}, {_ADJ.format(same='w.x = r.x and w.y = r.y and w.z = r.z')} select * from adj", "corner")
def wall_roof_adjacency(spark, sf_dir):
    """By whole corners."""
    return faces.adjacency(faces.classify(_rings(spark, sf_dir))).drop("common")


@query(f"with {_KIND}, {_ADJ.format(same='w.x = r.x or w.y = r.y or w.z = r.z')} select * from adj", "corner")
def wall_roof_adjacency_by_coordinate(spark, sf_dir):
    """By any one coordinate."""
    return faces.adjacency(faces.classify(_rings(spark, sf_dir)), "coordinate").drop("common")


@query("""with pt as (select distinct bldg_id, k, mx + (px - mx) * k / 4e0 px, my + (py - my) * k / 4e0 py from (select bldg_id, seq, x px, y py, avg(x) over (partition by bldg_id) mx, avg(y) over (partition by bldg_id) my from corner where face_no = 0), (select unnest(range(0, 7)) k)),
e as (select bldg_id, x ax, y ay, coalesce(lead(x) over w, first_value(x) over w) bx, coalesce(lead(y) over w, first_value(y) over w) b_y from corner where face_no = 0 window w as (partition by bldg_id order by seq rows between unbounded preceding and unbounded following))
select pt.bldg_id, k, px, py, count(*) filter ((ay > py) <> (b_y > py) and px < (bx - ax) * (py - ay) / nullif(b_y - ay, 0) + ax) % 2 = 1 and not bool_or(sign((bx - ax) * (py - ay) - (b_y - ay) * (px - ax)) = 0 and px between least(ax, bx) and greatest(ax, bx) and py between least(ay, b_y) and greatest(ay, b_y)) inside
from pt join e using (bldg_id) group by all""", "corner")
def point_in_roof(spark, sf_dir):
    """Points from a roof's middle through its corners, strictly inside only."""
    roof = _rings(spark, sf_dir).where("face_no = 0")
    mx, my = (g.total(g.field("ring", c)) / F.size("ring") for c in "xy")
    pts = roof.withColumn("mx", mx).withColumn("my", my).select("bldg_id", "ring", F.explode("ring").alias("p"), "mx", "my").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long"))))
    pts = pts.withColumns({"px": F.col("mx") + (F.col("p.x") - F.col("mx")) * F.col("k") / lit(4), "py": F.col("my") + (F.col("p.y") - F.col("my")) * F.col("k") / lit(4)})
    return pts.select("bldg_id", "k", "px", "py", g.inside(F.col("ring"), F.col("px"), F.col("py")).alias("inside")).distinct()


@query("""with s as (select a.bldg_id, a.seq i, b.seq j, a.x ax, a.y ay, b.x bx, b.y b_y from corner a join corner b on a.bldg_id = b.bldg_id and a.face_no = 0 and b.face_no = 0 and a.seq < b.seq),
t as (select p.bldg_id, p.i, p.j, q.i k, q.j l, p.ax, p.ay, p.bx, p.b_y, q.ax cx, q.ay cy, q.bx dx, q.b_y dy from s p join s q on p.bldg_id = q.bldg_id and (p.i * 4 + p.j) < (q.i * 4 + q.j)),
o as (select *, sign((bx-ax)*(cy-ay) - (b_y-ay)*(cx-ax)) o1, sign((bx-ax)*(dy-ay) - (b_y-ay)*(dx-ax)) o2, sign((dx-cx)*(ay-cy) - (dy-cy)*(ax-cx)) o3, sign((dx-cx)*(b_y-cy) - (dy-cy)*(bx-cx)) o4 from t)
select bldg_id, i, j, k, l, (o1 = 0 and cx between least(ax,bx) and greatest(ax,bx) and cy between least(ay,b_y) and greatest(ay,b_y)) or (o2 = 0 and dx between least(ax,bx) and greatest(ax,bx) and dy between least(ay,b_y) and greatest(ay,b_y))
 or (o3 = 0 and ax between least(cx,dx) and greatest(cx,dx) and ay between least(cy,dy) and greatest(cy,dy)) or (o4 = 0 and bx between least(cx,dx) and greatest(cx,dx) and b_y between least(cy,dy) and greatest(cy,dy)) touch from o""", "corner")
def segment_touch(spark, sf_dir):
    """Edges and diagonals of each roof; diagonals cross and do not touch."""
    roof = _rings(spark, sf_dir).where("face_no = 0")
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    segs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.get("ring", F.lit(i)).alias("a"), F.get("ring", F.lit(j)).alias("b")) for i, j in pairs])
    two = roof.withColumn("p", F.explode(segs)).withColumn("q", F.explode(segs)).where("p.i * 4 + p.j < q.i * 4 + q.j")
    return two.select("bldg_id", "p.i", "p.j", F.col("q.i").alias("k"), F.col("q.j").alias("l"), g.touches(F.col("p.a"), F.col("p.b"), F.col("q.a"), F.col("q.b")).alias("touch"))


def _walls(spark, sf_dir) -> DataFrame:
    classed = faces.classify(_rings(spark, sf_dir))
    return imaging.wall_candidates(classed, faces.adjacency(classed), fixtures.table(spark, sf_dir, "photo"))


#: For boxes: the two steps around a wall are its upright edges; a touch needs an exact collinear corner.
_HIDE = f"""{_SEEN}, {_KIND}, {_ADJ.format(same='w.x = r.x and w.y = r.y and w.z = r.z')},
full_ as (select bldg_id, face_no, photo_id, area from seen where n_in = n),
cand as (select a.bldg_id, a.wall_no, a.roof_no, f.photo_id, f.area from adj a join full_ f on f.bldg_id = a.bldg_id and f.face_no = a.wall_no join full_ r on r.bldg_id = a.bldg_id and r.face_no = a.roof_no and r.photo_id = f.photo_id),
wc as (select c.bldg_id, c.wall_no, c.roof_no, c.photo_id, p.seq, p.u, p.v, q.seq rseq, q.seq is not null of_roof from cand c join pr p on p.bldg_id = c.bldg_id and p.face_no = c.wall_no and p.photo_id = c.photo_id left join pr q on q.bldg_id = c.bldg_id and q.face_no = c.roof_no and q.photo_id = c.photo_id and q.x = p.x and q.y = p.y and q.z = p.z),
st as (select a.bldg_id, a.wall_no, a.roof_no, a.photo_id, case when a.of_roof then b.u else a.u end pu, case when a.of_roof then b.v else a.v end pv, case when a.of_roof then a.rseq else b.rseq end at_ from wc a join wc b on b.bldg_id = a.bldg_id and b.wall_no = a.wall_no and b.photo_id = a.photo_id and b.seq = (a.seq + 1) % 4 where a.of_roof <> b.of_roof),
ed as (select a.bldg_id, a.face_no, a.photo_id, a.seq, a.u ax, a.v ay, b.u bx, b.v b_y from pr a join pr b on b.bldg_id = a.bldg_id and b.face_no = a.face_no and b.photo_id = a.photo_id and b.seq = (a.seq + 1) % 4),
tst as (select s.*, e.*, tu, tv, sign((tu-pu)*(ay-pv) - (tv-pv)*(ax-pu)) o1, sign((tu-pu)*(b_y-pv) - (tv-pv)*(bx-pu)) o2, sign((bx-ax)*(pv-ay) - (b_y-ay)*(pu-ax)) o3, sign((bx-ax)*(tv-ay) - (b_y-ay)*(tu-ax)) o4
  from (select s.*, t.u tu, t.v tv from st s join pr t on t.bldg_id = s.bldg_id and t.face_no = s.roof_no and t.photo_id = s.photo_id and t.seq = s.at_) s join (select bldg_id b2, face_no f2, photo_id p2, seq, ax, ay, bx, b_y from ed) e on b2 = s.bldg_id and f2 = s.roof_no and p2 = s.photo_id),
per as (select bldg_id, wall_no, photo_id, pu, pv, at_, count(*) filter ((ay > pv) <> (b_y > pv) and pu < (bx-ax)*(pv-ay)/nullif(b_y-ay,0)+ax) % 2 = 1 and not bool_or(o3 = 0 and pu between least(ax,bx) and greatest(ax,bx) and pv between least(ay,b_y) and greatest(ay,b_y)) ins,
  coalesce(bool_or((o1 = 0 and ax between least(pu,tu) and greatest(pu,tu) and ay between least(pv,tv) and greatest(pv,tv)) or (o2 = 0 and bx between least(pu,tu) and greatest(pu,tu) and b_y between least(pv,tv) and greatest(pv,tv)) or (o3 = 0 and pu between least(ax,bx) and greatest(ax,bx) and pv between least(ay,b_y) and greatest(ay,b_y)) or (o4 = 0 and tu between least(ax,bx) and greatest(ax,bx) and tv between least(ay,b_y) and greatest(ay,b_y))) filter (seq <> at_ and (seq + 1) % 4 <> at_), false) tou from tst group by all),
hid as (select c.bldg_id, c.wall_no, c.photo_id, c.area, coalesce(bool_or(ins or tou), false) hidden from cand c left join per p on p.bldg_id = c.bldg_id and p.wall_no = c.wall_no and p.photo_id = c.photo_id group by all)"""


@query(f"with {_HIDE} select bldg_id, wall_no as face_no, photo_id, hidden from hid", "corner", "photo")
def wall_occlusion(spark, sf_dir):
    """G7 W5 F6 J14."""
    return _walls(spark, sf_dir).select(*FACE, "photo_id", "hidden")


@query(f"with {_HIDE}, k as (select *, row_number() over (partition by bldg_id, wall_no order by area desc, photo_id desc) k from hid where not hidden) select bldg_id, wall_no as face_no, photo_id, round(area, 4) area from k where k = 1", "corner", "photo")
def wall_best_photo(spark, sf_dir):
    """F8 A3."""
    return imaging.best(imaging.candidates(_walls(spark, sf_dir).where(~F.col("hidden")))).select(*FACE, "photo_id", _r("area", 4).alias("area"))


# --- tiles and mosaics ---

_TILES = """cw as (select col, arg_min(w, row_no) cw from tile group by col), rh as (select row_no, arg_min(h, col) rh from tile group by row_no),
tl as (select t.col, t.row_no, t.w, t.h, cast(coalesce((select sum(cw) from cw c where c.col < t.col), 0) as bigint) off_x, cast(coalesce((select sum(rh) from rh r where r.row_no < t.row_no), 0) as bigint) off_y, cast((select sum(cw) from cw) as bigint) total_w, cast((select sum(rh) from rh) as bigint) total_h from tile t)"""


@query(f"with {_TILES} select * from tl", "tile")
def tile_offsets(spark, sf_dir):
    """A8 A9 W3."""
    return tiles.layout(fixtures.table(spark, sf_dir, "tile"))


@query(f"""with {_TILES}, q as (select bldg_id * 10 + face_no req, cast(bldg_id * 37 % 4600 as double) x1, cast(bldg_id * 53 % 4400 as double) y1, bldg_id * 37 % 4600 + rw * 60e0 x2, bldg_id * 53 % 4400 + rh * 60e0 y2 from rect_size)
select req, col * 100 + row_no tile, greatest(x1, off_x) ix1, greatest(y1, off_y) iy1, least(x2, off_x + w) ix2, least(y2, off_y + h) iy2 from q join tl on greatest(x1, off_x) < least(x2, off_x + w) and greatest(y1, off_y) < least(y2, off_y + h)""", "tile", "rect_size")
def tile_overlap(spark, sf_dir):
    """Requested patches and the tiles they touch."""
    q = fixtures.table(spark, sf_dir, "rect_size").selectExpr("bldg_id * 10 + face_no req", "cast(bldg_id * 37 % 4600 as double) x1", "cast(bldg_id * 53 % 4400 as double) y1", "bldg_id * 37 % 4600 + rw * 60e0 x2", "bldg_id * 53 % 4400 + rh * 60e0 y2")
    t = tiles.layout(fixtures.table(spark, sf_dir, "tile")).selectExpr("col * 100 + row_no tile", "cast(off_x as double) x1", "cast(off_y as double) y1", "cast(off_x + w as double) x2", "cast(off_y + h as double) y2")
    return tiles.overlaps(q, t, "req", "tile", 1000.0)


@query(f"with {_MOSAIC} select l, b, r, t, sx px_x, sy px_y, mw, mh from mosaic", "ortho")
def ortho_mosaic_bbox(spark, sf_dir):
    """A10 Q16."""
    return imaging.mosaic(fixtures.table(spark, sf_dir, "ortho"))


@query("""with f as (select bldg_id, min(x) x1, min(y) y1, max(x) x2, max(y) y2 from corner group by all)
select bldg_id, ortho_id, greatest(x1, l) ix1, greatest(y1, b) iy1, least(x2, r) ix2, least(y2, t) iy2 from f join ortho on greatest(x1, l) < least(x2, r) and greatest(y1, b) < least(y2, t)""", "corner", "ortho")
def ortho_patch_overlap(spark, sf_dir):
    """Building footprints and the orthos below them."""
    f = fixtures.table(spark, sf_dir, "corner").groupBy("bldg_id").agg(F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2"))
    o = fixtures.table(spark, sf_dir, "ortho").selectExpr("ortho_id", "l x1", "b y1", "r x2", "t y2")
    return tiles.overlaps(f, o, "bldg_id", "ortho_id", 80.0)


@query("select bldg_id, face_no, seq, exists (select 1 from ortho where x between l and r and y between b and t) covered from corner", "corner", "ortho")
def ortho_point_exists(spark, sf_dir):
    """Closed bounds."""
    boxes = fixtures.table(spark, sf_dir, "ortho").selectExpr("l x1", "b y1", "r x2", "t y2")
    points = fixtures.table(spark, sf_dir, "corner").select(*FACE, "seq", "x", "y")
    return tiles.covered(points, [*FACE, "seq"], boxes, 160.0).select(*FACE, "seq", "covered")


@query("""with i as (select s_suppkey id, 's_' || s_suppkey as name, 900 + cast(s_suppkey % 23 as int) * 211 w, 700 + cast(s_suppkey % 17 as int) * 307 h from supplier)
select name || '_' || col || '_' || row_no as tile, cast(col as int) col, cast(row_no as int) row_no, cast(least(1000, w - col * 1000) as int) tw, cast(least(1000, h - row_no * 1000) as int) th from (select *, unnest(range(0, cast(ceil(w / 1000e0) as int))) col from i), unnest(range(0, cast(ceil(h / 1000e0) as int))) t(row_no)""")
def source_tiles(spark, sf_dir):
    """R19."""
    i = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("concat('s_', s_suppkey) name", "900 + cast(s_suppkey % 23 as int) * 211 w", "700 + cast(s_suppkey % 17 as int) * 307 h")
    return tiles.grid(i)


@query("""with p as (select 'd/base_' || (n_nationkey % 5) || '_' || (n_nationkey // 5) || case when n_nationkey % 4 = 0 then '.TIF' else '.png' end as path from nation)
select path, 'base' base, cast(regexp_extract(path, '_(\\d+)_\\d+\\.', 1) as int) col, cast(regexp_extract(path, '_\\d+_(\\d+)\\.', 1) as int) row_no from p""")
def tile_names(spark, sf_dir):
    """S15 C5."""
    p = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("concat('d/base_', n_nationkey % 5, '_', n_nationkey div 5, case when n_nationkey % 4 = 0 then '.TIF' else '.png' end) path")
    return p.withColumn("t", tiles.tile_name()).select("path", "t.*")


# --- frontal views ---

_PLANE = f"""{_NEXT}, sm as (select bldg_id, face_no, sum(vx) a, sum(vy) b, sum(vz) c from cr group by all),
un as (select bldg_id, face_no, a / sqrt(a*a+b*b+c*c) nx, b / sqrt(a*a+b*b+c*c) ny, c / sqrt(a*a+b*b+c*c) nz from sm),
th as (select *, (case when nx < 0 then -1 else 1 end) * acos(greatest(least(case when sqrt(nx*nx+ny*ny) > 0 then ny / sqrt(nx*nx+ny*ny) else 1e0 end, 1e0), -1e0)) theta from un),
tt as (select *, (case when nz > 0 then -1 else 1 end) * acos(greatest(least(sin(theta)*nx + cos(theta)*ny, 1e0), -1e0)) tilt from th),
pl as (select t.*, cos(theta)*x - sin(theta)*y px, sin(tilt)*(sin(theta)*x + cos(theta)*y) + cos(tilt)*z pz, cos(tilt)*(sin(theta)*x + cos(theta)*y) - sin(tilt)*z p_y from tex_corner t join tt using (bldg_id, face_no)),
pn as (select *, coalesce(lead(su) over k, first_value(su) over k) su2, coalesce(lead(px) over k, first_value(px) over k) px2 from pl window k as (partition by bldg_id, face_no order by seq rows between unbounded preceding and unbounded following)),
mir as (select bldg_id, face_no, bool_or((su - su2) * (px - px2) < 0) mirrored, min(px) x0, min(pz) z0, max(px) x1, max(pz) z1 from pn group by all),
dst as (select p.bldg_id, p.face_no, p.seq, mirrored, (case when mirrored then (x1 - x0) - (px - x0) else px - x0 end) * 625e-2 + 8 dx, (case when mirrored then (z1 - z0) - (pz - z0) else pz - z0 end) * 625e-2 + 8 dy from pl p join mir using (bldg_id, face_no))"""


@query(f"with {_PLANE} select bldg_id, face_no, cast(seq as int) seq, round(dx, 4) dx, round(dy, 4) dy from dst", "tex_corner")
def rectified_polygon(spark, sf_dir):
    """G9 G11."""
    r = rectify.rectified(fixtures.table(spark, sf_dir, "tex_corner"))
    return r.select(*FACE, F.posexplode("dst").alias("seq", "p")).select(*FACE, "seq", _r("p.dx", 4).alias("dx"), _r("p.dy", 4).alias("dy"))


@query(f"with {_PLANE} select bldg_id, face_no, mirrored from mir", "tex_corner")
def mirror_flag(spark, sf_dir):
    """G10."""
    return rectify.rectified(fixtures.table(spark, sf_dir, "tex_corner")).select(*FACE, "mirrored")


@query(f"with {_PLANE} select bldg_id, face_no, round(max(p_y) - min(p_y), 6) thickness, round(max(px) - min(px), 4) wide, round(max(pz) - min(pz), 4) high from pl group by all", "tex_corner")
def plane_extent(spark, sf_dir):
    """Faces turned into the plane have no thickness."""
    e = lambda c: F.array_max(g.field("plane", c)) - F.array_min(g.field("plane", c))
    return g.to_plane(_rings(spark, sf_dir)).select(*FACE, _r(e("y")).alias("thickness"), _r(e("x"), 4).alias("wide"), _r(e("z"), 4).alias("high"))


@query("""with p as (select bldg_id, face_no, max(su) filter (seq=0) x1, max(sv) filter (seq=0) y1, max(su) filter (seq=1) x2, max(sv) filter (seq=1) y2, max(su) filter (seq=2) x3, max(sv) filter (seq=2) y3, max(x) filter (seq=0) u1, max(x) filter (seq=1) u2, max(x) filter (seq=2) u3, max(z) filter (seq=0) v1, max(z) filter (seq=1) v2, max(z) filter (seq=2) v3 from tex_corner group by all),
d as (select *, x1*(y2-y3) - y1*(x2-x3) + (x2*y3 - x3*y2) det from p)
select bldg_id, face_no, round((u1*(y2-y3) + u2*(y3-y1) + u3*(y1-y2)) / det, 6) + 0e0 a, round((u1*(x3-x2) + u2*(x1-x3) + u3*(x2-x1)) / det, 6) + 0e0 b, round((u1*(x2*y3-x3*y2) + u2*(x3*y1-x1*y3) + u3*(x1*y2-x2*y1)) / det, 4) + 0e0 c,
 round((v1*(y2-y3) + v2*(y3-y1) + v3*(y1-y2)) / det, 6) + 0e0 d, round((v1*(x3-x2) + v2*(x1-x3) + v3*(x2-x1)) / det, 6) + 0e0 e, round((v1*(x2*y3-x3*y2) + v2*(x3*y1-x1*y3) + v3*(x1*y2-x2*y1)) / det, 4) + 0e0 f from d""", "tex_corner")
def affine_from_points(spark, sf_dir):
    """G14."""
    t = fixtures.table(spark, sf_dir, "tex_corner").groupBy(*FACE).agg(g.pack("seq", "x", "z", "su", "sv").alias("r"))
    p = [F.get("r", F.lit(i)) for i in range(3)]
    m = g.affine([(q["su"], q["sv"]) for q in p], [(q["x"], q["z"]) for q in p])
    return t.select(*FACE, *[(_r(c, 4 if n in "cf" else 6) + lit(0)).alias(n) for n, c in zip("abcdef", m)])


@query("""with s as (select bldg_id, face_no, rw * 9 rw, rh * 11 rh from rect_size), b as (select *, case when rh > rw then cast(round_even(rw * (256e0 / rh), 0) as int) else 256 end box_w, case when rh > rw then 256 else cast(round_even(rh * (256e0 / rw), 0) as int) end box_h, cast(1 + greatest(0, ceil((rw - 256) / 230e0)) as int) n_w, cast(1 + greatest(0, ceil((rh - 256) / 230e0)) as int) n_h from s)
select bldg_id, face_no, rw, rh, box_w, box_h, rw between 16 and 256 and rh between 16 and 256 gate, n_w, n_h, greatest(0, -(rw - 256 - (n_w - 1) * 230)) rest_w, greatest(0, -(rh - 256 - (n_h - 1) * 230)) rest_h from b""", "rect_size")
def letterbox_dims(spark, sf_dir):
    """R10 R11 F12."""
    return rectify.letterbox(fixtures.table(spark, sf_dir, "rect_size").withColumns({"rw": F.col("rw") * 9, "rh": F.col("rh") * 11}))


# --- atlases ---

_ITEMS = "it as (select bldg_id, face_no, rw w, rh h, row_number() over (partition by bldg_id order by face_no) i from rect_size)"
_POW = "case when {0} <= 1 then 1 when {0} <= 2 then 2 when {0} <= 4 then 4 when {0} <= 8 then 8 when {0} <= 16 then 16 when {0} <= 32 then 32 when {0} <= 64 then 64 when {0} <= 128 then 128 when {0} <= 256 then 256 else 512 end"


@query(f"""with it as (select bldg_id, face_no, rw w, rh h, row_number() over (partition by bldg_id order by face_no) i from rect_size),
f1 as (select bldg_id, cast(0 as bigint) i, 0 x, 0 y, 0 hi, 0 wide from it where i = 1 union all
  select f.bldg_id, it.i, case when 24 < x + w then w else x + w end, case when 24 < x + w then y + hi else y end, case when 24 < x + w then h else greatest(hi, h) end, greatest(wide, case when 24 < x + w then w else x + w end) from f1 f join it on it.bldg_id = f.bldg_id and it.i = f.i + 1),
sz as (select bldg_id, {_POW.format('arg_max(wide, i)')} atlas_w, {_POW.format('(arg_max(y, i) + arg_max(hi, i))')} atlas_h from f1 group by bldg_id),
f2 as (select bldg_id, cast(0 as bigint) i, -1 face_no, 0 x, 0 y, 0 hi, 0 px, 0 py from it where i = 1 union all
  select f.bldg_id, it.i, it.face_no, case when atlas_w < x + w then w else x + w end, case when atlas_w < x + w then y + hi else y end, case when atlas_w < x + w then h else greatest(hi, h) end, case when atlas_w < x + w then 0 else x end, case when atlas_w < x + w then y + hi else y end from f2 f join it on it.bldg_id = f.bldg_id and it.i = f.i + 1 join sz on sz.bldg_id = f.bldg_id)
select f2.bldg_id, face_no, cast(px as bigint) off_x, cast(py as bigint) off_y, cast(atlas_w as bigint) atlas_w, cast(atlas_h as bigint) atlas_h from f2 join sz using (bldg_id) where i > 0""", "rect_size")
def shelf_pack(spark, sf_dir):
    """W7 C12, with a width of 24 so that shelves wrap."""
    return packing.shelf_pack(fixtures.table(spark, sf_dir, "rect_size"), 24)


_ROWPACK = f"""it as (select bldg_id, face_no, rw w, rh h, row_number() over (partition by bldg_id order by face_no) i, count(*) over (partition by bldg_id) n from rect_size),
f as (select bldg_id, k n_row, cast(0 as bigint) i, -1 face_no, list_transform(range(0, k), lambda q: cast(0 as bigint)) ws, list_transform(range(0, k), lambda q: cast(0 as bigint)) hs, cast(-1 as bigint) r, cast(-1 as bigint) x from (select bldg_id, unnest(range(1, n + 1)) k from it where i = 1) union all
  select bldg_id, n_row, i, face_no, list_transform(ws, lambda v, q: case when q = p then v + w else v end), list_transform(hs, lambda v, q: case when q = p then greatest(v, h) else v end), cast(p - 1 as bigint), ws[p] from (select f.bldg_id, f.n_row, it.i, it.face_no, f.ws, f.hs, it.w, it.h, list_position(f.ws, list_min(f.ws)) p from f join it on it.bldg_id = f.bldg_id and it.i = f.i + 1)),
lay as (select bldg_id, n_row, hs, {_POW.format('list_max(ws)')} width, {_POW.format('list_sum(hs)')} height from f where i = (select max(i) from it where it.bldg_id = f.bldg_id)),
bst as (select *, row_number() over (partition by bldg_id order by width * height, width + height, n_row) k from lay)"""


@query(f"with {_ROWPACK} select bldg_id, cast(n_row as int) n_row, cast(width as bigint) width, cast(height as bigint) height from lay", "rect_size")
def row_layouts(spark, sf_dir):
    """W8."""
    return packing.row_layouts(fixtures.table(spark, sf_dir, "rect_size")).drop("s")


@query(f"with {_ROWPACK} select b.bldg_id, cast(b.n_row as int) n_row, cast(width as bigint) width, cast(height as bigint) height, f.face_no, f.x off_x, cast(coalesce(list_sum(b.hs[1:f.r]), 0) as bigint) off_y from bst b join f on f.bldg_id = b.bldg_id and f.n_row = b.n_row where k = 1 and f.i > 0", "rect_size")
def row_pack_best(spark, sf_dir):
    """W9."""
    return packing.row_pack(fixtures.table(spark, sf_dir, "rect_size"))


def _placed(spark, sf_dir) -> DataFrame:
    """Roofs and walls with their images, boxes, order and places: the mapping stage up to its atlas."""
    rings = _rings(spark, sf_dir)
    classed = faces.classify(rings)
    photo = fixtures.table(spark, sf_dir, "photo")
    roofs = imaging.candidates(imaging.visible(imaging.in_view(classed.where("element = 'Roof'"), photo)))
    walls = imaging.candidates(imaging.wall_candidates(classed, faces.adjacency(classed), photo).where(~F.col("hidden")))
    chosen = imaging.best(roofs.select(*walls.columns[:0], *[c for c in roofs.columns if c in walls.columns]).unionByName(walls.select(*[c for c in roofs.columns if c in walls.columns])))
    sized = packing.registered(imaging.boxes(chosen.join(classed.select(*FACE, "element"), FACE)))
    spots = packing.shelf_pack(sized, 4096, "order_no", "box_w", "box_h")
    return packing.atlas_uv(sized.join(spots, ["bldg_id", "order_no"]))


@query(f"""with {_HIDE}, roofs as (select s.bldg_id, s.face_no, s.photo_id, s.area, 0 kd, row_number() over (partition by s.bldg_id, s.face_no order by area desc, photo_id desc) k from seen s join kind using (bldg_id, face_no) where element = 'Roof' and n_in = n),
walls as (select bldg_id, wall_no as face_no, photo_id, area, 1 kd, row_number() over (partition by bldg_id, wall_no order by area desc, photo_id desc) k from hid where not hidden),
chosen as (select * from roofs where k = 1 union all select * from walls where k = 1),
ord as (select *, kd * 100 + face_no use_, min(kd * 100 + face_no) over (partition by bldg_id, photo_id) fu from chosen),
num as (select *, cast(row_number() over (partition by bldg_id order by fu, use_) as int) order_no from ord)
select bldg_id, face_no, photo_id, order_no from num where area <> 0""", "corner", "photo")
def atlas_order(spark, sf_dir):
    """Roofs and walls in the order in which they enter the atlas."""
    return _placed(spark, sf_dir).select(*FACE, "photo_id", "order_no")


# --- text ---


def _obj_texts(spark, sf_dir, **how) -> DataFrame:
    """OBJ text of every building, made from its faces (K1, K2)."""
    c = faces.dedup_vertices(fixtures.table(spark, sf_dir, "corner"))
    v = c.select("bldg_id", F.col("v_idx").alias("idx"), "x", "y", "z").distinct()
    f = c.groupBy(*FACE).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "v_idx"))), lambda p: F.struct(p["v_idx"].alias("pos"), F.lit(None).cast("int").alias("tex"), F.lit(None).cast("int").alias("norm"))).alias("corners"))
    f = f.withColumn("element", F.when(F.col("face_no") == 0, "Roof").when(F.col("face_no") == 5, "Ground").otherwise("Wall"))
    return sinks.obj_text(v, f, **how)


_IDX = "ix as (select c.bldg_id, c.face_no, c.seq, k.v_idx, c.x, c.y, c.z from corner c join (select *, row_number() over (partition by bldg_id order by o) v_idx from (select bldg_id, x, y, z, min(face_no * 100 + seq) o from corner group by all)) k using (bldg_id, x, y, z))"


@query(f"""with {_IDX} select bldg_id, case when face_no = 0 then 'Roof' when face_no = 5 then 'Ground' else 'Wall' end label, cast(seq as int) seq, cast(v_idx as int) pos, count(*) n from ix group by all""", "corner")
def obj_parse_faces(spark, sf_dir):
    """Faces written as text and read back."""
    lines = meshes.text_lines(_obj_texts(spark, sf_dir), "bldg_id", "text")
    return meshes.face_corners(lines, "bldg_id").groupBy("bldg_id", "label", "seq", "pos").agg(F.count("*").alias("n"))


@query(f"with {_IDX} select distinct bldg_id, cast(v_idx as int) idx, x, y, z from ix", "corner")
def obj_parse_vertices(spark, sf_dir):
    """S2 C1 C13."""
    return meshes.vertices(meshes.text_lines(_obj_texts(spark, sf_dir), "bldg_id", "text"), "bldg_id")


@query("select bldg_id, cast(0 as int) status, cast(3 + 1 + 8 + 6 as int) n_lines from corner group by bldg_id", "corner")
def obj_line_count(spark, sf_dir):
    """K8: texts with their originals as a fallback."""
    t = _obj_texts(spark, sf_dir)
    return sinks.with_fallback(t, t).select("bldg_id", "status", F.size(F.split("text", "\n")).alias("n_lines"))


def _mtl(spark, sf_dir) -> DataFrame:
    """Material lines: three materials a supplier, the middle one twice, the last without a texture."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    text = F.concat_ws("\n", *[F.concat(F.lit(a), F.col("s_suppkey").cast("string"), F.lit(b)) for a, b in (("newmtl m", "_a"), ("map_Kd t", "_a.png"), ("NEWMTL m", "_b"), ("map_kd old", "_b.png"), ("map_Kd t", "_b.png"), ("newmtl m", "_c"))])
    return meshes.text_lines(s.select("s_suppkey", text.alias("text")), "s_suppkey", "text")


@query("select s_suppkey, 'm' || s_suppkey || s.n as name, case when s.n = '_a' then 't' || s_suppkey || '_a.png' else 't' || s_suppkey || '_b.png' end map_kd from supplier cross join (values ('_a'), ('_b')) s(n)")
def material_lookup(spark, sf_dir):
    """The last texture of each material."""
    return meshes.materials(_mtl(spark, sf_dir), "s_suppkey")


@query("select s_suppkey, 'm' || s_suppkey || s.n as name, case when s.n = '_a' then 't' || s_suppkey || '_a.png' else 'old' || s_suppkey || '_b.png' end map_kd from supplier cross join (values ('_a'), ('_b')) s(n)")
def material_first(spark, sf_dir):
    """The first texture of each material."""
    return meshes.materials(_mtl(spark, sf_dir), "s_suppkey", "first")


@query("select s_suppkey, unnest(['t' || s_suppkey || '_a.png', 'old' || s_suppkey || '_b.png', 't' || s_suppkey || '_b.png']) map_kd from supplier")
def material_textures(spark, sf_dir):
    """S8 O5."""
    return meshes.textures(_mtl(spark, sf_dir), "s_suppkey")


@query("select s_suppkey, cast(i as int) line_no, case i when 1 then 'map_Kd ../appearance/t' || s_suppkey || '_a.jpg' when 3 then 'map_Kd ../appearance/old' || s_suppkey || '_b.jpg' else 'map_Kd ../appearance/t' || s_suppkey || '_b.jpg' end line from supplier cross join (values (1), (3), (4)) t(i)")
def material_retarget(spark, sf_dir):
    """K5."""
    m = _mtl(spark, sf_dir).withColumn("line", sinks.retarget(F.col("line"), "../appearance", "jpg"))
    return m.where(F.col("line").startswith("map_Kd "))


@query("""with s as (select event_id, user_id, case when event_id % 7 = 0 then event_type end label from events)
select event_id, last_value(label ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) label from s""")
def label_fill_forward(spark, sf_dir):
    """W6."""
    from pyspark.sql import Window as W

    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", F.when(F.col("event_id") % 7 == 0, F.col("event_type")).alias("label"))
    return e.select("event_id", F.last("label", ignorenulls=True).over(W.partitionBy("user_id").orderBy("event_id")).alias("label"))


@query("select file, x, y, z, omega, phi, kappa, ok from (select 'p' || s_suppkey as file, s_acctbal x, try_cast(case when s_suppkey % 9 = 0 then '' else cast(s_suppkey as varchar) end as double) y, 5e0 z, 1e0 omega, try_cast(case when s_suppkey % 11 = 0 then 'x' else '2' end as double) phi, 3e0 kappa, s_suppkey % 9 <> 0 and s_suppkey % 11 <> 0 ok from supplier)")
def orientation_rows(spark, sf_dir):
    """S11 F14."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    raw = s.selectExpr("concat('p', s_suppkey) file", "cast(s_acctbal as string) x", "case when s_suppkey % 9 = 0 then '' else cast(s_suppkey as string) end y", "'5' z", "'1' omega", "case when s_suppkey % 11 = 0 then 'x' else '2' end phi", "'3' kappa")
    return meshes.check_orientation(raw)


@query("select req_id, bldg from request semi join (select p_partkey from part where p_partkey % 3 <> 0) p on p.p_partkey = request.bldg", "request")
def requested_buildings(spark, sf_dir):
    """J7."""
    there = fixtures.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("bldg"))
    return fixtures.table(spark, sf_dir, "request").join(there, "bldg", "left_semi").select("req_id", "bldg")


@query("select req_id, bldg from request anti join (select p_partkey from part where p_partkey % 3 <> 0) p on p.p_partkey = request.bldg", "request")
def missing_buildings(spark, sf_dir):
    """J13."""
    there = fixtures.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("bldg"))
    return fixtures.table(spark, sf_dir, "request").join(there, "bldg", "left_anti").select("req_id", "bldg")


@query("""select req_id, case when roof_class = 'others' then case when has >= 1 then 'lod2' else 'lod1' end when has >= 1 then 'lod2' end as name from request""", "request")
def candidate_priority(spark, sf_dir):
    """J12 O3."""
    r = fixtures.table(spark, sf_dir, "request")
    files = r.where("has >= 1").selectExpr("req_id", "'lod2' name").unionByName(r.selectExpr("req_id", "'lod1' name"))
    return meshes.first_candidates(r, files)


@query("select user_id, count(*) n, cast(sum(event_id) as bigint) s, cast(floor(sum(event_id) / 3600e0) as bigint) || ' hours ' || cast(floor(sum(event_id) % 3600 / 60e0) as bigint) || ' minutes ' || cast(sum(event_id) % 60 as bigint) || ' seconds' as said from events group by user_id")
def elapsed_text(spark, sf_dir):
    """C7."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").agg(F.count("*").alias("n"), F.sum("event_id").alias("s"))
    return e.withColumn("said", F.expr("format_string('%d hours %d minutes %d seconds', s div 3600, s % 3600 div 60, s % 60)"))


# --- pixels ---

_PATCH = "patch8 as (select vec_id, cast(floor((i-1)/8e0) as int) r, cast((i-1)%8 as int) c, cast(embedding[i] as double) v from (select vec_id, embedding, unnest(range(1,65)) i from embeddings))"


def _patch8(spark, sf_dir) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "v")).select("vec_id", F.floor(F.col("pos") / lit(8)).cast("int").alias("r"), (F.col("pos") % 8).alias("c"), F.col("v").cast("double").alias("v"))


@query(f"with {_PATCH} select vec_id, r, c, round((v - 5e-1) / 5e-1, 6) v from patch8")
def patch_normalise(spark, sf_dir):
    """R17."""
    return _patch8(spark, sf_dir).withColumn("v", _r((F.col("v") - lit(0.5)) / lit(0.5)))


@query(f"with {_PATCH} select vec_id, r, c, cast(trunc((greatest(least(v, 1e0), -1e0) + 1) / 2 * 255) as int) v from patch8")
def patch_denormalise(spark, sf_dir):
    """R18."""
    return _patch8(spark, sf_dir).withColumn("v", ((F.greatest(F.least(F.col("v"), lit(1)), lit(-1)) + 1) / 2 * 255).cast("int"))


@query(f"with {_PATCH} select vec_id, round(avg(v), 6) mean, min(v) low, max(v) high, round(stddev_pop(v), 6) std, median(v) middle from patch8 group by vec_id")
def patch_summary(spark, sf_dir):
    """A14 A16."""
    return _patch8(spark, sf_dir).groupBy("vec_id").agg(_r(F.avg("v")).alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"), _r(F.stddev_pop("v")).alias("std"), F.median("v").alias("middle"))


@query(f"with {_PATCH} select vec_id, r, 7 - c c, v from patch8")
def patch_flip(spark, sf_dir):
    """R17."""
    return _patch8(spark, sf_dir).withColumn("c", 7 - F.col("c"))


@query(f"with {_PATCH}, p as (select vec_id // 4 canvas, vec_id o, r + cast(vec_id % 4 as int) * 3 y, c + cast(vec_id % 4 as int) * 3 x, v from patch8) select canvas, y, x, arg_max(v, o) v, count(*) n, round(avg(v), 6) mean from p group by all")
def patch_paste(spark, sf_dir):
    """Overlapping patches, the later over the earlier, and their mean."""
    k = (F.col("vec_id") % 4).cast("int") * 3
    p = _patch8(spark, sf_dir).select(F.expr("vec_id div 4").alias("canvas"), "vec_id", (F.col("r") + k).alias("y"), (F.col("c") + k).alias("x"), "v")
    return p.groupBy("canvas", "y", "x").agg(F.max(F.struct("vec_id", "v"))["v"].alias("v"), F.count("*").alias("n"), _r(F.avg("v")).alias("mean"))
