"""Building geometry derived from the driver's tables, in SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CORNER = """
select p_partkey as bldg_id, face_no, seq,
  (p_partkey % 40) * 20e0 + cx * (4e0 + p_size % 7) as x,
  floor(p_partkey / 40e0) * 20e0 + cy * (3e0 + p_partkey % 5) as y,
  cz * (3e0 + p_size % 9) as z
from part cross join (values
 (0,0,0,0,1),(0,1,1,0,1),(0,2,1,1,1),(0,3,0,1,1),
 (1,0,0,0,0),(1,1,1,0,0),(1,2,1,0,1),(1,3,0,0,1),
 (2,0,1,0,0),(2,1,1,1,0),(2,2,1,1,1),(2,3,1,0,1),
 (3,0,1,1,0),(3,1,0,1,0),(3,2,0,1,1),(3,3,1,1,1),
 (4,0,0,1,0),(4,1,0,0,0),(4,2,0,0,1),(4,3,0,1,1),
 (5,0,0,1,0),(5,1,1,1,0),(5,2,1,0,0),(5,3,0,0,0)) as t(face_no, seq, cx, cy, cz)
"""
PHOTO = """
select s_suppkey as photo_id, (s_suppkey % 10) * 80e0 as cx, floor(s_suppkey / 10e0) * 200e0 as cy,
  500e0 + s_nationkey as cz, s_nationkey / 10e0 - 12e-1 as omega_deg, s_nationkey / 12e0 - 1e0 as phi_deg,
  s_suppkey * 7e0 as kappa_deg, 6000 as w, 4000 as h, 36e0 as sensor_w, 24e0 as sensor_h, 50e0 as f,
  0e0 as ppx, 0e0 as ppy
from supplier
"""
ORTHO = """
select r_regionkey as ortho_id, r_regionkey * 160e0 as l, 0e0 as b, (r_regionkey + 1) * 160e0 as r, 1000e0 as t,
  5e-1 as px_x, 5e-1 as px_y from region
"""
TILE = """
select n_nationkey % 5 as col, cast(floor(n_nationkey / 5e0) as int) as row_no,
  case when n_nationkey % 5 = 4 then 600 else 1000 end as w,
  case when n_nationkey >= 20 then 400 else 1000 end as h from nation
"""
RECT = """
select bldg_id, face_no, cast(ceil(max(x) - min(x)) as int) + 1 as rw, cast(ceil(max(y) - min(y)) as int) + 1 as rh
from corner group by bldg_id, face_no
"""
#: Texture positions of each face's corners, skewed a little, and turned over for every third face.
TEX = """
select bldg_id, face_no, seq, x, y, z,
  (case when (bldg_id + face_no) % 3 = 0 then 1 - (case when seq in (1, 2) then 1 else 0 end) else (case when seq in (1, 2) then 1 else 0 end) end) * 40e0 + seq * 5e-1 + bldg_id % 7 as su,
  (case when seq in (2, 3) then 1 else 0 end) * 30e0 + face_no as sv from corner
"""
REQUEST = """
select o_orderkey as req_id, o_custkey % 250 as bldg, case when o_orderpriority = '1-URGENT' then 'others' else 'lod2' end as roof_class, cast(o_orderkey % 3 as int) as has from orders
"""
VIEWS = {"corner": CORNER, "photo": PHOTO, "ortho": ORTHO, "tile": TILE, "rect_size": RECT, "tex_corner": TEX, "request": REQUEST}
_FROM = {"corner": ["part"], "photo": ["supplier"], "ortho": ["region"], "tile": ["nation"], "rect_size": ["corner"], "tex_corner": ["corner"], "request": ["orders"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or one of the views above."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text, given = VIEWS[name], {}
    for source in _FROM[name]:
        text = text.replace(f"from {source}", "from {" + source + "}")
        given[source] = table(spark, sf_dir, source)
    return spark.sql(text, **given)


def ctes(*names: str) -> str:
    """The views as the beginning of a DuckDB query: `with recursive a as (...), b as (...)`."""
    need: list[str] = []

    def add(n: str) -> None:
        for s in _FROM[n]:
            if s in VIEWS:
                add(s)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    return "with recursive " + ", ".join(f"{n} as ({VIEWS[n]})" for n in need)
