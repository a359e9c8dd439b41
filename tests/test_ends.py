"""The ends of every ring's image in every photo: against whole images, their generated code and tasks."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quoin.functions import geometry as g
from quoin.operators import faces as meshes
from quoin.operators import imaging
from quoin.plans import registry
from quoin.sources import fixtures

PHOTO = "photo_id long, cx double, cy double, cz double, omega_deg double, phi_deg double, kappa_deg double, w int, h int, sensor_w double, sensor_h double, f double, ppx double, ppy double"
ENDS = ["u_min", "u_max", "v_min", "v_max"]


@pytest.mark.parametrize("distortion", [None, (1e-3, 2e-3, 3e-2, 1e-3)])
def test_ends_are_those_of_whole_images(spark, distortion):
    """Rings of none to seven corners, with nulls and corners in a camera's plane; photos without a sensor or turned over."""
    r = random.Random(3)
    corner = lambda: {c: r.uniform(-50, 50) for c in "xyz"}
    rings = [(i, 0, [corner() for _ in range(n)]) for i, n in enumerate([0, 1, 2, 3, 4, 4, 4, 5, 7])]
    rings += [(20, 0, [corner(), {"x": None, "y": 1.0, "z": 2.0}, corner()]), (21, 0, [{"x": 1.0, "y": 2.0, "z": 100.0}, corner(), corner()]), (22, 0, [{"x": 1.0, "y": 2.0, "z": 100.0}] * 3), (23, 0, [corner(), None]), (24, 0, None)]
    faces = spark.createDataFrame(rings, "bldg_id long, face_no int, ring array<struct<x:double,y:double,z:double>>")
    usual = lambda i, **more: tuple(({"id": i, "cx": 0.0, "cy": 0.0, "cz": 100.0, "o": 0.0, "p": 0.0, "k": 30.0, "w": 6000, "h": 4000, "sw": 36.0, "sh": 24.0, "f": 50.0, "px": 0.1, "py": -0.2} | more).values())
    photo = spark.createDataFrame([usual(1), usual(2, o=80.0, p=20.0), usual(3, sw=None), usual(4, sh=0.0), usual(5, f=-50.0), usual(6, cx=None), usual(7, w=-6000), usual(8, o=200.0)], PHOTO)
    seen = imaging.in_photos(faces, photo, distortion)
    want = seen.select(*imaging.FACE, "photo_id", *[f(g.field("image", c)).alias(f"{c}_{n}") for c in "uv" for n, f in (("min", F.array_min), ("max", F.array_max))])
    got = imaging.ends(faces, photo, distortion)
    assert got.columns == want.columns and got.count() == 14 * 8
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("name", ["projected_corners", "projected_distorted"])
def test_pairs_are_compiled(spark, name):
    """No lambda is run for a pair, and no method is too long to be compiled."""
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    df.collect()
    execution = df._jdf.queryExecution()
    nodes = execution.executedPlan().toString().split("\n")
    join = next(i for i, x in enumerate(nodes) if "NestedLoopJoin" in x)
    assert not any("lambda" in x for x in nodes[:join])
    sizes = [x.split("maxMethodCodeSize:")[1].split(";")[0] for x in execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")).split("\n") if "maxMethodCodeSize" in x]
    assert sizes and max(map(int, sizes)) < 8000


def test_pairs_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(imaging, "TASK_PAIRS", 500, raising=False)
    df = registry.queries()["projected_corners"](spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() >= 1200 * 10 // 500


@pytest.mark.parametrize("distortion", [None, (1e-3, 2e-3, 3e-2, 1e-3)])
def test_files_repeat_themselves(spark, tmp_path, monkeypatch, distortion):
    """Four doubles a row, of which a third is in another face's row of the same building and photo, however many tasks."""
    monkeypatch.setattr(imaging, "TASK_PAIRS", 4000)
    faces = meshes.rings(fixtures.table(spark, "/root/testdata/sf0.001", "corner"))
    found = imaging.ends(faces, fixtures.table(spark, "/root/testdata/sf0.01", "photo"), distortion)
    g.rounded(found, ENDS, 3).select(ENDS).write.option("parquet.enable.dictionary", "false").option("compression", "snappy").parquet(str(tmp_path / "ends"))
    assert sum(f.stat().st_size for f in (tmp_path / "ends").glob("*.parquet")) / (1200 * 100) < 22


def test_tiles_are_bounded(spark):
    """A building of many faces fills no tile alone, and a row of no tile is lost or doubled."""
    faces = spark.range(9000).selectExpr("cast(id as int) % 3000 face_no", "if(id < 3000, 0, id) bldg_id", "cast(id as double) x")
    tiles = imaging._tiles(faces, 5, 9000, 30)
    assert tiles.rdd.getNumPartitions() == 5
    got = [[tuple(f) for f in r.tile] for r in tiles.collect()]
    assert max(map(len, got)) <= 200 and all(t == sorted(t) for t in got)
    assert sorted(f for t in got for f in t) == sorted(map(tuple, faces.collect()))
    per_task = tiles.select(F.spark_partition_id().alias("p"), F.size("tile").alias("n")).groupBy("p").agg(F.sum("n").alias("n")).collect()
    assert len(per_task) == 5 and max(r.n for r in per_task) < 3000


def test_rounded_as_in_duckdb(spark):
    r = random.Random(5)
    given = [0.0005, 0.0015, -0.0005, 2.5005, 1.0005, 0.0, -1e-9, 4.5e15, -123456789012.3455, 0.00049999999999999994, None, *[r.uniform(-1e6, 1e6) for _ in range(300)], *[r.randrange(10**6) / 1000 + 0.0005 for _ in range(300)]]
    got = [x.c for x in g.rounded(spark.createDataFrame([(x,) for x in given], "c double"), ["c"], 3).collect()]
    assert got == [duckdb.execute("select round(?::double, 3)", [x]).fetchone()[0] for x in given]
