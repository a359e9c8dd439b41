"""Photos of all suppliers, and the join on footprints against every pair of face and photo."""

import random

import pytest
from pyspark.sql import functions as F

from quoin.operators import faces, imaging
from quoin.sources import fixtures

SF = "/root/testdata/sf0.01"


def test_every_supplier_is_a_photo(spark):
    assert fixtures.table(spark, SF, "photo").count() == spark.read.parquet(f"{SF}/supplier.parquet").count() == 100


def rows(seen):
    return sorted((r.bldg_id, r.face_no, r.photo_id, round(r.area, 6)) for r in imaging.visible(seen).select("bldg_id", "face_no", "photo_id", "area").collect())


@pytest.mark.parametrize("tilt", [2, 180])
def test_footprints_lose_no_photo(spark, tilt):
    """Photos that look down, aslant with unlike focal lengths, and to all sides from between the roofs."""
    r = random.Random(tilt)
    rings = faces.rings(fixtures.table(spark, "/root/testdata/sf0.001", "corner")).cache()
    given = [(i, r.uniform(0, 800), r.uniform(0, 100), r.uniform(5, 500), r.uniform(-tilt, tilt), r.uniform(-tilt, tilt), r.uniform(0, 360), 6000, 4000, 36.0, 24.0, r.choice([0.5, 20.0, 50.0]), r.uniform(-3, 3), r.uniform(-3, 3)) for i in range(12)]
    photo = spark.createDataFrame(given, "photo_id long, cx double, cy double, cz double, omega_deg double, phi_deg double, kappa_deg double, w int, h int, sensor_w double, sensor_h double, f double, ppx double, ppy double")
    want = rows(imaging.in_photos(rings, photo))
    assert want and rows(imaging.in_view(rings, photo)) == want


def test_no_faces(spark):
    none = faces.rings(fixtures.table(spark, "/root/testdata/sf0.001", "corner").where(F.lit(False)))
    assert imaging.in_view(none, fixtures.table(spark, "/root/testdata/sf0.001", "photo")).count() == 0
