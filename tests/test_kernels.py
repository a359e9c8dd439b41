"""Pixel kernels, generators and text round trips by hand-made cases."""

import numpy as np

from quoin.operators import networks, raster
from quoin.sources import meshes, sinks


def test_window_is_white_outside():
    p = raster.window(np.zeros((4, 4, 3), np.uint8), 2, 2, 4, 4)
    assert p[0, 0, 0] == 0 and p[3, 3, 0] == 255


def test_homography_maps_its_points():
    src, dst = np.array([[0, 0], [4, 0], [4, 3], [0, 3.0]]), np.array([[1, 1], [9, 2], [8, 7], [0, 6.0]])
    q = np.hstack([src, np.ones((4, 1))]) @ raster.homography(src, dst).T
    assert np.allclose(q[:, :2] / q[:, 2:], dst)


def test_warp_and_letterbox():
    image = np.random.default_rng(0).integers(0, 256, (12, 20, 3)).astype(np.uint8)
    assert (raster.warp(image, np.eye(3), 20, 12) == image).all()
    boxed = raster.letterbox(image, 40)
    assert boxed.shape == (40, 40, 3) and not boxed[24:].any()
    assert raster.unletterbox(boxed, 12, 20).shape == image.shape


def test_cut_and_merge_round_trip():
    image = np.random.default_rng(1).integers(0, 256, (70, 50, 3)).astype(np.uint8)
    assert (raster.merge(raster.cut(image, 32, 0.25), 50, 70) == image).all()


def test_polygon_mask_and_dilate():
    mask = raster.polygon_mask(np.array([[1, 1], [6, 1], [6, 6], [1, 6]]), 8, 8)
    assert mask[3, 3] and not mask[0, 0] and raster.dilate(mask, 5)[0, 0]


def test_generators_keep_shape():
    x = np.random.default_rng(2).normal(size=(3, 32, 32))
    assert networks.resnet_generator(x, networks.random_weights("resnet", 4, 2), 2).shape == x.shape
    assert networks.unet_generator(x, networks.random_weights("unet", 4, downs=4), 4).shape == x.shape


def test_png_is_read_back(spark, tmp_path):
    image = np.random.default_rng(3).integers(0, 256, (5, 7, 3)).astype(np.uint8)
    (tmp_path / "a.png").write_bytes(sinks.png(image))
    r = meshes.images(spark, str(tmp_path)).first()
    assert (np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3) == image).all()


def test_obj_sections_and_materials(spark):
    text = "v 0 0 0\nv 1 0 0\nv 0 1 0\nvt 0 0\n# Roof\nusemtl a\nf 1/1 2/1 3/1\n# Wall\nf 1//4 2 3/1/2\n# Roof\nf 3 2 1"
    lines = meshes.text_lines(spark.createDataFrame([("x", text)], "k string, t string"), "k", "t")
    assert meshes.vertices(lines, "k").count() == 3
    rows = meshes.face_corners(lines, "k").orderBy("line_no", "seq").collect()
    assert [(r.label, r.pos, r.tex, r.norm) for r in rows] == [("Wall", 1, None, 4), ("Wall", 2, None, None), ("Wall", 3, 1, 2), ("Roof", 3, None, None), ("Roof", 2, None, None), ("Roof", 1, None, None)]
