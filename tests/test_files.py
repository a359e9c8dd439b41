"""Files, folders, logs and networks, by hand-made cases."""

import logging
import zipfile

import numpy as np
import pytest

from quoin.operators import networks, raster
from quoin.plans import settings
from quoin.sources import meshes, scratch, sinks


def test_obj_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        meshes.obj_folder(spark, str(tmp_path))
    (tmp_path / "b1.obj").write_bytes(b"v 0 0 0\nv 1 \xff2 3\r\n# Roof")
    (tmp_path / "c.txt").write_text("v 9 9 9")
    lines = meshes.obj_folder(spark, str(tmp_path))
    assert [(r.stem, r.x, r.y, r.z) for r in meshes.vertices(lines, "stem").orderBy("idx").collect()] == [("b1", 0, 0, 0), ("b1", 1, 2, 3)]
    assert meshes.file_lines(spark, str(tmp_path / "b1.obj")).count() == 3


def test_written_obj_and_mtl_are_read_back(spark, tmp_path):
    text = spark.createDataFrame([("a", "v 0 0 0\n"), ("b", "v 1 2 3\nv 4 5 6\n")], "k string, t string")
    files = text.selectExpr("concat(k, '.obj') name", "cast(t as binary) data").unionByName(text.select(sinks.F.concat("k", sinks.F.lit(".mtl")).alias("name"), sinks.mtl_text(sinks.F.col("k"), sinks.F.lit("x.png")).cast("binary").alias("data")))
    assert {r.name: r.n_bytes for r in sinks.write_files(files, str(tmp_path)).collect()}.keys() == {"a.obj", "b.obj", "a.mtl", "b.mtl"}
    assert meshes.vertices(meshes.obj_folder(spark, str(tmp_path)), "stem").count() == 3
    mtl = meshes.file_lines(spark, str(tmp_path / "*.mtl"))
    assert sorted((r.stem, r.name, r.map_kd) for r in meshes.materials(mtl, "stem").collect()) == [("a", "a", "x.png"), ("b", "b", "x.png")]


def test_orientation_and_camera_files(spark, tmp_path):
    (tmp_path / "o.tsv").write_text("file\tx\ty\tz\to\tp\tk\np1\t1\t2\t3\t4\t5\t6\np2\t1\t\t3\t4\t5\t6\n")
    assert [(r.file, r.ok) for r in meshes.orientation(spark, str(tmp_path / "o.tsv")).orderBy("file").collect()] == [("p1", True), ("p2", False)]
    (tmp_path / "c.tsv").write_text("a\n50\t36\t24\t6\t6\t0\t0\t1\t2\t3\n")
    r = meshes.camera(spark, str(tmp_path / "c.tsv")).first()
    assert (r.f, r.sensor_w, r.calibrated, r.complete) == (50, 36, True, True)


def test_image_files_by_suffix(spark, tmp_path):
    for n in ("a.TIF", "b.png", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert sorted(r.path[-5:] for r in meshes.image_files(spark, str(tmp_path)).select("path").collect()) == ["a.TIF", "b.png"]


def test_result_zip(tmp_path):
    for n in ("obj/a.obj", "appearance/a.png", "other/x"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(n)
    out = tmp_path / "result.zip"
    assert sinks.result_zip(str(tmp_path), str(out)) == ["appearance/a.png", "obj/a.obj"]
    assert zipfile.ZipFile(out).namelist() == ["appearance/a.png", "obj/a.obj"] and (tmp_path / "completed").exists()


def test_log_levels(tmp_path, capsys):
    root = logging.getLogger()
    before, level = list(root.handlers), root.level
    try:
        log = settings.set_up_log("INFO", str(tmp_path / "run.log"))
        log.debug("one")
        log.info("two")
        logging.getLogger("other").info("three")
        logging.getLogger("other").warning("four")
        said = capsys.readouterr().err
        assert "two" in said and "four" in said and "one" not in said and "three" not in said
        written = (tmp_path / "run.log").read_text()
        assert all(w in written for w in ("DEBUG quoin one", "INFO quoin two", "DEBUG other three", "INFO other four"))
    finally:
        for h in list(root.handlers):
            root.removeHandler(h)
            h.close()
        for h in before:
            root.addHandler(h)
        root.setLevel(level)


def test_settings_are_checked():
    with pytest.raises(ValueError):
        settings.checked(settings.merged({"InputDir": "x"}, {}))
    assert settings.checked(settings.merged({"InputDir": "x", "OutputDir": "y"}, {}))["Device"] == "cuda"


def test_scratch_folder(spark):
    assert scratch.folder(spark, "a") != scratch.folder(spark, "a")


def naive_conv(x, w, b, stride, pad):
    x = np.pad(x, ((0, 0), (pad, pad), (pad, pad)))
    k = w.shape[2]
    out = np.zeros((w.shape[0], (x.shape[1] - k) // stride + 1, (x.shape[2] - k) // stride + 1))
    for o in range(out.shape[0]):
        for i in range(out.shape[1]):
            for j in range(out.shape[2]):
                out[o, i, j] = (w[o] * x[:, i * stride : i * stride + k, j * stride : j * stride + k]).sum() + (0 if b is None else b[o])
    return out


def naive_up(x, w, stride, pad, extra):
    k, (c, h, n) = w.shape[2], x.shape
    out = np.zeros((w.shape[1], (h - 1) * stride + k + extra, (n - 1) * stride + k + extra))
    for a in range(c):
        for i in range(h):
            for j in range(n):
                out[:, i * stride : i * stride + k, j * stride : j * stride + k] += x[a, i, j] * w[a]
    return out[:, pad : out.shape[1] - pad, pad : out.shape[2] - pad]


def test_unet_by_hand():
    """Two levels, written out: the skip carries the activated way down."""
    w = networks.random_weights("unet", 2, downs=2, bands=1, seed=5)
    w = {k: v * 20 for k, v in w.items()}
    x = np.random.default_rng(1).normal(size=(1, 4, 4))
    leak = lambda v: np.where(v > 0, v, 0.2 * v)
    norm = lambda v: (v - v.mean(axis=(1, 2), keepdims=True)) / np.sqrt(v.var(axis=(1, 2), keepdims=True) + 1e-5)
    down = leak(naive_conv(x, w["down0.w"], None, 2, 1))
    low = naive_conv(down, w["down1.w"], None, 2, 1)
    up = norm(naive_up(np.maximum(low, 0), w["up1.w"], 2, 1, 0))
    want = np.tanh(naive_up(np.maximum(np.concatenate([down, up]), 0), w["up0.w"], 2, 1, 0))
    assert np.allclose(networks.unet_generator(x, w, 2), want)


def test_resnet_by_hand():
    w = {k: v * 5 for k, v in networks.random_weights("resnet", 2, 1, seed=2).items()}
    x = np.random.default_rng(3).normal(size=(3, 8, 8))
    norm = lambda v: (v - v.mean(axis=(1, 2), keepdims=True)) / np.sqrt(v.var(axis=(1, 2), keepdims=True) + 1e-5)
    edge = lambda v, n: np.pad(v, ((0, 0), (n, n), (n, n)), mode="reflect")
    y = np.maximum(norm(naive_conv(edge(x, 3), w["in.w"], None, 1, 0)), 0)
    for i in (1, 2):
        y = np.maximum(norm(naive_conv(y, w[f"down{i}.w"], None, 2, 1)), 0)
    z = np.maximum(norm(naive_conv(edge(y, 1), w["block0.0.w"], None, 1, 0)), 0)
    y = y + norm(naive_conv(edge(z, 1), w["block0.1.w"], None, 1, 0))
    for i in (1, 2):
        y = np.maximum(norm(naive_up(y, w[f"up{i}.w"], 2, 1, 1)), 0)
    assert np.allclose(networks.resnet_generator(x, w, 1), np.tanh(naive_conv(edge(y, 3), w["out.w"], None, 1, 0)))


def test_discriminators_losses_and_replay():
    r = np.random.default_rng(0)
    x = r.normal(size=(3, 32, 32))
    w = {"patch0.w": r.normal(size=(2, 3, 4, 4)), "patch1.w": r.normal(size=(4, 2, 4, 4)), "patch2.w": r.normal(size=(4, 4, 4, 4)), "patch3.w": r.normal(size=(4, 4, 4, 4)), "patch_out.w": r.normal(size=(1, 4, 4, 4)),
         "pixel0.w": r.normal(size=(2, 3, 1, 1)), "pixel1.w": r.normal(size=(4, 2, 1, 1)), "pixel_out.w": r.normal(size=(1, 4, 1, 1))}
    assert networks.patch_discriminator(x, w).shape == (1, 2, 2) and networks.pixel_discriminator(x, w).shape == (1, 32, 32)
    s = np.array([0.0, 2.0])
    assert networks.gan_loss(s, True) == 1 and networks.gan_loss(s, False) == 2 and networks.gan_loss(s, True, "wgangp") == -1
    assert networks.gan_loss(s, True, "vanilla") == pytest.approx((np.log(2) + np.log(1 + np.exp(-2))) / 2)
    assert networks.learning_rate(1, 99) == 1 and networks.learning_rate(1, 199) == pytest.approx(1 / 101) and networks.learning_rate(1, 60, "step") == 0.1 and networks.learning_rate(1, 100, "cosine") == 0
    pool = networks.Replay(2)
    given = [np.full(1, i) for i in range(50)]
    back = [int(pool.ask(g)[0]) for g in given]
    assert back[:2] == [0, 1] and all(b <= i for i, b in enumerate(back)) and any(b < i for i, b in enumerate(back)) and len(pool.held) == 2


def test_weights_and_enhancement(spark, tmp_path):
    np.savez(tmp_path / "w.npz", **{"a.w": np.ones(2), "a.running_mean": np.zeros(2)})
    assert set(networks.load_weights(str(tmp_path / "w.npz"))) == {"a.w"}
    image = np.random.default_rng(2).integers(0, 256, (16, 16, 3)).astype(np.uint8)
    rows = spark.createDataFrame([("k", 16, 16, 3, bytearray(image.tobytes()))], f"key string, {raster.IMAGE}")
    same = networks.enhance(rows, None, 16).first()
    assert np.abs(raster.to_array(same.height, same.width, same.channels, same.data).astype(int) - image).max() <= 1
    dark = networks.enhance(rows, lambda x: np.full_like(x, -1), 16).first()
    assert not any(dark.data)


def test_more_pixels():
    image = np.random.default_rng(4).integers(0, 256, (6, 9, 3)).astype(np.uint8)
    assert (raster.random_crop(image, 4, 1) == raster.random_crop(image, 4, 1)).all() and raster.random_crop(image, 4, 2).shape == (4, 4, 3)
    assert raster.limit_height(np.zeros((10, 7, 3), np.uint8), 4).shape == (4, 3, 3)  # 2.8 wide, rounded
    assert raster.window(image[:, :, :1], 0, 0, 9, 6).shape == (6, 9, 3) and (raster.window(image[:, :, :2], 0, 0, 9, 6) == 255).all()
    assert (raster.copy_box(raster.blank(6, 9), image, 2, 1, 3, 2)[1:3, 2:5] == image[1:3, 2:5]).all()
    assert raster.summary(np.array([1.0, 2, 6])) == {"mean": 3, "min": 1, "max": 6, "median": 2, "std": pytest.approx(np.sqrt(14 / 3))}
    x = raster.normalise(image)
    assert x.shape == (3, 6, 9) and np.abs(raster.denormalise(x).astype(int) - image).max() <= 1
