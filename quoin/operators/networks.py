"""Image-to-image generators for inference, in numpy, applied to images an Arrow batch at a time.

Weights come as a mapping of layer names to arrays; `random_weights` makes some of the right shapes for
tests. Trained weights are not part of this library, and training is out of scope.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from . import raster


def conv(x: np.ndarray, w: np.ndarray, b: np.ndarray | None = None, stride: int = 1, pad: int = 0) -> np.ndarray:
    """x: channels x height x width; w: out x in x k x k."""
    x = np.pad(x, ((0, 0), (pad, pad), (pad, pad))) if pad else x
    v = np.lib.stride_tricks.sliding_window_view(x, w.shape[2:], axis=(1, 2))[:, ::stride, ::stride]
    y = np.tensordot(w, v, axes=([1, 2, 3], [0, 3, 4]))
    return y if b is None else y + b[:, None, None]


def conv_transposed(x: np.ndarray, w: np.ndarray, b: np.ndarray | None = None, stride: int = 2, pad: int = 1, out_pad: int = 1) -> np.ndarray:
    """w: in x out x k x k; the adjoint of a strided convolution."""
    k = w.shape[2]
    c, h, n = x.shape
    wide = np.zeros((c, (h - 1) * stride + 1, (n - 1) * stride + 1), dtype=x.dtype)
    wide[:, ::stride, ::stride] = x
    lead = k - 1 - pad
    wide = np.pad(wide, ((0, 0), (lead, lead + out_pad), (lead, lead + out_pad)))
    return conv(wide, w.transpose(1, 0, 2, 3)[:, :, ::-1, ::-1], b)


def instance_norm(x: np.ndarray, eps: float = 1e-5) -> np.ndarray:
    return (x - x.mean(axis=(1, 2), keepdims=True)) / np.sqrt(x.var(axis=(1, 2), keepdims=True) + eps)


def relu(x: np.ndarray, slope: float = 0.0) -> np.ndarray:
    return np.where(x > 0, x, slope * x)


def reflect(x: np.ndarray, n: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (n, n), (n, n)), mode="reflect")


def resnet_generator(x: np.ndarray, weights: dict[str, np.ndarray], blocks: int = 9) -> np.ndarray:
    """7x7, two halvings, residual blocks, two doublings, 7x7 and tanh; instance norm without affine, ReLU."""
    g = lambda n: (weights[f"{n}.w"], weights.get(f"{n}.b"))
    x = relu(instance_norm(conv(reflect(x, 3), *g("in"))))
    for i in (1, 2):
        x = relu(instance_norm(conv(x, *g(f"down{i}"), stride=2, pad=1)))
    for i in range(blocks):
        y = relu(instance_norm(conv(reflect(x, 1), *g(f"block{i}.0"))))
        x = x + instance_norm(conv(reflect(y, 1), *g(f"block{i}.1")))
    for i in (1, 2):
        x = relu(instance_norm(conv_transposed(x, *g(f"up{i}"))))
    return np.tanh(conv(reflect(x, 3), *g("out")))


def unet_generator(x: np.ndarray, weights: dict[str, np.ndarray], downs: int = 8) -> np.ndarray:
    """4x4 halvings and doublings with skips joined by channel, LeakyReLU 0.2 down, ReLU up, tanh out."""
    g = lambda n: (weights[f"{n}.w"], weights.get(f"{n}.b"))

    def level(x: np.ndarray, i: int) -> np.ndarray:
        x = x if i == 0 else relu(x, 0.2)  # the skip carries what the way down is given
        y = conv(x, *g(f"down{i}"), stride=2, pad=1)
        if i < downs - 1:
            y = level(instance_norm(y) if i else y, i + 1)
        z = conv_transposed(relu(y), *g(f"up{i}"), out_pad=0)
        return np.tanh(z) if i == 0 else np.concatenate([x, instance_norm(z)])

    return level(x, 0)


def patch_discriminator(x: np.ndarray, weights: dict[str, np.ndarray], layers: int = 3) -> np.ndarray:
    """4x4 convolutions, the first `layers` of stride 2, LeakyReLU 0.2, instance norm but for the first; a one-channel map out."""
    g = lambda n: (weights[f"{n}.w"], weights.get(f"{n}.b"))
    x = relu(conv(x, *g("patch0"), stride=2, pad=1), 0.2)
    for i in range(1, layers + 1):
        x = relu(instance_norm(conv(x, *g(f"patch{i}"), stride=2 if i < layers else 1, pad=1)), 0.2)
    return conv(x, *g("patch_out"), pad=1)


def pixel_discriminator(x: np.ndarray, weights: dict[str, np.ndarray]) -> np.ndarray:
    """Three 1x1 convolutions, each pixel by itself but for the instance norm."""
    g = lambda n: (weights[f"{n}.w"], weights.get(f"{n}.b"))
    x = relu(conv(x, *g("pixel0")), 0.2)
    return conv(relu(instance_norm(conv(x, *g("pixel1"))), 0.2), *g("pixel_out"))


def gan_loss(score: np.ndarray, real: bool, mode: str = "lsgan") -> float:
    """How far a discriminator's map is from what it ought to say: squared, logistic, or the signed mean."""
    if mode == "lsgan":
        return float(((score - (1.0 if real else 0.0)) ** 2).mean())
    if mode == "vanilla":
        return float(np.logaddexp(0.0, -score if real else score).mean())
    if mode == "wgangp":
        return float(-score.mean() if real else score.mean())
    raise ValueError(f"unknown loss {mode!r}")


def learning_rate(base: float, epoch: int, kind: str = "linear", steady: int = 100, falling: int = 100, every: int = 50) -> float:
    """The rate of an epoch, counted from 0: falling in a line after the steady ones, a tenth after every so many, or by half a cosine."""
    if kind == "linear":
        return base * (1.0 - max(0, epoch + 1 - steady) / (falling + 1))
    if kind == "step":
        return base * 0.1 ** (epoch // every)
    if kind == "cosine":
        return base * (1 + np.cos(np.pi * epoch / steady)) / 2
    raise ValueError(f"unknown schedule {kind!r}")


class Replay:
    """Up to `size` images of before; once full, one asked for is given itself or, half the time, an old one whose place it takes."""

    def __init__(self, size: int, seed: int = 0) -> None:
        self.size, self.held, self.draw = size, [], np.random.default_rng(seed)

    def ask(self, image: np.ndarray) -> np.ndarray:
        if len(self.held) < self.size:
            self.held.append(image)
            return image
        if not self.size or self.draw.random() <= 0.5:
            return image
        at = int(self.draw.integers(self.size))
        old, self.held[at] = self.held[at], image
        return old


def random_weights(kind: str = "resnet", width: int = 64, blocks: int = 9, downs: int = 8, bands: int = 3, seed: int = 0) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    shape: dict[str, tuple[int, ...]] = {}
    if kind == "resnet":
        shape = {"in": (width, bands, 7, 7), "down1": (2 * width, width, 3, 3), "down2": (4 * width, 2 * width, 3, 3), "up1": (4 * width, 2 * width, 3, 3), "up2": (2 * width, width, 3, 3), "out": (bands, width, 7, 7)}
        shape |= {f"block{i}.{j}": (4 * width, 4 * width, 3, 3) for i in range(blocks) for j in (0, 1)}
    else:
        c = [bands] + [min(8, 2**i) * width for i in range(downs)]
        for i in range(downs):
            shape[f"down{i}"] = (c[i + 1], c[i], 4, 4)
            shape[f"up{i}"] = (c[i + 1] * (1 if i == downs - 1 else 2), bands if i == 0 else c[i], 4, 4)
    return {f"{n}.w": r.normal(0, 0.02, s).astype(np.float32) for n, s in shape.items()}


def load_weights(path: str) -> dict[str, np.ndarray]:
    """Weights from an .npz file of layer arrays; running statistics of norms without them are left out."""
    with np.load(path) as f:
        return {k: f[k] for k in f.files if not k.endswith((".running_mean", ".running_var", ".num_batches_tracked"))}


def enhance(images: DataFrame, generator: Callable[[np.ndarray], np.ndarray] | None = None, size: int = 256, key: str = "key string") -> DataFrame:
    """Letterbox, swap channels, normalise, generate, and all of it back; the identity without a generator."""

    def one(image: np.ndarray) -> np.ndarray:
        x = raster.normalise(raster.swap_channels(raster.letterbox(image, size)))
        y = generator(x) if generator else x
        return raster.unletterbox(raster.swap_channels(raster.denormalise(y)), image.shape[0], image.shape[1])

    return raster.map_images(images, one, key)
