"""The sampled pieces at the ends of the draw's range."""

import numpy as np
import pytest

from quoin.llm import lattice

MODEL = "piece_bpe_32k.model"


@pytest.mark.parametrize("draw", [0.0, 1 - 2.0**-25, 1 - 2.0**-53])
def test_extreme_draws_lose_nothing(monkeypatch, draw):
    texts = ["there", "a bc", "x", "internationally known é▁", "qzxjv " * 5]
    monkeypatch.setattr(lattice, "_uniform", lambda keys, places: np.full(len(keys), draw))
    ids, at = lattice.sample(texts, np.arange(len(texts), dtype=np.uint64), lattice.pieces(MODEL, 1.0))
    assert lattice.decode(ids, at, lattice.pieces(MODEL, 1.0)) == [t.encode() for t in texts]
