"""The halo equals the whole vector with tracks of one and two rows."""

from __future__ import annotations

import numpy as np
import pytest

from tests.test_tracks import brute, smoothed
from trackloom.operators import smoothing


@pytest.mark.parametrize("ids_at_once", [smoothing.IDS_AT_ONCE, 5, 1])
@pytest.mark.parametrize("seed", [None, 1, 2])
def test_short_tracks(spark, seed, ids_at_once, monkeypatch):
    """Also where ranges of ids hold fewer tracks than an extension needs."""
    monkeypatch.setattr(smoothing, "IDS_AT_ONCE", ids_at_once)
    traces = ["MIMMIM", "I", "MMIMII"]
    if seed:
        r = np.random.default_rng(seed)
        traces = ["".join(r.choice(["M", "I"], int(r.choice([1, 1, 1, 2, 2, 3, 6])))) for _ in range(150)]
    _, rows = smoothed(spark, traces)
    assert [r.semantic_smoothed for r in rows] == brute([101 if s == "M" else 1 for t in traces for s in t])
