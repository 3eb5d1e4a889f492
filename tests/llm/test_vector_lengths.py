"""Links between vectors of any length."""

from __future__ import annotations

import numpy as np
import pytest

from shelfcast.llm import cap_links


def pairs(size, n, cosine, seed):
    draw = np.random.default_rng(seed)
    a, b = draw.standard_normal((2, n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize("size", [3, 11, 12, 16, 64, 96, 128, 384])
def test_pairs_share_a_filter(size):
    sides = [cap_links.passed(side) for side in pairs(size, 400, 0.93, size)]
    missed = sum(not len(np.intersect1d(x, y)) for x, y in zip(*sides))
    assert missed <= 0.02 * 400
    assert np.mean([len(x) for x in sides[0]]) < 200


def test_cap_at_64_is_as_measured():
    assert abs(cap_links.cap_of(64) - 0.50) < 1e-3


def test_links_of_several_lengths(spark):
    rows = []
    for size in (3, 16, 96, 128, 384):
        for a, b in zip(*pairs(size, 20, 0.95, size)):
            rows += [(len(rows) + 1, a.tolist(), len(rows)), (len(rows) + 2, b.tolist(), len(rows))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_links.link(table).collect()}
    assert found == {k: (1, k - (k + 1) % 2) for k in range(1, len(rows) + 1)}
