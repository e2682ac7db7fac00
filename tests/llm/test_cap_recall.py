"""Recall of the cap filters at the least cosine, by size of the table and dimension."""

import numpy as np
import pytest

from tilewright.llm import cap_filters


@pytest.mark.parametrize("dim", [2, 3, 8, 16, 64])
@pytest.mark.parametrize("n", [1_000, 1_600_000, 6_000_000])
def test_recall_does_not_fall(dim, n):
    code = cap_filters.fitted(n, dim, 0.93)
    assert cap_filters.trial(code, dim, 0.93, n=1_000, seed=2) >= 0.985


def test_pairs_of_few_dimensions(spark):
    rng = np.random.default_rng(3)
    a, b = (cap_filters.unit(rng.standard_normal((400, 8))) for _ in range(2))
    b = 0.9301 * a + np.sqrt(1 - 0.9301**2) * cap_filters.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    rows = [(2 * k + j, v[k].tolist(), k) for k in range(400) for j, v in enumerate((a, b))]
    got = cap_filters.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), code=None).collect()
    assert sum(r.n_links for r in got) >= 0.98 * 800
