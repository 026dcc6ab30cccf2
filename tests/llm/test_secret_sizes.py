"""The learned rule doesn't depend on how many credentials there are."""

import random
from collections import Counter

import pytest

from lakeviews.llm import secrets


def test_thresholds_agree_at_any_size(spark):
    r = random.Random(3)
    least = {}
    for n in (200, 200_000):
        shapes = Counter(secrets.shape("".join(r.choices("0123456789abcdef", k=40))) for _ in range(n))
        counted = spark.createDataFrame([("hex", s, k) for s, k in shapes.items()], "kind string, shape string, n long")
        table, least[n] = secrets.learned(secrets.save(counted, "secret-sizes"))["hex"]
        plain = secrets.likelihood(table, secrets.shape("plain-words.with.dots9"))
        assert plain < least[n] and secrets.likelihood(table, secrets.shape("0a1b2c3d4e5f60718293")) >= least[n] - 0.05
    assert least[200] == pytest.approx(least[200_000], abs=0.2)
