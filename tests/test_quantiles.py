import math
import random

import numpy as np
import pytest

from cohortlake.functions import quantiles
from cohortlake.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.001, 0.25, 0.5, 0.77, 0.95, 0.999, 1.0]


def columns(n):
    rng = random.Random(4)
    wide = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(n)]
    return {
        "hot": [5.0 if rng.random() < 0.6 else rng.gauss(0, 1) for _ in range(n)],
        "wide": wide,
        "edge": [rng.choice([1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, -0.0, 1.0]) for _ in range(n)],
        "near": [1e15 + rng.randint(0, 50) for _ in range(n)],
        "a.b": [float(rng.randint(400, 799)) for _ in range(n)],
        "one": [3.5] * n,
    }


@pytest.mark.parametrize("few", [1, 40, 5_000])
def test_quantiles_are_those_of_all_values(spark, monkeypatch, few):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "PARTS", 16 if few == 1 else 2048)
    data = columns(1500)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"`{c}` double" for c in data))
    got = exact_quantiles(df, {c: PROBS for c in data})
    for c, values in data.items():
        ordered = sorted(values)
        for p, v in zip(PROBS, got[c]):
            at = (len(ordered) - 1) * p
            a, b = ordered[math.floor(at)], ordered[math.ceil(at)]
            assert v == (a if a == b else a + (at - math.floor(at)) * (b - a)), (c, p)


def test_missing_and_infinite_values(spark):
    rows = [(float(i), None) for i in range(5)] + [(None, None), (math.nan, None), (math.inf, None), (-math.inf, None)]
    df = spark.createDataFrame(rows, "x double, none double")
    got = exact_quantiles(df, {"x": [0.0, 0.5, 6 / 7, 1.0], "none": [0.5]})
    assert got["x"][:3] == [-math.inf, pytest.approx(2.5), math.inf] and math.isnan(got["x"][3]) and got["none"] == [None]
    assert exact_quantiles(df.where("false"), {"x": [0.5]}) == {"x": [None]}
    ints = exact_quantiles(spark.range(1, 100_001), {"id": [0.5, 0.95]})
    assert ints["id"] == list(np.percentile(np.arange(1, 100_001), [50, 95]))
