"""Quantiles by refinement against NumPy, with a hot group, ties and wide ranges."""

import numpy as np
import pytest

from venuelens.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("bins", [4, 4096])
def test_equal_numpy(spark, bins):
    rng = np.random.default_rng(bins)
    groups = {"hot": np.round(rng.uniform(-50, 50, 900), 2), "ties": np.full(40, 7.25), "one": np.array([3.5]), "wide": np.array([0.01, 1e6, 5.0, -1e5]),
              "two": np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("hot", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, p double").repartition(6)
    got = {r.g: (r.a, r.m, r.z) for r in exact_quantiles(df, ["g"], "p", {"a": 0.25, "m": 0.5, "z": 0.9}, bins).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g] == pytest.approx(tuple(np.quantile(xs, [0.25, 0.5, 0.9])), abs=1e-9)


def test_no_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, p double"), ["g"], "p", {"m": 0.5}).count() == 0
