"""Exact distributed quantiles against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.operators.encode import fit_numeric_bins
from jobtide.operators.quantiles import OrderStats, quantiles


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    rows = [(float(rng.normal()), float(rng.integers(0, 5)), None if i % 3 else float(i)) for i in range(5000)]
    rows += [(float("nan"), None, None)]
    return spark.createDataFrame(rows, "a double, b double, c double").repartition(5)


def test_quantiles_interpolate(frame):
    ps = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    got = OrderStats(frame, {n: F.col(n) for n in "abc"}).quantiles({n: ps for n in "abc"})
    for n in "abc":
        x = np.array([r[0] for r in frame.select(n).collect() if r[0] is not None], dtype=float)
        assert np.allclose(got[n], np.quantile(x[~np.isnan(x)], ps), rtol=1e-12)


def test_empty_column_has_none(frame):
    assert quantiles(frame.limit(0), "a", [0.5]) == [None]


def test_bins_equal_percentile_of_clipped_and_filled(frame):
    bins = fit_numeric_bins(frame, ["a", "b", "c"])
    for n in "abc":
        x = np.array([np.nan if r[0] is None else r[0] for r in frame.select(n).collect()], dtype=float)
        q1, q3 = np.nanquantile(x, [0.25, 0.75])
        x = np.clip(x, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        m = np.nanmedian(x)
        assert bins[n].median == pytest.approx(m)
        x = np.where(np.isnan(x), m, x)
        assert np.allclose(bins[n].edges, sorted(set(np.quantile(x, np.arange(11) / 10))), rtol=1e-12)
