"""Profiles and the exact distributed median."""

import numpy as np
import pytest

from tripforge.operators import profile as P


@pytest.mark.parametrize("seed", [0, 1])
def test_exact_median_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    n = 5001 + seed
    a = rng.normal(size=n).round(3)
    b = np.where(rng.random(n) < 0.34, 7.0, rng.integers(0, 1000, n).astype(float))  # a third on one value
    c = np.full(n, 2.5)
    rows = [(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(8)
    got = P.exact_quantiles(df, ["a", "b", "c"], 0.5, digits=16)
    for name, arr in (("a", a), ("b", b), ("c", c)):
        assert got[name] == pytest.approx(float(np.quantile(arr, 0.5)), abs=1e-12)


def test_exact_median_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0), (None, None)], "a double, b double")
    got = P.exact_quantiles(df, ["a", "b"])
    assert got == {"a": None, "b": 2.0}


def test_numeric_stats_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 4.0, None), (4, 5.0, "z")],
                               "i int, d double, s string")
    stats = {r.column_name: r for r in P.numeric_stats(df).collect()}
    assert set(stats) == {"i", "d"}                          # strings are not numbers
    assert (stats["i"].min, stats["i"].max, stats["i"].mean, stats["i"].p50) == (1.0, 4.0, 2.5, 2.5)
    assert stats["d"].p50 == 4.0
    nulls = {r.column_name: r.null_fraction for r in P.null_fractions(df).collect()}
    assert nulls == {"i": 0.0, "d": 0.25, "s": 0.25}
    prof = {r.column_name: r for r in P.profile(df).collect()}
    assert prof["s"].dtype == "string" and prof["s"].p50 is None


def test_head_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in P.head_sample(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert P.head_sample(df, 0).count() == 100


@pytest.mark.parametrize("seed", [0, 3])
def test_skewed_spreads_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    n = 4000
    a = rng.exponential(size=n) * 1000          # skewed spread
    b = np.where(rng.random(n) < 0.4, -3.0, rng.normal(size=n))   # heavy tie
    c = np.concatenate([rng.normal(size=n - 1), [1e12]])           # extreme outlier
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)],
                               "a double, b double, c double")
    bounds = {k: (float(v.min()), float(v.max())) for k, v in (("a", a), ("b", b), ("c", c))}
    got = P.exact_quantiles(df, ["a", "b", "c"], 0.5, bounds=bounds, digits=64)
    for name, arr in (("a", a), ("b", b), ("c", c)):
        assert got[name] == pytest.approx(float(np.quantile(arr, 0.5)), abs=1e-9)


def test_nan_is_missing_and_odd_values_and_names_pass(spark):
    df = spark.createDataFrame([(1.0, 4.0), (float("nan"), float("inf")), (3.0, 6.0)], "`a.b` double, y double")
    rows = {r.column_name: r for r in P.profile(df).collect()}
    assert (rows["a.b"].null_fraction, rows["a.b"].min, rows["a.b"].max, rows["a.b"].mean, rows["a.b"].p50) == (0.3333, 1.0, 3.0, 2.0, 2.0)
    assert (rows["y"].max, rows["y"].mean, rows["y"].p50) == (float("inf"), float("inf"), 6.0)
    assert {r.column_name: r.null_fraction for r in P.null_fractions(df).collect()} == {"a.b": 0.3333, "y": 0.0}
    assert [r.p50 for r in P.numeric_stats(df, ["a.b"]).collect()] == [2.0]


def _sized(seed):
    """Doubles of every exponent, ties, infinities, subnormals and both zeros."""
    rng = np.random.default_rng(seed)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308, -1.7976931348623157e308,
           float("inf"), float("-inf"), 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2)]
    powers = [float(np.nextafter(2.0 ** e, d)) for e in range(-1074, 1024, 37) for d in (0.0, np.inf)] + [2.0 ** e for e in range(-1074, 1024, 41)]
    bits = rng.integers(0, 2 ** 63, 2000, dtype=np.uint64).view(np.float64)
    some = [float(x) for x in np.where(rng.random(2000) < 0.5, bits, -bits) if not np.isnan(x)]
    return [float(x) for x in odd + powers + some]


def test_keys_are_the_bits_of_doubles(spark):
    values = _sized(1)
    rows = P.with_ordered_key(spark.createDataFrame([(v,) for v in values], "v double")).collect()
    assert all(r.key == P.ordered_key(r.v) and P.value_of_key(r.key) == r.v for r in rows) and len(rows) == len(values)
    by_value, by_key = sorted(set(values)), sorted({r.key for r in rows})
    assert [P.value_of_key(k) for k in by_key] == by_value


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_quantiles_of_any_doubles(spark, q):
    values = _sized(2)
    df = spark.createDataFrame([(v, float(i % 2) or float("inf")) for i, v in enumerate(values)], "a double, b double").repartition(4)
    got = P.exact_quantiles(df, ["a", "b"], q, digits=8)                  # many passes
    for name, x in (("a", sorted(values)), ("b", sorted([1.0, float("inf")][i % 2 == 0] for i in range(len(values))))):
        pos = (len(x) - 1) * q
        lo, share = int(pos), pos - int(pos)
        hi = min(lo + 1, len(x) - 1)
        want = x[lo] if x[lo] == x[hi] or not share else x[lo] + (x[hi] - x[lo]) * share
        assert got[name] == (None if np.isnan(want) else want)


def test_same_path_at_every_size(spark):
    """One value, two, a tie over all rows, and infinities on both sides."""
    inf = float("inf")
    for xs, want in (([3.0], 3.0), ([3.0, 4.0], 3.5), ([7.0] * 9, 7.0), ([-inf, inf], None), ([-inf, -inf, 1.0], -inf), ([inf, inf], inf)):
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        assert P.exact_quantiles(df, ["x"]) == {"x": want}
