"""Distribution helpers and the distributed prefix-sum / quantile primitives."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorelab.functions import dist
from scorelab.functions.ranks import exact_quantiles, prefix_sums


def test_erf_matches_math(spark):
    xs = [-3.0, -1.234, -0.1, 0.0, 0.5, 1.234, 2.5, 5.9, 7.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(dist.erf("x")).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erf(x)) < 1e-13


def test_chi2_sf_known_values(spark):
    # chi2.sf(3.841459, 1) = 0.05 ; sf(5.991465, 2) = 0.05 ; sf(11.070498, 5) = 0.05 ; sf(16.918978, 9) = 0.05
    rows = [(3.841459, 1), (5.991465, 2), (11.070498, 5), (16.918978, 9), (0.0, 3)]
    df = spark.createDataFrame(rows, "x double, k int")
    got = [r[0] for r in df.select(dist.chi2_sf("x", "k")).collect()]
    for g, want in zip(got, [0.05, 0.05, 0.05, 0.05, 1.0]):
        assert abs(g - want) < 1e-6


def test_t_sf2_known_values(spark):
    # two-sided p of t with dof: t=2.776445 (4) -> 0.05 ; t=2.228139 (10) -> 0.05 ; t=12.706205 (1) -> 0.05 ; t=4.302653 (2) -> 0.05
    rows = [(2.776445, 4), (2.228139, 10), (12.706205, 1), (4.302653, 2)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, d int").select(dist.t_sf2("t", "d")).collect()]
    for g in got:
        assert abs(g - 0.05) < 1e-6


def test_binom_cdf_half(spark):
    rows = [(0, 5), (2, 5), (3, 10), (12, 24)]
    got = [r[0] for r in spark.createDataFrame(rows, "k int, n int").select(dist.binom_cdf_half("k", "n")).collect()]
    for (k, n), g in zip(rows, got):
        want = sum(math.comb(n, i) for i in range(k + 1)) / 2 ** n
        assert abs(g - want) < 1e-12


def test_prefix_sums_equal_plain_window(spark):
    rng = np.random.default_rng(0)
    rows = [(int(g), float(v), 1) for g, v in zip(rng.integers(0, 3, 500), rng.normal(size=500))]
    df = spark.createDataFrame(rows, "g int, v double, c int").groupBy("g", "v").agg(F.sum("c").alias("c"))
    got = {(r.g, r.v): (r.cum_c, r.tot_c) for r in prefix_sums(df, ["g"], "v", ["c"], n_buckets=4).collect()}
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("g", "v", F.sum("c").over(w).alias("cum"), F.sum("c").over(Window.partitionBy("g")).alias("tot")).collect()
    assert len(got) == len(ref)
    for r in ref:
        assert got[(r.g, r.v)] == (r.cum, r.tot)


def test_prefix_sums_value_range(spark):
    rows = [(0, i / 100.0, 1) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, v double, c int")
    got = sorted((r.v, r.cum_c) for r in prefix_sums(df, ["g"], "v", ["c"], n_buckets=7, value_range=(0.0, 1.0)).collect())
    assert [c for _, c in got] == list(range(1, 101))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(size=301), 3)
    df = spark.createDataFrame([(0, float(v)) for v in vals], "g int, x double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.q: r.x for r in exact_quantiles(df, ["g"], "x", qs, n_buckets=3).collect()}
    for q in qs:
        assert abs(got[q] - float(np.quantile(vals, q))) < 1e-12
