"""Fairness, uncertainty, significance, attribution and drift operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelab.operators import attribution as L
from scorelab.operators import drift as D
from scorelab.operators import fairness as FA
from scorelab.operators import significance as K
from scorelab.operators import uncertainty as U


def _pair_scores(spark, same=False, n=300, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    pa = np.round(np.clip(0.3 + 0.4 * y + 0.2 * rng.normal(size=n), 0.01, 0.99), 3)
    pb = pa if same else np.round(np.clip(0.4 + 0.2 * y + 0.2 * rng.normal(size=n), 0.01, 0.99), 3)
    rows = []
    for i in range(n):
        rows.append(("a", "test", str(i), int(y[i]), float(pa[i]), int(pa[i] >= 0.5)))
        rows.append(("b", "test", str(i), int(y[i]), float(pb[i]), int(pb[i] >= 0.5)))
    return spark.createDataFrame(rows, "run string, split string, row_id string, y_true int, y_prob double, y_pred int")


def test_identical_models_not_significant(spark):
    s = _pair_scores(spark, same=True)
    pr = K.pair(s, "a", "b")
    assert K.mcnemar(pr, "a", "b").first().p_value == 1.0
    d = K.delong(pr, "a", "b").first()
    assert d.p_value == 1.0 and d.effect == 0.0


def test_delong_sign_and_ci(spark):
    pr = K.pair(_pair_scores(spark), "a", "b")
    d = K.delong(pr, "a", "b").first()
    assert d.effect > 0 and d.statistic > 0
    assert d.ci_low <= d.effect <= d.ci_high


def test_mcnemar_exact_small_discordance(spark):
    rows = []
    for i in range(40):
        yp_b = 0 if i < 5 else 1
        rows += [("a", "t", str(i), 1, 0.9, 1), ("b", "t", str(i), 1, 0.9 if yp_b else 0.1, yp_b)]
    s = spark.createDataFrame(rows, "run string, split string, row_id string, y_true int, y_prob double, y_pred int")
    m = K.mcnemar(K.pair(s, "a", "b"), "a", "b").first()
    assert m.method == "exact_binomial" and m.b == 5 and m.c == 0
    assert abs(m.p_value - 2.0 / 32.0) < 1e-12


def test_bh_monotone(spark):
    rows = [("t", "m", f"x{i}", "y", p) for i, p in enumerate([0.001, 0.01, 0.02, 0.04, 0.5, 0.03])]
    df = spark.createDataFrame(rows, "test string, metric string, model_a string, model_b string, p_value double")
    q = sorted((r.p_value, r.q_value) for r in K.bh_fdr(df).collect())
    assert all(q[i][1] <= q[i + 1][1] + 1e-15 for i in range(len(q) - 1))
    assert all(qq >= p for p, qq in q)


def test_bootstrap_runs_and_brackets(spark):
    pr = K.pair(_pair_scores(spark, n=200), "a", "b")
    r = {x.metric: x for x in K.paired_bootstrap(pr, "a", "b", reps=40, seed=1, weights="poisson").collect()}
    assert set(r) == set(K.BOOT_METRICS)
    a = r["auc_roc"]
    assert a.ci_low <= a.ci_high and a.n_valid <= 40


def test_power_grows_as_gap_shrinks(spark):
    g = spark.createDataFrame([(0.005,), (0.01,), (0.02,)], "auc_gap double")
    n = [r.n_required for r in K.min_n_for_auc_gap(g, 0.2211).orderBy("auc_gap").collect()]
    assert n[0] > n[1] > n[2]


def test_fairness_reference_is_largest(spark):
    rng = np.random.default_rng(3)
    rows = [("r", str(i), int(rng.random() < (0.4 if a == 1 else 0.1)), float(rng.random()), a) for i, a in enumerate([1] * 150 + [2] * 40)]
    s = spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double, SEX int")
    sub = FA.audit_attributes(s, ["SEX"])
    flags = {r.code: r.underpowered for r in sub.collect()}
    assert flags == {"1": False, "2": True}
    d = FA.disparity(sub).collect()
    assert all(r.ref_label == "Male" for r in d)


def test_uncertainty_bounds_and_signal_check(spark):
    rng = np.random.default_rng(5)
    rows = [(i, t, float(np.clip(rng.random(), 0.01, 0.99))) for i in range(60) for t in range(10)]
    mc = spark.createDataFrame(rows, "row_id long, t int, p double")
    lab = spark.createDataFrame([(i, i % 2) for i in range(60)], "row_id long, y_true int")
    u = U.uncertainty(mc, lab)
    for r in u.collect():
        assert 0 <= r.predictive_entropy <= np.log(2) + 1e-12
        assert r.mutual_info >= -1e-12
    with pytest.raises(ValueError):
        U.refuse_curve(u, signals=("nope",))
    rc = U.refuse_curve(u).collect()
    assert all(r.n_retained >= 20 for r in rc)


def test_rollout_rows_sum_to_one(spark):
    rng = np.random.default_rng(6)
    rows = []
    for layer in range(2):
        for rid in range(3):
            for h in range(2):
                m = rng.random((4, 4))
                m = m / m.sum(axis=1, keepdims=True)
                rows += [(layer, rid, h, i, j, float(m[i, j])) for i in range(4) for j in range(4)]
    attn = spark.createDataFrame(rows, "layer int, row_id long, head int, i int, j int, w double")
    r = L.attention_rollout(attn, 2).groupBy("row_id", "i").agg(F.sum("r").alias("s")).collect()
    assert all(abs(x.s - 1.0) < 1e-12 for x in r)
    sc = L.cls_scores(L.attention_rollout(attn, 2)).agg(F.sum("score")).first()[0]
    assert abs(sc - 1.0) < 1e-12


def test_table_diff_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.00005, "x"), (2, 2.1, "z")], "k int, v double, s string")
    r = {x.column: x.n_mismatch for x in D.table_diff(a, b, ["k"]).collect()}
    assert r["v"] == 1 and r["s"] == 1 and r["<only_left>"] == 0
