"""Scored-row metrics against brute force and analytic identities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelab.operators import calibrate as C
from scorelab.operators import metrics as M


def _scores(spark, n=400, seed=0, ties=True):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    p = np.clip(0.3 + 0.4 * y + 0.25 * rng.normal(size=n), 0.01, 0.99)
    if ties:
        p = np.round(p, 2)
    rows = [("r", str(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double"), y, p


def _auc_brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap_brute(y, p):
    order = np.argsort(-p, kind="mergesort")
    thr = np.unique(p)[::-1]
    P = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in thr:
        sel = p >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        r = tp / P
        ap += (r - prev_r) * prec
        prev_r = r
    del order
    return ap


def test_auc_and_ap_tie_aware(spark):
    df, y, p = _scores(spark)
    r = M.rank_metrics(df, ["run"]).first()
    assert abs(r.auc_roc - _auc_brute(y, p)) < 1e-12
    assert abs(r.auc_pr - _ap_brute(y, p)) < 1e-12


def test_auc_null_for_single_class(spark):
    df = spark.createDataFrame([("r", "1", 1, 0.3), ("r", "2", 1, 0.6)], "run string, row_id string, y_true int, y_prob double")
    assert M.rank_metrics(df, ["run"]).first().auc_roc is None


def test_threshold_sweep_matches_confusion(spark):
    df, y, p = _scores(spark, seed=2)
    taus = [0.2, 0.35, 0.5, 0.65]
    sw = {r.tau: r for r in M.threshold_sweep(df, taus, ["run"]).collect()}
    for t in taus:
        c = M.rates(M.confusion(df, t, ["run"])).first()
        assert (sw[t].tp, sw[t].fp, sw[t].tn, sw[t].fn) == (c.tp, c.fp, c.tn, c.fn)
        assert abs(sw[t].f1 - c.f1) < 1e-12


def test_ece_zero_when_calibrated_bins(spark):
    # every bin's mean label equals its mean score
    rows = [("r", f"{i}", int(i % 10 < 3), 0.3) for i in range(100)] + [("r", f"x{i}", int(i % 10 < 8), 0.8) for i in range(100)]
    df = spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double")
    assert abs(M.ece(df, 15, ["run"]).first().ece) < 1e-12


def test_brier_decomposition_identity(spark):
    df, y, p = _scores(spark, n=600, seed=3)
    d = C.brier_decomposition(df, 10, ["run"]).first()
    # with scores constant inside bins the identity is exact; here it holds approximately
    assert abs(d.brier - (d.reliability - d.resolution + d.uncertainty)) < 0.02
    mce = C.max_calibration_error(df, 10, ["run"]).first().mce
    ece = C.calibration_error(df, 10, ["run"]).first().ece
    assert mce >= ece


def test_temperature_lowers_ece_on_overconfident(spark):
    rng = np.random.default_rng(4)
    z = rng.normal(0, 1.5, 3000)
    y = (rng.random(3000) < 1 / (1 + np.exp(-z))).astype(int)
    p = 1 / (1 + np.exp(-2 * z))
    rows = [("r", str(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double")
    t = C.fit_temperature(df, ["run"])
    temp = t.first().temperature
    assert 1.5 < temp < 2.6
    before = C.calibration_error(df, 10, ["run"]).first().ece
    after = C.calibration_error(C.apply_temperature(df, t, ["run"]), 10, ["run"]).first().ece
    assert after < before


def test_ensemble_mean_and_label_check(spark):
    rows = [(r, s, str(i), i % 2, p) for i, (pa, pb) in enumerate([(0.2, 0.4), (0.9, 0.7)]) for r, p in (("a", pa), ("b", pb)) for s in ("test",)]
    df = spark.createDataFrame(rows, "run string, split string, row_id string, y_true int, y_prob double")
    e = {r.row_id: r.y_prob for r in M.ensemble(df, ["a", "b"]).collect()}
    assert abs(e["0"] - 0.3) < 1e-12 and abs(e["1"] - 0.8) < 1e-12
    bad = df.withColumn("y_true", F.when((F.col("run") == "b") & (F.col("row_id") == "0"), 1).otherwise(F.col("y_true")))
    with pytest.raises(Exception):
        M.ensemble(bad, ["a", "b"]).collect()
    with pytest.raises(ValueError):
        M.ensemble(df, ["a"])


def test_aggregate_runs_nan_propagates(spark):
    df = spark.createDataFrame([("m", 0.5), ("m", float("nan")), ("k", 0.2), ("k", 0.4)], "metric string, value double")
    r = {x.metric: x for x in M.aggregate_runs(df).collect()}
    assert np.isnan(r["m"].mean)
    assert abs(r["k"].std - np.std([0.2, 0.4], ddof=1)) < 1e-12
