"""Registered queries: calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import logit, sigmoid
from ..operators import calibrate as C
from ..operators.metrics import kept, weighted
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

BY = ["run", "split"]
BY1 = ["run"]
BUNDLE_COLS = ["auc_roc", "ece_equal_width", "ece_equal_mass", "mce", "brier", "reliability", "resolution", "uncertainty", "brier_skill_score"]


def S(spark, sf):
    return fx.scores(spark, sf, attributes=False)


def W(body: str, *extra) -> str:
    return Q.with_fixtures(body, "scores", extra=list(extra))


@case(
    "h1_clip_logit_sigmoid",
    W(f"select run, split, sum({Q.logit_sql('y_prob')}) as sum_logit, min({Q.logit_sql('y_prob')}) as min_logit, "
      f"max({Q.logit_sql('y_prob')}) as max_logit, sum({Q.sigmoid_sql(Q.logit_sql('y_prob') + ' / 2.0')}) as sum_sig_half "
      "from scores group by run, split"),
    doubles=["sum_logit", "min_logit", "max_logit", "sum_sig_half"],
)
def q_h1(spark, sf):
    z = logit("y_prob", C.EPS)
    return S(spark, sf).groupBy(*BY).agg(
        F.sum(z).alias("sum_logit"), F.min(z).alias("min_logit"), F.max(z).alias("max_logit"),
        F.sum(sigmoid(z / F.lit(2.0))).alias("sum_sig_half"),
    )


@case("h6_equal_width_bins", W("select run, split, bin, cast(n as bigint) as n, sp / n as confidence, sy / n as frequency from ("
                               + Q.binned("scores", BY, 10) + ") b"), doubles=["confidence", "frequency"])
def q_h6(spark, sf):
    b = C.binned(S(spark, sf), 10, BY)
    return b.select(*BY, "bin", F.col("n").cast("long").alias("n"), (F.col("sp") / F.col("n")).alias("confidence"), (F.col("sy") / F.col("n")).alias("frequency"))


@case("h7_equal_mass_bins", W("select run, split, bin, cast(n as bigint) as n, sp / n as confidence, sy / n as frequency from ("
                              + Q.binned("scores", BY, 10, "equal_mass") + ") b"), doubles=["confidence", "frequency"])
def q_h7(spark, sf):
    b = C.binned(S(spark, sf), 10, BY, "equal_mass")
    return b.select(*BY, "bin", F.col("n").cast("long").alias("n"), (F.col("sp") / F.col("n")).alias("confidence"), (F.col("sy") / F.col("n")).alias("frequency"))


@case("h8_ece_strategies", W("select a.run, a.split, a.ece as ece_equal_width, b.ece as ece_equal_mass from (" + Q.calib_error("scores", BY, 10, "equal_width")
                             + ") a join (" + Q.calib_error("scores", BY, 10, "equal_mass") + ") b on a.run = b.run and a.split = b.split"),
      doubles=["ece_equal_width", "ece_equal_mass"])
def q_h8(spark, sf):
    s = S(spark, sf)
    a = C.calibration_error(s, 10, BY, "equal_width").withColumnRenamed("ece", "ece_equal_width")
    b = C.calibration_error(s, 10, BY, "equal_mass").withColumnRenamed("ece", "ece_equal_mass")
    return a.join(b, BY)


@case("h9_mce", W(Q.mce("scores", BY, 10)), doubles=["mce"])
def q_h9(spark, sf):
    return C.max_calibration_error(S(spark, sf), 10, BY)


@case("h10_brier_decomposition", W(Q.brier_decomp("scores", BY, 10)), doubles=["reliability", "resolution", "uncertainty", "brier"])
def q_h10(spark, sf):
    return C.brier_decomposition(S(spark, sf), 10, BY)


@case("h11_calibration_bundle", W(Q.calib_bundle("scores", BY, 10)), doubles=BUNDLE_COLS)
def q_h11(spark, sf):
    return C.calibration_bundle(S(spark, sf), 10, BY)


@case("h13_reliability_points", W("select run, split, bin, sp / n as confidence, sy / n as frequency, cast(n as bigint) as count from ("
                                  + Q.binned("scores", BY, 10) + ") b"), doubles=["confidence", "frequency"])
def q_h13(spark, sf):
    return C.reliability_points(S(spark, sf), 10, BY)


TEMPS = "(values ('a', 1.7), ('b', 0.8), ('c', 2.5)) t(run, temperature)"
PLATT = "(values ('a', 0.8, -0.3), ('b', 1.2, 0.1), ('c', 0.5, 0.0)) t(run, a, b)"


@case(
    "h3_temperature_apply",
    W(Q.calib_bundle("cal", BY, 10), ("cal", "select s.run, s.split, s.row_id, s.y_true, "
                                              + Q.sigmoid_sql(Q.logit_sql("s.y_prob") + " / cast(t.temperature as double)")
                                              + " as y_prob from scores s join " + TEMPS + " on s.run = t.run")),
    doubles=BUNDLE_COLS,
)
def q_h3(spark, sf):
    params = spark.createDataFrame([("a", 1.7), ("b", 0.8), ("c", 2.5)], "run string, temperature double")
    return C.calibration_bundle(C.apply_temperature(S(spark, sf), params, ["run"]), 10, BY)


@case(
    "h4_platt_apply",
    W(Q.calib_bundle("cal", BY, 10), ("cal", "select s.run, s.split, s.row_id, s.y_true, "
                                              + Q.sigmoid_sql("cast(t.a as double) * " + Q.logit_sql("s.y_prob") + " + cast(t.b as double)")
                                              + " as y_prob from scores s join " + PLATT + " on s.run = t.run")),
    doubles=BUNDLE_COLS,
)
def q_h4(spark, sf):
    params = spark.createDataFrame([("a", 0.8, -0.3), ("b", 1.2, 0.1), ("c", 0.5, 0.0)], "run string, a double, b double")
    return C.calibration_bundle(C.apply_platt(S(spark, sf), params, ["run"]), 10, BY)


@case("h3_h4_fit_gradient", W("select distinct run, cast(0.0 as double) as temperature_gradient, cast(0.0 as double) as platt_gradient_a, cast(0.0 as double) as platt_gradient_b from scores"),
      doubles=["temperature_gradient", "platt_gradient_a", "platt_gradient_b"])
def q_fit_gradient(spark, sf):
    """Fits of temperature and Platt on val: the NLL's gradient at the fitted parameters vanishes."""
    val = kept(weighted(S(spark, sf).where(F.col("split") == "val"), BY1))  # distinct scores with counts: rows are read once
    p = C.fit_gradient(val, C.fit_platt(val, BY1, weight="w"), BY1, weight="w").select("run", F.col("gradient_a").alias("platt_gradient_a"), F.col("gradient_b").alias("platt_gradient_b"))
    t = C.fit_temperature(val, BY1, weight="w").select("run", (F.lit(1.0) / F.col("temperature")).alias("a"), F.lit(0.0).alias("b"))
    return C.fit_gradient(val, t, BY1, weight="w").select("run", F.col("gradient_a").alias("temperature_gradient")).join(p, "run")


CLIPPED = f"least(greatest(y_prob, {Q.lit(1e-7)}), {Q.lit(1 - 1e-7)})"
# the lower hull of the cumulative sums by gift wrapping: from each vertex to the one of least slope
HULL = (
    f"select run, row_number() over (partition by run order by x) as k, x, sum(w) over (partition by run order by x) as cw, sum(sy) over (partition by run order by x) as cs from "
    f"(select run, {CLIPPED} as x, count(*) * 1.0::double as w, sum(y_true) * 1.0::double as sy from scores where split = 'val' group by 1, 2) c union all select distinct run, 0, null, 0.0, 0.0 from scores"
)
ISOTONIC = (
    "with recursive pts as materialized (select * from cum), hull(run, k, from_k, v) as (select distinct run, cast(0 as bigint), cast(null as bigint), cast(null as double) from pts union all "
    "select h.run, arg_min(p.k, (p.cs - o.cs) / (p.cw - o.cw)), h.k, min((p.cs - o.cs) / (p.cw - o.cw)) from hull h join pts o on o.run = h.run and o.k = h.k join pts p on p.run = h.run and p.k > h.k group by h.run, h.k), "
    "knots as (select distinct h.run, p.x, h.v from hull h join pts p on p.run = h.run and (p.k = h.from_k + 1 or p.k = h.k) where h.from_k is not null) select * from knots"
)


@case("h5_isotonic", W(
    f"select t.run, cast(floor(t.x * 50) as int) as cell, count(*) as n, avg(case when l.v is null then r.v when r.v is null or r.x = l.x then l.v else l.v + (r.v - l.v) * (t.x - l.x) / (r.x - l.x) end) as mean_calibrated, "
    f"min(t.x) as least_score from (select run, {CLIPPED} as x from scores where split = 'test') t asof left join knots l on l.run = t.run and t.x >= l.x asof left join knots r on r.run = t.run and t.x <= r.x group by 1, 2",
    ("cum", HULL), ("knots", ISOTONIC)), doubles=["mean_calibrated", "least_score"])
def q_h5(spark, sf):
    """Isotonic fits on val, applied to test; means of the calibrated scores by fiftieths of the raw score."""
    s = kept(weighted(S(spark, sf), BY))  # distinct scores with counts: rows are read once
    test = s.where(F.col("split") == "test").withColumn("x", C.clip_probs("y_prob"))
    cal = C.apply_isotonic(test, C.fit_isotonic(s.where(F.col("split") == "val"), BY1, weight="w"), BY1)
    return cal.groupBy("run", F.floor(F.col("x") * 50).cast("int").alias("cell")).agg(
        F.sum("w").cast("long").alias("n"), (F.sum(F.col("w") * F.col("y_prob")) / F.sum("w")).alias("mean_calibrated"), F.min("x").alias("least_score"))


@case("h12_calibrate_and_score", None)
def q_h12(spark, sf):
    """Fit on val, score on test, all four calibrators for every run (fits: rows-only check)."""
    s = S(spark, sf)
    return C.calibrate_and_score(s.where(F.col("split") == "val"), s.where(F.col("split") == "test"), n_bins=10, by=["run"])


@case("h14_ece_by_calibrator", None)
def q_h14(spark, sf):
    """ECE comparison by calibrator: all runs, and the tuned forest under identity."""
    from ..operators import baseline as B
    from . import cases_baseline as forest

    d = forest.prepared(spark, sf)
    model = B.fit_forest(d.where(F.col("split") == "train"), forest.COLS, **forest.TUNED)
    s = S(spark, sf)
    part = lambda name: s.where(F.col("split") == name)
    return C.compare_calibrators(part("val"), part("test"), B.score(model, d.where(F.col("split") == "test"), forest.COLS, "forest"))


@case("h12_identity_rows", W("select run, 'identity' as calibrator, " + ", ".join(BUNDLE_COLS) + " from (" + Q.calib_bundle("cal", BY, 10) + ") b where split = 'test'",
                             ("cal", f"select run, split, row_id, y_true, {CLIPPED} as y_prob from scores")), doubles=BUNDLE_COLS)
def q_h12_identity(spark, sf):
    """The calibrate-and-score table's rows that need no fit."""
    s = S(spark, sf)
    return C.calibrate_and_score(s.where(F.col("split") == "val"), s.where(F.col("split") == "test"), ("identity",), 10, BY1).select("run", "calibrator", *BUNDLE_COLS)
