"""Calibration (H1-H14): binning, calibration errors, Brier decomposition,
and post-hoc calibrators fitted per group.

Fits never collect rows: temperature and Platt are Newton iterations where
each step is one aggregate over the compressed (group, logit, label, count)
table; the per-group parameter table is checkpointed between steps so the
lineage stays one step long. Isotonic fits are lower convex hulls of the
cumulative label sum, made for ranges of scores and merged; a fitted model is
a table of knots. Applying parameters to a group that has none raises.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_index, clip, linspace_inner, logit, sigmoid, softplus
from ..functions.ranks import exact_quantiles, prefix_sums
from ..session import checkpoint_dir
from .metrics import P, Y, binned_gap, brier, compressed, kept, score_sums, weighted

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this module

EPS = 1e-7


def _grp(df: DataFrame, by) -> tuple[DataFrame, list[str], bool]:
    """Ungrouped calls run as one constant group so every join is on group keys."""
    by = list(by)
    if by:
        return df, by, False
    return df.withColumn("_all", F.lit(0)), ["_all"], True


def _ungrp(df: DataFrame, added: bool) -> DataFrame:
    return df.drop("_all") if added else df


def clip_probs(p, eps: float = EPS):
    return clip(p, eps, 1.0 - eps)


# ------------------------------------------------------------------ binning
def equal_mass_edges(scores: DataFrame, n_bins: int, by: list[str], score: str = P, weight: str | None = None) -> DataFrame:
    """H7: per group, quantile edges at linspace(0,1,n+1), ends pinned to 0/1,
    duplicates collapsed -> ``inner`` edges (first and last dropped)."""
    qs = [i * (1.0 / n_bins) for i in range(n_bins + 1)]
    w = F.col(weight) if weight else F.lit(1)
    q = exact_quantiles(scores.select(*by, F.col(score).cast("double").alias("_p"), w.alias("_w")), by, "_p", qs, weight="_w", value_range=(0.0, 1.0))
    e = q.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("q", "_p"))).alias("_e"))
    n = len(qs)
    pinned = F.transform("_e", lambda s, i: F.when(i == 0, F.lit(0.0)).when(i == n - 1, F.lit(1.0)).otherwise(s["_p"]))
    edges = F.array_sort(F.array_distinct(pinned))
    return e.select(*by, F.slice(edges, 2, F.size(edges) - 2).alias("inner"), (F.size(edges) - 2).alias("max_bin"))


def binned(scores: DataFrame, n_bins: int, by: list[str], strategy: str = "equal_width", label: str = Y, score: str = P,
           weight: str | None = None) -> DataFrame:
    """Per (group, bin): n, sum of labels, sum of scores. Equal-width bins need
    no more than the row; for the others rows are first compressed to distinct
    scores (an aggregate), so the bin lookup runs on the compressed rows."""
    scores, by, added = _grp(scores, by)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    sums = lambda: (F.sum(w).alias("_n"), F.sum(w * F.col(label)).alias("_sy"), F.sum(w * F.col(score)).alias("_sp"))
    if strategy == "equal_width":
        b = scores.groupBy(*by, bin_index(F.col(score).cast("double"), linspace_inner(n_bins)).alias("bin")).agg(*sums())
    elif strategy == "equal_mass":
        comp = scores.groupBy(*by, F.col(score).cast("double").alias("_s")).agg(*sums())
        e = equal_mass_edges(scores, n_bins, by, score, weight)
        j = comp.join(F.broadcast(e), by)  # one row for each group
        b = j.withColumn("bin", F.least(F.size(F.filter("inner", lambda x: x <= F.col("_s"))), F.col("max_bin"))).drop("inner", "max_bin")
    else:
        raise ValueError(f"strategy must be equal_width or equal_mass, got {strategy!r}")
    return _ungrp(b.groupBy(*by, "bin").agg(F.sum("_n").alias("n"), F.sum("_sy").alias("sy"), F.sum("_sp").alias("sp")), added)


def calibration_error(scores: DataFrame, n_bins: int, by: list[str] = (), strategy: str = "equal_width", **kw) -> DataFrame:
    """H8: ECE = sum_b n_b/N |acc_b - conf_b|."""
    scores, by, added = _grp(scores, by)
    b = binned(scores, n_bins, by, strategy, **kw)
    return _ungrp(b.groupBy(*by).agg((F.sum(F.abs(F.col("sy") - F.col("sp"))) / F.sum("n")).alias("ece")), added)


def max_calibration_error(scores: DataFrame, n_bins: int, by: list[str] = (), strategy: str = "equal_width", **kw) -> DataFrame:
    """H9: the worst bin gap |acc_b - conf_b| (empty bins skipped)."""
    scores, by, added = _grp(scores, by)
    b = binned(scores, n_bins, by, strategy, **kw)
    return _ungrp(b.groupBy(*by).agg(F.max(F.abs(F.col("sy") / F.col("n") - F.col("sp") / F.col("n"))).alias("mce")), added)


def brier_decomposition(scores: DataFrame, n_bins: int, by: list[str] = (), label: str = Y, score: str = P) -> DataFrame:
    """Reliability, resolution, uncertainty (equal-width bins) and the exact Brier."""
    scores, by, added = _grp(scores, by)
    b = binned(scores, n_bins, by, "equal_width", label, score)
    tot = b.groupBy(*by).agg(F.sum("n").alias("_N"), F.sum("sy").alias("_Y"))
    j = b.join(tot, by)
    base = F.col("_Y") / F.col("_N")
    conf, acc = F.col("sp") / F.col("n"), F.col("sy") / F.col("n")
    d = j.groupBy(*by).agg(
        F.sum(F.col("n") / F.col("_N") * (conf - acc) * (conf - acc)).alias("reliability"),
        F.sum(F.col("n") / F.col("_N") * (acc - base) * (acc - base)).alias("resolution"),
        F.first(base * (F.lit(1.0) - base)).alias("uncertainty"),
    )
    br = brier(scores, by, label, score)
    return _ungrp(d.join(br, by), added)


def calibration_bundle(scores: DataFrame, n_bins: int = 10, by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """AUC, ECE (both strategies), MCE, Brier and its parts, skill score.

    One aggregation over the scores in order gives all but the equal-mass ECE,
    whose edges need the quantiles first; both read one compressed table, which
    is checkpointed while this is built."""
    scores, by, added = _grp(scores, by)
    comp = kept(compressed(scores, by, label, score, weight))
    g = score_sums(comp, by, 0.5, n_bins)
    n, base = F.col("pos") + F.col("neg"), F.col("pos") / (F.col("pos") + F.col("neg"))
    total = lambda of: F.aggregate(F.filter("bins", lambda b: b["n"] > 0), F.lit(0.0), lambda acc, b: acc + of(b))
    g = g.select(
        *by, "auc_roc", (binned_gap() / n).alias("ece_equal_width"),
        F.array_max(F.transform(F.filter("bins", lambda b: b["n"] > 0), lambda b: F.abs(b["sy"] / b["n"] - b["sp"] / b["n"]))).alias("mce"),
        total(lambda b: b["n"] / n * (b["sp"] / b["n"] - b["sy"] / b["n"]) * (b["sp"] / b["n"] - b["sy"] / b["n"])).alias("reliability"),
        total(lambda b: b["n"] / n * (b["sy"] / b["n"] - base) * (b["sy"] / b["n"] - base)).alias("resolution"),
        (base * (F.lit(1.0) - base)).alias("uncertainty"), (F.col("sq") / n).alias("brier"),
    )
    long = comp.select(*by, F.col("s").alias(score), F.explode(F.array(F.struct(F.lit(1).alias("y"), F.col("pos").alias("w")), F.struct(F.lit(0).alias("y"), F.col("neg").alias("w")))).alias("_e")).select(*by, score, F.col("_e.y").alias(label), F.col("_e.w").alias("_w")).where(F.col("_w") > 0)
    mass = calibration_error(long, n_bins, by, "equal_mass", label=label, score=score, weight="_w").withColumnRenamed("ece", "ece_equal_mass")
    skill = F.when(F.col("uncertainty") > 0, (F.col("resolution") - F.col("reliability")) / F.col("uncertainty")).otherwise(F.lit(float("nan")))
    return _ungrp(g.join(mass, by).withColumn("brier_skill_score", skill), added)


def points_of_bins(bins: DataFrame, by: list[str], min_n: int = 0) -> DataFrame:
    """(by..., bin, confidence, frequency, count) of :func:`binned` sums; groups of less than ``min_n`` rows are skipped."""
    out = bins.select(*by, "bin", (F.col("sp") / F.col("n")).alias("confidence"), (F.col("sy") / F.col("n")).alias("frequency"),
                      F.col("n").cast("long").alias("count"))
    if min_n:
        tot = bins.groupBy(*by).agg(F.sum("n").alias("_tot"))
        out = out.join(tot, by).where(F.col("_tot") >= min_n).drop("_tot")
    return out


def reliability_points(scores: DataFrame, n_bins: int = 10, by: list[str] = (), min_n: int = 0, **kw) -> DataFrame:
    """Per non-empty bin (mean confidence, observed frequency, count)."""
    scores, by, added = _grp(scores, by)
    return _ungrp(points_of_bins(binned(scores, n_bins, by, "equal_width", **kw), by, min_n), added)


# --------------------------------------------------------------- calibrators
def _rows(weight: str | None):
    """How many rows a group of rows stands for."""
    return F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1)).cast("double")


def _compressed_logits(scores: DataFrame, by: list[str], label: str, score: str, eps: float, weight: str | None = None) -> DataFrame:
    return scores.groupBy(*by, logit(score, eps).alias("z"), F.col(label).cast("double").alias("y")).agg(_rows(weight).alias("w"))


def _fit_logistic(val: DataFrame, by: list[str], label: str, score: str, eps: float, max_iter: int, tol: float,
                  bounds: tuple[float, float] | None = None, weight: str | None = None) -> DataFrame:
    """(by..., a, b) minimising each group's mean NLL of sigma(a * logit(p) + b).

    Damped Newton on one compressed table: every round evaluates loss, gradient
    and Hessian at a trial point. A trial that is no worse is accepted and gives
    the next direction; a worse one is replaced by half the step. With
    ``bounds`` only a is fitted, within them, and b is 0. Raises if a group has
    not settled after ``max_iter`` rounds. One job for each round runs here."""
    checkpoint_dir(val.sparkSession)
    key = by or ["__k"]
    comp = _compressed_logits(val, by, label, score, eps, weight)
    comp = (comp if by else comp.withColumn("__k", F.lit(1))).persist()
    state = comp.select(*key).distinct().withColumns({c: F.lit(v) for c, v in (("a", 1.0), ("b", 0.0), ("best_a", 1.0), ("best_b", 0.0), ("best", float("inf")), ("da", 0.0), ("db", 0.0))})
    carried = ["a", "b", "best_a", "best_b", "best", "da", "db"]
    lo, hi = (F.lit(x) for x in (bounds or (float("-inf"), float("inf"))))
    inside = lambda c: F.least(hi, F.greatest(lo, c))
    try:
        for _ in range(max_iter):
            x = F.col("a") * F.col("z") + F.col("b")
            sig = sigmoid(x)
            w, r = F.col("w"), F.col("w") * sig * (F.lit(1.0) - sig)
            # one row for each group: joined by its few keys, a group's rows would all go to one task
            g = comp.join(F.broadcast(state), key).groupBy(*key).agg(
                F.sum(w).alias("n"), F.sum(w * (softplus(x) - F.col("y") * x)).alias("loss"),
                F.sum(w * (sig - F.col("y")) * F.col("z")).alias("ga"), F.sum(w * (sig - F.col("y"))).alias("gb"),
                F.sum(r * F.col("z") * F.col("z")).alias("haa"), F.sum(r * F.col("z")).alias("hab"), F.sum(r).alias("hbb"),
                *(F.first(c).alias(c) for c in carried))
            g = g.withColumn("loss", F.col("loss") / F.col("n"))
            ok = F.col("loss") <= F.col("best") + F.lit(1e-13)
            if bounds:
                step_a, step_b = F.when(F.col("haa") > 0, -F.col("ga") / F.col("haa")).otherwise(-F.signum("ga")), F.lit(0.0)
            else:
                # a trace of ridge keeps the system solvable where all logits are equal
                ridge = F.lit(1e-12) * (F.col("haa") + F.col("hbb")) + F.lit(1e-300)
                haa, hbb = F.col("haa") + ridge, F.col("hbb") + ridge
                det = haa * hbb - F.col("hab") * F.col("hab")
                step_a = (F.col("hab") * F.col("gb") - hbb * F.col("ga")) / det
                step_b = (F.col("hab") * F.col("ga") - haa * F.col("gb")) / det
            moved = g.select(
                *key, F.when(ok, F.col("a")).otherwise(F.col("best_a")).alias("best_a"), F.when(ok, F.col("b")).otherwise(F.col("best_b")).alias("best_b"),
                F.when(ok, F.col("loss")).otherwise(F.col("best")).alias("best"),
                F.when(ok, step_a).otherwise(F.col("da") / 2).alias("da"), F.when(ok, step_b).otherwise(F.col("db") / 2).alias("db"))
            state = moved.withColumns({"a": inside(F.col("best_a") + F.col("da")), "b": F.col("best_b") + F.col("db")}).checkpoint(eager=True)
            left = F.greatest(F.abs(F.col("a") - F.col("best_a")) / (1 + F.abs("best_a")), F.abs(F.col("b") - F.col("best_b")) / (1 + F.abs("best_b")))
            worst = state.agg(F.max(left)).first()[0]  # one number
            if worst is None or worst < tol:
                return state.select(*by, F.col("best_a").alias("a"), F.col("best_b").alias("b"))
        raise RuntimeError(f"the calibration fit did not settle in {max_iter} rounds (last step {worst:.3g})")
    finally:
        comp.unpersist()


def with_parameters(rows: DataFrame, params: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` joined to their group's parameters; a row whose group has none raises at execution."""
    if not by:
        return rows.join(params.limit(1).withColumn("__k", F.lit(1)), F.lit(1) == F.col("__k")).drop("__k")  # one row of parameters
    named = F.concat_ws(", ", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by))
    # one row for each group: joined by its few keys, a group's rows would all go to one task
    joined = rows.join(F.broadcast(params.withColumn("_fitted", F.lit(True))), by, "left")
    found = F.when(F.col("_fitted").isNull(), F.raise_error(F.concat(F.lit("no fitted parameters for group "), named)).cast("boolean")).otherwise(F.lit(True))
    return joined.where(found).drop("_fitted")


def fit_temperature(val: DataFrame, by: list[str] = ("run",), bounds: tuple[float, float] = (0.05, 10.0), max_iter: int = 200,
                    tol: float = 1e-9, label: str = Y, score: str = P, eps: float = EPS, weight: str | None = None) -> DataFrame:
    """H3: T minimising the NLL of sigma(logit(p) / T) per group, T in bounds (the NLL is convex in 1 / T)."""
    by = list(by)
    s = _fit_logistic(val, by, label, score, eps, max_iter, tol, (1.0 / bounds[1], 1.0 / bounds[0]), weight)
    return s.select(*by, (F.lit(1.0) / F.col("a")).alias("temperature"))


def apply_temperature(scores: DataFrame, params: DataFrame, by: list[str] = ("run",), score: str = P, eps: float = EPS) -> DataFrame:
    return with_parameters(scores, params, list(by)).withColumn(score, sigmoid(logit(score, eps) / F.col("temperature"))).drop("temperature")


def fit_platt(val: DataFrame, by: list[str] = ("run",), max_iter: int = 200, tol: float = 1e-9, label: str = Y, score: str = P,
              eps: float = EPS, weight: str | None = None) -> DataFrame:
    """H4: (a, b) of sigma(a * logit(p) + b) per group, by damped Newton from (1, 0)."""
    return _fit_logistic(val, list(by), label, score, eps, max_iter, tol, weight=weight)


def fit_gradient(val: DataFrame, params: DataFrame, by: list[str] = ("run",), label: str = Y, score: str = P, eps: float = EPS,
                 weight: str | None = None) -> DataFrame:
    """Mean gradient of the NLL in (a, b) at fitted parameters: both 0 at a minimum."""
    by = list(by)
    off = sigmoid(F.col("a") * F.col("z") + F.col("b")) - F.col("y")
    comp = _compressed_logits(val, by, label, score, eps, weight).join(F.broadcast(params), by)  # one row for each group
    mean = lambda v: F.sum(F.col("w") * v) / F.sum(F.when(v.isNotNull(), F.col("w")))
    return comp.groupBy(*by).agg(mean(off * F.col("z")).alias("gradient_a"), mean(off).alias("gradient_b"))


def apply_platt(scores: DataFrame, params: DataFrame, by: list[str] = ("run",), score: str = P, eps: float = EPS) -> DataFrame:
    return with_parameters(scores, params, list(by)).withColumn(score, sigmoid(F.col("a") * logit(score, eps) + F.col("b"))).drop("a", "b")


def hull_blocks(blocks: Iterator[tuple[float, float, float, float]]) -> list[tuple[float, float, float, float]]:
    """Edges of the lower convex hull of the cumulative sums of (first score, last score, weight, label sum)
    blocks in ascending order: neighbours whose means do not rise are pooled."""
    out: list[tuple[float, float, float, float]] = []
    for lo, hi, w, sy in blocks:
        while out and out[-1][3] / out[-1][2] >= sy / w:
            lo, w, sy = out[-1][0], out[-1][2] + w, out[-1][3] + sy
            out.pop()
        out.append((lo, hi, w, sy))
    return out


def fit_isotonic(val: DataFrame, by: list[str] = ("run",), label: str = Y, score: str = P, eps: float = EPS, weight: str | None = None) -> DataFrame:
    """H5: (by..., k, x, v), the knots of each group's isotonic fit, k = 1, 2, ... in ascending x.

    Rows are compressed to distinct scores and dealt out by ranges of (group,
    score). Each range keeps the edges of its lower convex hull only, and a
    group's ranges are merged by the same rule, which gives the hull of the
    whole. A block of several scores has a knot at both ends."""
    by = list(by)
    comp = val.groupBy(*by, clip_probs(score, eps).alias("x")).agg(_rows(weight).alias("w"), F.sum((F.col(weight) if weight else F.lit(1.0)) * F.col(label).cast("double")).alias("sy"))
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    ordered = comp.select(group.alias("g"), "x", "w", "sy").repartitionByRange("g", "x").sortWithinPartitions("g", "x")
    kind = ordered.schema["g"].dataType.simpleString()
    edges = "lo double, hi double, w double, sy double"

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hull of each group in this range; blocks go out when the group ends."""
        place, held, hull = TaskContext.get().partitionId() << 32, None, []

        def made() -> pa.RecordBatch:
            n = len(hull)
            return pa.RecordBatch.from_arrays([held.take(pa.array([0] * n)), pa.array(range(place, place + n), pa.int64()), *(pa.array([b[c] for b in hull], pa.float64()) for c in range(4))], names=["g", "place", "lo", "hi", "w", "sy"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            x, w, sy = (batch.column(c).to_pylist() for c in (1, 2, 3))
            start = 0
            for end in [*(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]:
                if held is not None and held[0].as_py() != keys[start]:
                    yield made()
                    place, hull = place + len(hull), []
                held = batch.column(0).slice(start, 1)
                hull = hull_blocks([*hull, *zip(x[start:end], x[start:end], w[start:end], sy[start:end])])
                start = end
        if hull:
            yield made()

    found = ordered.mapInArrow(pooled, f"g {kind}, place long, {edges}")
    # what meets for a group are hull edges; the last merge is the model itself
    gathered = found.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("place", "lo", "hi", "w", "sy"))).alias("b"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                hull = hull_blocks((b["lo"], b["hi"], b["w"], b["sy"]) for b in batch.column(1)[r].as_py())
                knots = [(x, sy / w) for lo, hi, w, sy in hull for x in ((lo, hi) if hi > lo else (lo,))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r] * len(knots))), pa.array(range(1, len(knots) + 1), pa.int64()), pa.array([x for x, _ in knots]), pa.array([v for _, v in knots])], names=["g", "k", "x", "v"])

    return gathered.mapInArrow(merged, f"g {kind}, k long, x double, v double").select(*(F.col(f"g.{c}").alias(c) for c in by), "k", "x", "v")


def apply_isotonic(scores: DataFrame, knots: DataFrame, by: list[str] = ("run",), score: str = P, eps: float = EPS) -> DataFrame:
    """Linear interpolation between knots, clipped at the ends, re-clipped to [eps, 1 - eps].

    Distinct scores and knots are counted in one order, which gives each score
    the number of knots up to it; its segment is found by an equi-join on that.
    Jobs run while this is built."""
    by = list(by)
    checkpoint_dir(scores.sparkSession)
    knots = knots.checkpoint(eager=True)
    sizes = knots.groupBy(*by).agg(F.max("k").alias("_last"))
    rows = with_parameters(scores, sizes, by).withColumn("_x", clip_probs(score, eps))
    marked = rows.groupBy(*by, "_x").agg(F.lit(0).alias("_knot")).unionByName(knots.select(*by, F.col("x").alias("_x"), F.lit(1).alias("_knot")))
    upto = prefix_sums(marked.groupBy(*by, "_x").agg(F.sum("_knot").alias("_knot")), by, "_x", ["_knot"], value_range=(0.0, 1.0)).select(*by, "_x", F.col("cum__knot").alias("_k"), F.col("tot__knot").alias("_all_knots"))
    left = knots.select(*by, F.col("k").alias("_k"), F.col("x").alias("_x0"), F.col("v").alias("_v0"))
    right = knots.select(*by, (F.col("k") - 1).alias("_k"), F.col("x").alias("_x1"), F.col("v").alias("_v1"))
    met = upto.join(left, [*by, "_k"], "left").join(right, [*by, "_k"], "left")
    between = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_x") - F.col("_x0")) / (F.col("_x1") - F.col("_x0"))
    value = F.when(F.col("_v0").isNull(), F.col("_v1")).when(F.col("_v1").isNull(), F.col("_v0")).otherwise(between)
    values = met.select(*by, "_x", clip_probs(value, eps).alias("_v"))
    return rows.join(values, [*by, "_x"]).withColumn(score, F.col("_v")).drop("_x", "_v", "_last")


CALIBRATORS = ("identity", "temperature", "platt", "isotonic")


def calibrate_and_score(val: DataFrame, test: DataFrame, names: tuple[str, ...] = CALIBRATORS, n_bins: int = 10,
                        by: list[str] = ("run",)) -> DataFrame:
    """Fit each calibrator on val, apply to test, score the calibration
    bundle; one row per (group, calibrator) with fitted parameters."""
    by = list(by)
    for name in names:
        if name not in CALIBRATORS:
            raise ValueError(f"Unknown calibrator: {name}")
    # rows are read once: every calibrator fits and scores their distinct scores with counts
    test = kept(weighted(test, by))
    if set(names) - {"identity"}:
        val = kept(weighted(val, by))
    out = []
    for name in names:
        params = {"param_temperature": F.lit(None).cast("double"), "param_a": F.lit(None).cast("double"), "param_b": F.lit(None).cast("double")}
        if name == "identity":
            cal = test.withColumn(P, clip_probs(P))
            pt = None
        elif name == "temperature":
            pt = fit_temperature(val, by, weight="w")
            cal = apply_temperature(test, pt, by)
            pt = pt.select(*by, F.col("temperature").alias("param_temperature"))
        elif name == "platt":
            pt = fit_platt(val, by, weight="w")
            cal = apply_platt(test, pt, by)
            pt = pt.select(*by, F.col("a").alias("param_a"), F.col("b").alias("param_b"))
        else:
            cal = apply_isotonic(test, fit_isotonic(val, by, weight="w"), by)
            pt = None
        b = calibration_bundle(cal, n_bins, by, weight="w").withColumn("calibrator", F.lit(name))
        if pt is not None:
            b = b.join(pt, by)
        for c, v in params.items():
            if c not in b.columns:
                b = b.withColumn(c, v)
        out.append(b)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def compare_calibrators(val: DataFrame, test: DataFrame, baseline: DataFrame | None = None, names: tuple[str, ...] = CALIBRATORS, n_bins: int = 10,
                        by: list[str] = ("run",)) -> DataFrame:
    """Every run under every calibrator and the baseline's test scores under identity only; one column of
    equal-width ECE for each calibrator, null where a run has none."""
    table = calibrate_and_score(val, test, names, n_bins, by)
    if baseline is not None:
        table = table.unionByName(calibrate_and_score(baseline, baseline, ("identity",), n_bins, by))
    return table.groupBy(*by).pivot("calibrator", list(names)).agg(F.first("ece_equal_width"))


def nll(scores: DataFrame, by: list[str] = (), label: str = Y, score: str = P, eps: float = EPS) -> DataFrame:
    """Mean negative log-likelihood (a diagnostic for the fits)."""
    z = logit(score, eps)
    y = F.col(label).cast("double")
    return scores.groupBy(*by).agg(F.avg(y * softplus(-z) + (F.lit(1.0) - y) * softplus(z)).alias("nll"))


