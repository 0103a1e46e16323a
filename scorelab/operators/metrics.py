"""Scored-row metrics (G1-G20) over the long score table.

Input: ``scores(run, split, row_id, y_true, y_prob, ...)``. Every operator
takes ``by`` (grouping columns, e.g. ``["run", "split"]``) so one job serves
all runs, splits, subgroups or bootstrap replicates. Optional ``weight``
gives each row a multiplicity (used by the bootstrap).

Rank metrics (AUC, AP, curves) compress rows to one row per distinct score
per group and use the distributed prefix sums; nothing is ordered in a
single task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_index, linspace_inner, logit, sigmoid, softplus
from ..functions.ranks import partitions, prefix_sums, slice_of
from ..session import checkpoint_dir

Y, P = "y_true", "y_prob"
METRICS8 = ["auc_roc", "auc_pr", "f1", "accuracy", "precision", "recall", "brier", "ece"]


def _w(weight: str | None):
    return F.col(weight).cast("double") if weight else F.lit(1.0)


def _join_all(dfs: list[DataFrame], by: list[str]) -> DataFrame:
    if by:
        return reduce(lambda a, b: a.join(b, by, "full_outer"), dfs)
    keyed = [d.withColumn("__k", F.lit(1)) for d in dfs]
    return reduce(lambda a, b: a.join(b, "__k"), keyed).drop("__k")


# ---------------------------------------------------------------- G1 / G2
def confusion(scores: DataFrame, tau: float = 0.5, by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """G1: tp, fp, tn, fn (always the full 2x2) and n per group."""
    by = list(by)
    w = _w(weight)
    pred = F.col(score) >= F.lit(tau)
    pos = F.col(label) == 1
    return scores.groupBy(*by).agg(
        F.sum(F.when(pred & pos, w).otherwise(0.0)).alias("tp"),
        F.sum(F.when(pred & ~pos, w).otherwise(0.0)).alias("fp"),
        F.sum(F.when(~pred & ~pos, w).otherwise(0.0)).alias("tn"),
        F.sum(F.when(~pred & pos, w).otherwise(0.0)).alias("fn"),
    ).withColumn("n", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))


def rates(conf: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 on zero division), specificity, Cohen kappa."""
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(F.lit(2.0) * tp + fp + fn > 0, F.lit(2.0) * tp / (F.lit(2.0) * tp + fp + fn)).otherwise(0.0)
    acc = F.when(n > 0, (tp + tn) / n)
    spec = F.when(tn + fp > 0, tn / (tn + fp)).otherwise(0.0)
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    kappa = F.when(F.lit(1.0) - pe != 0, (acc - pe) / (F.lit(1.0) - pe)).otherwise(0.0)
    return conf.withColumns({"accuracy": acc, "precision": prec, "recall": rec, "f1": f1, "specificity": spec, "kappa": kappa})


# ---------------------------------------------------------------- G3 / G4
def compressed(scores: DataFrame, by: list[str], label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """One row per (group, distinct score) with weighted pos/neg counts."""
    w = _w(weight)
    return scores.groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0.0).otherwise(w)).alias("neg"),
    )


def weighted(scores: DataFrame, by: list[str], label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """One row per (group, label, distinct score), ``w`` rows each: what the operators with a ``weight`` need of a score table."""
    w = F.sum(F.col(weight).cast("double")) if weight else F.count(F.lit(1)).cast("double")
    return scores.groupBy(*by, label, score).agg(w.alias("w"))


PROB_RANGE = (0.0, 1.0)
#: How a shuffle of distinct scores is dealt out: into at least so many partitions, joined up to so many bytes for a task.
KEEP_PARTITIONS, KEEP_BYTES = 400, 16 << 20


def kept(comp: DataFrame) -> DataFrame:
    """``comp`` checkpointed now. Its shuffle is dealt out by KEEP_PARTITIONS and KEEP_BYTES, so that what one task reads
    does not grow with the table as it does where a session has one partition for each core."""
    spark = comp.sparkSession
    checkpoint_dir(spark)
    held = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    for k, v in zip(held, (max(partitions(comp), KEEP_PARTITIONS), KEEP_BYTES)):
        spark.conf.set(k, str(v))
    try:
        return comp.checkpoint(eager=True)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def sliced(comp: DataFrame, score_range: tuple[float, float] = PROB_RANGE) -> DataFrame:
    """Adds ``_bk``, the slice of the score ``s``."""
    return comp.withColumn("_bk", slice_of("s", score_range, partitions(comp)))


def _ranked(scores: DataFrame, by: list[str], label: str, score: str, weight: str | None,
            score_range: tuple[float, float] | None = PROB_RANGE) -> DataFrame:
    """Scores are probabilities by contract, so buckets are fixed slices of
    [0, 1]; pass ``score_range=None`` for unbounded scores (quantile buckets)."""
    return prefix_sums(compressed(scores, by, label, score, weight), by, "s", ["pos", "neg"], value_range=score_range)


def rank_metrics(scores: DataFrame, by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None,
                 score_range: tuple[float, float] | None = PROB_RANGE) -> DataFrame:
    """G3 + G4 in one pass over the compressed table.

    AUC = sum_s pos_s (neg_below_s + neg_s / 2) / (P N)   (ties count one half)
    AP  = sum_s pos_s / P * tp(>=s) / (tp(>=s) + fp(>=s))  (step interpolation)
    Both NULL when a group has a single class."""
    by = list(by)
    return rank_from_compressed(compressed(scores, by, label, score, weight), by, score_range)


def rank_from_compressed(comp: DataFrame, by: list[str], score_range: tuple[float, float] | None = PROB_RANGE) -> DataFrame:
    """AUC and AP from a compressed (by..., s, pos, neg) table."""
    r = prefix_sums(comp, by, "s", ["pos", "neg"], value_range=score_range)
    neg_below = F.col("cum_neg") - F.col("neg")
    tp_ge = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    g = r.groupBy(*by).agg(
        F.sum(F.col("pos") * (neg_below + F.col("neg") / 2.0)).alias("_u"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * tp_ge / (tp_ge + fp_ge)).otherwise(0.0)).alias("_ap"),
        F.first("tot_pos").alias("_P"),
        F.first("tot_neg").alias("_N"),
    )
    ok = (F.col("_P") > 0) & (F.col("_N") > 0)
    return g.select(
        *by,
        F.when(ok, F.col("_u") / (F.col("_P") * F.col("_N"))).alias("auc_roc"),
        F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).alias("auc_pr"),
    )


def auc_roc(scores: DataFrame, by: list[str] = (), **kw) -> DataFrame:
    return rank_metrics(scores, by, **kw).drop("auc_pr")


def average_precision(scores: DataFrame, by: list[str] = (), **kw) -> DataFrame:
    return rank_metrics(scores, by, **kw).drop("auc_roc")


# ---------------------------------------------------------------- G5 / G6
def brier(scores: DataFrame, by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    w = _w(weight)
    d = F.col(score) - F.col(label)
    return scores.groupBy(*by).agg((F.sum(w * d * d) / F.sum(w)).alias("brier"))


def ece(scores: DataFrame, n_bins: int, by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None, name: str = "ece") -> DataFrame:
    """Equal-width ECE, edges = linspace(0, 1, n_bins + 1), last bin closed."""
    by = list(by)
    w = _w(weight)
    b = scores.groupBy(*by, bin_index(score, linspace_inner(n_bins)).alias("_b")).agg(
        F.sum(w).alias("_n"), F.sum(w * F.col(label)).alias("_sy"), F.sum(w * F.col(score)).alias("_sp")
    )
    return b.groupBy(*by).agg(
        (F.sum(F.abs(F.col("_sy") - F.col("_sp"))) / F.sum("_n")).alias(name)
    )


def score_sums(comp: DataFrame, by: list[str], tau: float, n_bins: int, score_range: tuple[float, float] | None = PROB_RANGE) -> DataFrame:
    """Everything that the metrics of a group need, from a compressed (by..., s, pos, neg) table: class weights, AUC,
    squared error, weights at tau, and ``bins``, an array of (n, sy, sp) for each equal-width bin that has rows.

    Rows are dealt out once, by slices of the scores (a column ``_bk`` of ``comp`` has them, if they already are), and
    summed by (group, slice, bin) with the negatives below them in their slice; those of the slices before are added to
    the sums, so that no branch reads the rows again. Groups with a null key have no row."""
    if "_bk" in comp.columns:
        r = comp
    elif score_range is not None:
        r = sliced(comp, score_range)
    else:
        r = prefix_sums(comp, by, "s", ["pos", "neg"]).withColumn("_bk", F.lit(0))
    for c in by:
        r = r.where(F.col(c).isNotNull())
    if "cum_neg" not in r.columns:
        inside = Window.partitionBy(*by, "_bk").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        r = r.withColumn("cum_neg", F.sum("neg").over(inside))
    pos, neg, s = F.col("pos"), F.col("neg"), F.col("s")
    part = lambda x, w: F.sum(F.when(w, x).otherwise(0.0))
    cells = r.groupBy(*by, "_bk", F.when(s.isNotNull(), bin_index(s, linspace_inner(n_bins))).alias("_b")).agg(
        F.sum(pos).alias("pos"), F.sum(neg).alias("neg"), F.sum(pos * (F.col("cum_neg") - neg / 2.0)).alias("_u"),
        F.sum(pos * (s - 1.0) * (s - 1.0) + neg * s * s).alias("sq"), part(pos, s >= tau).alias("tp"), part(neg, s >= tau).alias("fp"),
        F.sum((pos + neg) * s).alias("_sp"),
    )
    lower = Window.partitionBy(*by).orderBy("_bk").rangeBetween(Window.unboundedPreceding, -1)  # a few rows for each slice of a group
    placed = cells.withColumn("_u", F.col("_u") + pos * F.coalesce(F.sum("neg").over(lower), F.lit(0.0)))
    sums = ("pos", "neg", "_u", "sq", "tp", "fp")
    bins = placed.groupBy(*by, "_b").agg(*(F.sum(c).alias(c) for c in (*sums, "_sp")))
    one = F.when(F.col("_b").isNotNull(), F.struct("_b", (pos + neg).alias("n"), pos.alias("sy"), F.col("_sp").alias("sp")))
    g = bins.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums), F.array_sort(F.collect_list(one)).alias("bins"))
    return g.withColumn("auc_roc", F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("_u") / (F.col("pos") * F.col("neg")))).drop("_u")


def binned_gap(bins: str = "bins"):
    """Sum over bins of |label sum - score sum|, the numerator of the ECE."""
    return F.aggregate(F.col(bins), F.lit(0.0), lambda acc, b: acc + F.abs(b["sy"] - b["sp"]))


# ---------------------------------------------------------------- G7
def metric_bundle(scores: DataFrame, tau: float = 0.5, by: list[str] = (), n_bins: int = 15, prefix: str = "",
                  label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """The eight-metric bundle per group (undefined -> NULL). With groups, a job runs while this is built."""
    by = list(by)
    if by:
        # one compressed (group, score) table feeds all eight metrics; each
        # branch prunes other columns of it, so it is kept: rows are scanned once
        checkpoint_dir(scores.sparkSession)
        comp = compressed(scores, by, label, score, weight).checkpoint(eager=True)
        out = bundle_from_compressed(comp, by, tau, n_bins).select(*by, *METRICS8)
    else:
        c = rates(confusion(scores, tau, by, label, score, weight)).select(*by, "f1", "accuracy", "precision", "recall")
        rk = rank_metrics(scores, by, label, score, weight)
        br = brier(scores, by, label, score, weight)
        ec = ece(scores, n_bins, by, label, score, weight)
        out = _join_all([rk, c, br, ec], by).select(*by, *METRICS8)
    if prefix:
        out = out.withColumnsRenamed({m: f"{prefix}{m}" for m in METRICS8})
    return out


def metrics_long(bundle: DataFrame, by: list[str], metrics: list[str] = METRICS8) -> DataFrame:
    """Wide bundle -> (by..., metric, value)."""
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    return bundle.select(*by, st.alias("_m")).select(*by, "_m.metric", "_m.value")


# ---------------------------------------------------------------- G8 / G9
def roc_points(scores: DataFrame, by: list[str] = (), label: str = Y, score: str = P) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (descending sweep),
    plus the origin with NULL threshold."""
    by = list(by)
    r = _ranked(scores, by, label, score, None)
    tp_ge = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    pts = r.select(*by, F.col("s").alias("threshold"), (fp_ge / F.col("tot_neg")).alias("fpr"), (tp_ge / F.col("tot_pos")).alias("tpr"))
    origin = r.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_points(scores: DataFrame, by: list[str] = (), label: str = Y, score: str = P) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, the end
    point (precision 1, recall 0) and the no-skill base rate."""
    by = list(by)
    r = _ranked(scores, by, label, score, None)
    tp_ge = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    base = F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))
    pts = r.select(*by, F.col("s").alias("threshold"), (tp_ge / (tp_ge + fp_ge)).alias("precision"),
                   (tp_ge / F.col("tot_pos")).alias("recall"), base.alias("base_rate"))
    end = r.groupBy(*by).agg(F.first(base).alias("base_rate")).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), "base_rate")
    return pts.unionByName(end)


# ---------------------------------------------------------------- G10 / F8 / G11
def grid(start: float, step: float, n: int) -> list[float]:
    """start + k * step for k in 0..n-1 (the same doubles as numpy.arange)."""
    return [start + k * step for k in range(n)]


def threshold_sweep(scores: DataFrame, taus: list[float], by: list[str] = (), label: str = Y, score: str = P, weight: str | None = None) -> DataFrame:
    """Confusion-derived metrics at every tau in one pass.

    Each row is bucketed by how many taus are <= its score; counts per
    (group, bucket) are summed from the top, so TP(tau_k) = rows in buckets
    >= k. Work is one aggregation regardless of the grid size."""
    by = list(by)
    taus = sorted(float(t) for t in taus)
    arr = F.array(*[F.lit(t) for t in taus])
    # Compress first: one row per distinct score. Besides shrinking the data,
    # the aggregate keeps the score expression out of the lambda below
    # (otherwise it would be inlined and re-evaluated per grid element).
    comp = compressed(scores, by, label, score, weight)
    bucketed = comp.groupBy(*by, F.size(F.filter(arr, lambda t: t <= F.col("s"))).alias("_b")).agg(
        F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg")
    )
    if not by:
        raise ValueError("threshold_sweep needs at least one grouping column")
    # (groups x grid) rows: the join below touches only the per-bucket counts
    tau_tbl = bucketed.select(*by).distinct().withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(len(taus)))))
    j = tau_tbl.join(bucketed, by, "inner").where(F.col("_b") >= F.col("_k"))
    above = j.groupBy(*by, "_k").agg(F.sum("_pos").alias("tp"), F.sum("_neg").alias("fp"))
    tot = bucketed.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    x = tau_tbl.join(above, [*by, "_k"], "left").join(tot, by).fillna(0.0, ["tp", "fp"])
    conf = x.select(
        *by, F.element_at(arr, F.col("_k")).alias("tau"), "tp", "fp",
        (F.col("_N") - F.col("fp")).alias("tn"), (F.col("_P") - F.col("tp")).alias("fn"),
        (F.col("_P") + F.col("_N")).alias("n"),
    )
    return rates(conf)


def optimise_threshold(scores: DataFrame, taus: list[float], by: list[str], weight: str | None = None) -> DataFrame:
    """F8: tau with the highest F1 per group (first, i.e. lowest, tau on ties)."""
    sw = threshold_sweep(scores, taus, by, weight=weight)
    w = Window.partitionBy(*by).orderBy(F.desc("f1"), "tau")  # <= len(taus) rows per group
    return sw.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*by, "tau", "f1", "precision", "recall", "accuracy")


def honest_threshold(scores: DataFrame, taus: list[float], by: list[str] = ("run",), split: str = "split",
                     fit_split: str = "val", eval_split: str = "test") -> DataFrame:
    """Best-F1 tau chosen on ``fit_split`` (honest) and on ``eval_split``
    (optimistic), both applied to ``eval_split``."""
    by = list(by)
    best = optimise_threshold(scores, taus, [*by, split]).where(F.col(split).isin(fit_split, eval_split))
    sw = threshold_sweep(scores.where(F.col(split) == eval_split), taus, by)
    j = best.select(*by, F.col(split).alias("chosen_on"), "tau").join(sw, [*by, "tau"])
    return j.select(*by, "chosen_on", "tau", "f1", "precision", "recall", "accuracy")


# ---------------------------------------------------------------- G12
def loss(scores: DataFrame, kind: str = "bce", by: list[str] = (), pos_weight: float | None = None, gamma: float = 2.0,
         alpha: tuple[float, float] | None = None, epsilon: float = 0.05, eps: float = 1e-7,
         label: str = Y, score: str = P) -> DataFrame:
    """Mean loss over scored rows from logits x = logit(clip(p)).

    bce: pw*y*softplus(-x) + (1-y)*softplus(x); focal: alpha_t (1-p_t)^gamma bce
    with p_t = exp(-bce); smooth: bce against y(1-eps) + eps/2."""
    x = logit(score, eps)
    y = F.col(label).cast("double")
    pw = F.lit(float(pos_weight) if pos_weight is not None else 1.0)
    if kind == "bce":
        per = pw * y * softplus(-x) + (F.lit(1.0) - y) * softplus(x)
    elif kind == "focal":
        bce = y * softplus(-x) + (F.lit(1.0) - y) * softplus(x)
        a_t = (F.lit(alpha[0]) * y + F.lit(alpha[1]) * (F.lit(1.0) - y)) if alpha else F.lit(1.0)
        per = a_t * F.pow(F.lit(1.0) - F.exp(-bce), F.lit(gamma)) * bce
    elif kind == "smooth":
        t = y * F.lit(1.0 - epsilon) + F.lit(0.5 * epsilon)
        per = pw * t * softplus(-x) + (F.lit(1.0) - t) * softplus(x)
    else:
        raise ValueError(f"unknown loss {kind!r}")
    return scores.groupBy(*by).agg(F.avg(per).alias("loss"))


# ---------------------------------------------------------------- G13
def ensemble(scores: DataFrame, runs: list[str], mode: str | list[str] = "arithmetic", name: str | list[str] = "ensemble", tau: float = 0.5,
             by: list[str] = ("split",), eps: float = 1e-7, round_dp: int | None = None) -> DataFrame:
    """Average the given runs per row (arithmetic mean of p, or
    sigmoid of the mean clipped logit). Needs >= 2 runs; a row whose runs
    disagree on y_true, or that is missing from a run, raises at execution.
    Several modes, with a name each, share one aggregate over the rows."""
    modes, names = ([x] if isinstance(x, str) else list(x) for x in (mode, name))
    if len(runs) < 2:
        raise ValueError("an ensemble needs at least two runs")
    for m in modes:
        if m not in ("arithmetic", "geometric"):
            raise ValueError(f"mode must be 'arithmetic' or 'geometric', got {m!r}")
    if len(modes) != len(names):
        raise ValueError("each mode needs a name")
    by = list(by)
    sub = scores.where(F.col("run").isin(runs))
    # one flag for each run: a distinct count would shuffle every score row once more
    flags = [F.max(F.col("run") == r).alias(f"_r{i}") for i, r in enumerate(sorted(set(runs)))]
    g = sub.groupBy(*by, "row_id").agg(
        *(F.avg(F.col(P).cast("double") if m == "arithmetic" else logit(P, eps)).alias(f"_a{i}") for i, m in enumerate(modes)),
        F.min(Y).alias("_ymin"), F.max(Y).alias("_ymax"), *flags,
    )
    found = reduce(lambda a, b: a + b, [F.col(f"_r{i}").cast("int") for i in range(len(flags))])
    checked = F.when(F.col("_ymin") != F.col("_ymax"), F.raise_error(F.lit("ensemble inputs disagree on y_true"))) \
        .when(found != len(runs), F.raise_error(F.lit("ensemble inputs are not aligned (row missing from a run)"))) \
        .otherwise(F.col("_ymin"))
    probs = [F.col(f"_a{i}") if m == "arithmetic" else sigmoid(f"_a{i}") for i, m in enumerate(modes)]
    if round_dp is not None:  # deterministic half-up rounding (summation order cannot move a tie)
        scale = float(10 ** round_dp)
        probs = [F.floor(p * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale) for p in probs]
    if len(modes) == 1:
        out = g.select(F.lit(names[0]).alias("run"), *by, "row_id", checked.cast("int").alias(Y), probs[0].alias(P))
    else:
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("run"), p.alias(P)) for n, p in zip(names, probs))))
        out = g.select(*by, "row_id", checked.cast("int").alias(Y), each.alias("_e")).select("_e.run", *by, "row_id", Y, f"_e.{P}")
    return out.withColumn("y_pred", (F.col(P) >= F.lit(tau)).cast("int"))


# ---------------------------------------------------------------- G14-G19
def run_metrics(scores: DataFrame, tau: float = 0.5, by: list[str] = ("run", "split"), n_bins: int = 15) -> DataFrame:
    """The bundle plus specificity and kappa, per run and split."""
    by = list(by)
    b = metric_bundle(scores, tau, by, n_bins)
    extra = rates(confusion(scores, tau, by)).select(*by, "specificity", "kappa")
    return b.join(extra, by)


def aggregate_runs(metrics: DataFrame, by: list[str] = ("metric",), value: str = "value") -> DataFrame:
    """Mean and sample std over runs (std 0 for a single run); a NaN or
    NULL in any run makes both NaN."""
    by = list(by)
    v = F.col(value)
    bad = F.sum(F.when(v.isNull() | F.isnan(v), 1).otherwise(0))
    return metrics.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.when(bad > 0, F.lit(float("nan"))).otherwise(F.avg(v)).alias("mean"),
        F.when(bad > 0, F.lit(float("nan"))).when(F.count(F.lit(1)) > 1, F.stddev_samp(v)).otherwise(F.lit(0.0)).alias("std"),
    )


def comparison_table(agg: DataFrame, label: str = "model", order: list[str] | None = None, digits: int = 4) -> DataFrame:
    """G16: 'mean ± std' strings (em dash when undefined), one row per model
    and metric, with a fixed order key."""
    fmt = f"%.{digits}f"
    txt = F.when(F.col("mean").isNull() | F.isnan("mean"), F.lit("—")).when(
        F.col("std").isNull() | F.isnan("std") | (F.col("std") == 0), F.format_string(fmt, "mean")
    ).otherwise(F.concat(F.format_string(fmt, "mean"), F.lit(" ± "), F.format_string(fmt, "std")))
    out = agg.withColumn("cell", txt)
    if order:
        key = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(label)).cast("int")
        out = out.withColumn("order_key", key)
    return out


def parity(metrics: DataFrame, by: list[str] = ("run", "metric"), split: str = "split", value: str = "value") -> DataFrame:
    """Train / val / test side by side and the generalisation gaps."""
    p = metrics.groupBy(*by).pivot(split, ["train", "val", "test"]).agg(F.first(value))
    return p.withColumns({"gap_train_test": F.col("train") - F.col("test"), "gap_val_test": F.col("val") - F.col("test")})


def normalised_losses(preds: DataFrame, classes: dict[str, int], variances: dict[str, float]) -> DataFrame:
    """(feature, family, loss) from one row for each masked token:
    ``feature, family, p_true, value, predicted``. A classified feature's mean
    cross entropy is divided by the logarithm of its number of classes, a
    numeric one's mean squared error by its variance, so that 1 is a guess."""
    scale = {f: math.log(n) for f, n in classes.items()} | dict(variances)
    by_name = F.create_map(*[x for k, v in scale.items() for x in (F.lit(k), F.lit(float(v)))])
    raw = F.when(F.col("family") == "numerical", (F.col("value") - F.col("predicted")) ** 2).otherwise(-F.log(F.greatest(F.col("p_true"), F.lit(1e-12))))
    means = preds.groupBy("feature", "family").agg(F.avg(raw).alias("_raw"))
    return means.select("feature", "family", (F.col("_raw") / by_name[F.col("feature")]).alias("loss"))


def reconstruction_score(preds: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per-feature normalised loss (feature, family, loss) -> family means
    and the weighted total. Families: categorical, pay, numerical."""
    fam = preds.groupBy("family").agg(F.avg("loss").alias("family_loss"))
    wts = weights or {"categorical": 1.0, "pay": 1.0, "numerical": 1.0}
    wcol = F.create_map(*[x for k, v in wts.items() for x in (F.lit(k), F.lit(float(v)))])
    tot = fam.agg((F.sum(F.col("family_loss") * wcol[F.col("family")]) / F.sum(wcol[F.col("family")])).alias("total"))
    return fam.withColumn("__k", F.lit(1)).join(tot.withColumn("__k", F.lit(1)), "__k").drop("__k")


def bundle_from_compressed(comp: DataFrame, by: list[str], tau: float = 0.5, n_bins: int = 10) -> DataFrame:
    """auc_roc, auc_pr, brier, ece, f1, accuracy from one compressed
    (by..., s, pos, neg) table (weighted counts per distinct score), so a
    large weighted input is aggregated once."""
    by = list(by)
    s, pos, neg = F.col("s"), F.col("pos"), F.col("neg")
    n = pos + neg
    rk = rank_from_compressed(comp, by)
    ge = s >= F.lit(tau)
    simple = comp.groupBy(*by).agg(
        (F.sum(pos * (s - 1.0) * (s - 1.0) + neg * s * s) / F.sum(n)).alias("brier"),
        F.sum(F.when(ge, pos).otherwise(0.0)).alias("tp"), F.sum(F.when(ge, neg).otherwise(0.0)).alias("fp"),
        F.sum(F.when(ge, 0.0).otherwise(neg)).alias("tn"), F.sum(F.when(ge, 0.0).otherwise(pos)).alias("fn"),
    ).withColumn("n", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))
    simple = rates(simple).select(*by, "brier", "f1", "accuracy", "precision", "recall")
    bins = comp.groupBy(*by, bin_index("s", linspace_inner(n_bins)).alias("_b")).agg(F.sum(pos).alias("_sy"), F.sum(s * n).alias("_sp"), F.sum(n).alias("_n"))
    ec = bins.groupBy(*by).agg((F.sum(F.abs(F.col("_sy") - F.col("_sp"))) / F.sum("_n")).alias("ece"))
    return rk.join(simple, by).join(ec, by)


def sweep_summary(results: DataFrame, config: str = "run", metric: str = "auc_roc", metrics: list[str] = ("auc_roc", "auc_pr", "f1", "brier")) -> DataFrame:
    """One row per configuration with its test metrics, ranked by
    ``metric`` (best first), plus the mean and sample std over configurations."""
    from pyspark.sql import Window

    w = Window.partitionBy().orderBy(F.desc(F.round(metric, 9)), config)  # one row per configuration
    ranked = results.select(config, *metrics).withColumn("rank", F.row_number().over(w).cast("int"))
    agg = results.agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics], *[F.stddev_samp(m).alias(f"std_{m}") for m in metrics])
    return ranked.withColumn("__k", F.lit(1)).join(F.broadcast(agg.withColumn("__k", F.lit(1))), "__k").drop("__k")
