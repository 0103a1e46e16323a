"""Registered queries: scored-row metrics (G1-G19) and threshold search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..session import checkpoint_dir
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

BY = ["run", "split"]
TAUS_G10 = [0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60]
GRID_F8 = M.grid(0.10, 0.01, 80)
GRID_G11 = M.grid(0.05, 0.005, 181)
RATE_COLS = ["accuracy", "precision", "recall", "f1", "specificity", "kappa"]


def S(spark, sf):
    return fx.scores(spark, sf, attributes=False)


def W(body: str, *extra) -> str:
    return Q.with_fixtures(body, "scores", extra=list(extra))


@case("g1_confusion", W("select run, split, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(tn as bigint) as tn, "
                        "cast(fn as bigint) as fn, cast(tp + fp + tn + fn as bigint) as n from (" + Q.conf("scores", BY) + ") c"))
def q_g1(spark, sf):
    c = M.confusion(S(spark, sf), 0.5, BY)
    return c.select(*BY, *[F.col(x).cast("long").alias(x) for x in ("tp", "fp", "tn", "fn", "n")])


@case("g2_threshold_metrics", W("select run, split, " + ", ".join(RATE_COLS) + " from (" + Q.rates(Q.conf("scores", BY)) + ") r"),
      doubles=RATE_COLS)
def q_g2(spark, sf):
    return M.rates(M.confusion(S(spark, sf), 0.5, BY)).select(*BY, *RATE_COLS)


@case("g3_g4_auc_ap", W(Q.rank_metrics("scores", BY)), doubles=["auc_roc", "auc_pr"])
def q_g3(spark, sf):
    return M.rank_metrics(S(spark, sf), BY)


@case("g5_brier", W(Q.brier("scores", BY)), doubles=["brier"])
def q_g5(spark, sf):
    return M.brier(S(spark, sf), BY)


@case("g6_ece15", W(Q.ece("scores", BY, 15)), doubles=["ece"])
def q_g6(spark, sf):
    return M.ece(S(spark, sf), 15, BY)


@case("g7_metric_bundle", W(Q.bundle("scores", BY, 0.5, 15)), doubles=M.METRICS8)
def q_g7(spark, sf):
    return M.metric_bundle(S(spark, sf), 0.5, BY, 15)


def _roc_sql() -> str:
    r = Q.ranked("scores", BY)
    return W(
        f"select run, split, s as threshold, (tot_neg - (cum_neg - neg)) / tot_neg as fpr, (tot_pos - (cum_pos - pos)) / tot_pos as tpr from ({r}) r "
        "union all select distinct run, split, cast(null as double), 0.0, 0.0 from scores"
    )


@case("g8_roc_points", _roc_sql(), doubles=["threshold", "fpr", "tpr"])
def q_g8(spark, sf):
    return M.roc_points(S(spark, sf), BY)


def _pr_sql() -> str:
    r = Q.ranked("scores", BY)
    tp, fp = "(tot_pos - (cum_pos - pos))", "(tot_neg - (cum_neg - neg))"
    return W(
        f"select run, split, s as threshold, {tp} / ({tp} + {fp}) as precision, {tp} / tot_pos as recall, tot_pos / (tot_pos + tot_neg) as base_rate from ({r}) r "
        f"union all select run, split, cast(null as double), 1.0, 0.0, sum(y_true) / count(*) from scores group by run, split"
    )


@case("g9_pr_points", _pr_sql(), doubles=["threshold", "precision", "recall", "base_rate"])
def q_g9(spark, sf):
    return M.pr_points(S(spark, sf), BY)


def sweep_sql(src: str, by: list[str], taus: list[float]) -> str:
    s, _ = Q._by(by)
    parts = [
        f"select {s}{Q.lit(t)} as tau, * exclude ({', '.join(by)}) from ({Q.rates(Q.conf(src, by, t))}) r{i}" for i, t in enumerate(taus)
    ]
    return " union all ".join(parts)


@case("g10_threshold_sweep", W("select run, split, tau, cast(tp as bigint) as tp, cast(fp as bigint) as fp, " + ", ".join(RATE_COLS)
                               + " from (" + sweep_sql("scores", BY, TAUS_G10) + ") q"), doubles=["tau", *RATE_COLS])
def q_g10(spark, sf):
    sw = M.threshold_sweep(S(spark, sf), TAUS_G10, BY)
    return sw.select(*BY, "tau", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"), *RATE_COLS)


def best_sql(src: str, by: list[str], taus: list[float]) -> str:
    return (
        f"select * exclude (rn_) from (select {', '.join(by)}, tau, f1, precision, recall, accuracy, row_number() over "
        f"(partition by {', '.join(by)} order by f1 desc, tau) as rn_ from ({sweep_sql(src, by, taus)}) q) z where rn_ = 1"
    )


@case("f8_optimise_threshold", W(best_sql("scores", BY, GRID_F8)), doubles=["tau", "f1", "precision", "recall", "accuracy"])
def q_f8(spark, sf):
    return M.optimise_threshold(S(spark, sf), GRID_F8, BY)


@case(
    "g11_honest_threshold",
    W(
        "select b.run, b.split as chosen_on, b.tau, t.f1, t.precision, t.recall, t.accuracy from ("
        + best_sql("scores", BY, GRID_G11) + ") b join (" + sweep_sql("(select * from scores where split = 'test')", ["run"], GRID_G11)
        + ") t on b.run = t.run and b.tau = t.tau"
    ),
    doubles=["tau", "f1", "precision", "recall", "accuracy"],
)
def q_g11(spark, sf):
    return M.honest_threshold(S(spark, sf), GRID_G11, ["run"])


def _softplus(x: str) -> str:
    return f"(greatest({x}, 0.0) + ln(1 + exp(-abs({x}))))"


def _loss_sql() -> str:
    pc = "least(greatest(y_prob, 1e-7), 1 - 1e-7)"
    x = f"ln({pc} / (1 - {pc}))"
    y = "cast(y_true as double)"
    sp_neg, sp_pos = _softplus(f"(-{x})"), _softplus(x)
    bce_pw = f"({Q.lit(2.0)} * {y} * {sp_neg} + (1 - {y}) * {sp_pos})"
    bce = f"({y} * {sp_neg} + (1 - {y}) * {sp_pos})"
    focal = f"(({Q.lit(0.75)} * {y} + {Q.lit(0.25)} * (1 - {y})) * pow(1 - exp(-{bce}), {Q.lit(2.0)}) * {bce})"
    t = f"({y} * {Q.lit(0.95)} + {Q.lit(0.025)})"
    smooth = f"(1.0 * {t} * {sp_neg} + (1 - {t}) * {sp_pos})"
    return W(
        f"select run, split, avg({bce_pw}) as bce_pw2, avg({focal}) as focal, avg({smooth}) as smooth from scores group by run, split"
    )


@case("g12_losses", _loss_sql(), doubles=["bce_pw2", "focal", "smooth"])
def q_g12(spark, sf):
    s = S(spark, sf)
    a = M.loss(s, "bce", BY, pos_weight=2.0).withColumnRenamed("loss", "bce_pw2")
    b = M.loss(s, "focal", BY, gamma=2.0, alpha=(0.75, 0.25)).withColumnRenamed("loss", "focal")
    c = M.loss(s, "smooth", BY, epsilon=0.05).withColumnRenamed("loss", "smooth")
    return a.join(b, BY).join(c, BY)


ENS_ARITH = "select 'ens' as run, split, row_id, cast(min(y_true) as int) as y_true, avg(y_prob) as y_prob from scores group by split, row_id"


def _ens_geo() -> str:
    pc = "least(greatest(y_prob, 1e-7), 1 - 1e-7)"
    m = f"avg(ln({pc} / (1 - {pc})))"
    sig = f"case when {m} >= 0 then 1.0 / (1.0 + exp(-{m})) else exp({m}) / (1.0 + exp({m})) end"
    return f"select 'geo' as run, split, row_id, cast(min(y_true) as int) as y_true, {sig} as y_prob from scores group by split, row_id"


@case("g13_ensemble_arithmetic", W("select *, cast(case when y_prob >= 0.5 then 1 else 0 end as int) as y_pred from (" + ENS_ARITH + ") e"),
      doubles=["y_prob"])
def q_g13a(spark, sf):
    return M.ensemble(S(spark, sf), ["a", "b", "c"], "arithmetic", "ens")


@case("g13_ensemble_geometric", W("select *, cast(case when y_prob >= 0.5 then 1 else 0 end as int) as y_pred from (" + _ens_geo() + ") e"),
      doubles=["y_prob"])
def q_g13g(spark, sf):
    return M.ensemble(S(spark, sf), ["a", "b", "c"], "geometric", "geo")


@case(
    "g14_run_metrics",
    W("select b.*, r.specificity, r.kappa from (" + Q.bundle("scores", BY, 0.5, 15) + ") b join ("
      + Q.rates(Q.conf("scores", BY)) + ") r on b.run = r.run and b.split = r.split"),
    doubles=M.METRICS8 + ["specificity", "kappa"],
)
def q_g14(spark, sf):
    return M.run_metrics(S(spark, sf), 0.5, BY, 15)


def _long_sql(src: str, by: list[str], metrics: list[str]) -> str:
    return " union all ".join(f"select {', '.join(by)}, '{m}' as metric, cast({m} as double) as value from ({src}) q{i}" for i, m in enumerate(metrics))


AGG_SQL = (
    "select split, metric, cast(count(*) as bigint) as n_runs, "
    "case when count(*) filter (where value is null or isnan(value)) > 0 then cast('nan' as double) else avg(value) end as mean, "
    "case when count(*) filter (where value is null or isnan(value)) > 0 then cast('nan' as double) when count(*) > 1 then stddev_samp(value) else 0.0 end as std "
    "from ({long}) l group by split, metric"
)


@case("g15_aggregate_runs", W(AGG_SQL.format(long=_long_sql(Q.bundle("scores", BY, 0.5, 15), BY, M.METRICS8))), doubles=["mean", "std"])
def q_g15(spark, sf):
    long = M.metrics_long(M.metric_bundle(S(spark, sf), 0.5, BY, 15), BY)
    return M.aggregate_runs(long, ["split", "metric"])


@case(
    "g16_comparison_table",
    W(
        "select split, metric, n_runs, mean, std, case when mean is null or isnan(mean) then '—' "
        "when std is null or isnan(std) or std = 0 then printf('%.4f', mean) else printf('%.4f', mean) || ' ± ' || printf('%.4f', std) end as cell, "
        "cast(list_position(['auc_roc','auc_pr','f1','accuracy','precision','recall','brier','ece'], metric) as int) as order_key from ("
        + AGG_SQL.format(long=_long_sql(Q.bundle("scores", BY, 0.5, 15), BY, M.METRICS8)) + ") a"
    ),
    doubles=["mean", "std"],
)
def q_g16(spark, sf):
    long = M.metrics_long(M.metric_bundle(S(spark, sf), 0.5, BY, 15), BY)
    return M.comparison_table(M.aggregate_runs(long, ["split", "metric"]), label="metric", order=M.METRICS8)


@case(
    "g17_parity",
    W(
        "select run, metric, max(value) filter (where split = 'train') as train, max(value) filter (where split = 'val') as val, "
        "max(value) filter (where split = 'test') as test, max(value) filter (where split = 'train') - max(value) filter (where split = 'test') as gap_train_test, "
        "max(value) filter (where split = 'val') - max(value) filter (where split = 'test') as gap_val_test from ("
        + _long_sql(Q.bundle("scores", BY, 0.5, 15), BY, M.METRICS8) + ") l group by run, metric"
    ),
    doubles=["train", "val", "test", "gap_train_test", "gap_val_test"],
)
def q_g17(spark, sf):
    long = M.metrics_long(M.metric_bundle(S(spark, sf), 0.5, BY, 15), BY)
    return M.parity(long, ["run", "metric"]).withColumn("train", F.col("train").cast("double")).withColumn(
        "gap_train_test", F.col("gap_train_test").cast("double"))


def _r6(e: str) -> str:
    return f"floor(({e}) * cast(1000000.0 as double) + cast(0.5 as double)) / cast(1000000.0 as double)"


def _h2h_sql() -> str:
    ea = f"select run, split, row_id, y_true, {_r6('y_prob')} as y_prob from ({ENS_ARITH}) e1"
    eg = f"select run, split, row_id, y_true, {_r6('y_prob')} as y_prob from ({_ens_geo()}) e2"
    allr = f"select run, split, row_id, y_true, y_prob from scores union all {ea} union all {eg}"
    best = best_sql("allr", BY, GRID_F8)
    return Q.with_fixtures(
        "select b.run, b.split, b.auc_roc, b.auc_pr, b.f1, b.brier, b.ece, t.tau as val_tau, s.f1 as test_f1_at_val_tau from ("
        + Q.bundle("allr", BY, 0.5, 15) + ") b join (select * from (" + best + ") z where split = 'val') t on b.run = t.run "
        "join (" + sweep_sql("(select * from allr where split = 'test')", ["run"], GRID_F8) + ") s on s.run = b.run and s.tau = t.tau",
        "scores", extra=[("allr", allr)],
    )


@case("g18_head_to_head", _h2h_sql(), doubles=["auc_roc", "auc_pr", "f1", "brier", "ece", "val_tau", "test_f1_at_val_tau"])
def q_g18(spark, sf):
    s = S(spark, sf).select("run", "split", "row_id", "y_true", "y_prob")
    checkpoint_dir(spark)
    both = M.ensemble(s, ["a", "b", "c"], ["arithmetic", "geometric"], ["ens", "geo"], round_dp=6).drop("y_pred")
    # runs and ensembles are made once; every table below reads their distinct scores with counts
    allr = M.weighted(s.unionByName(both), BY).checkpoint(eager=True)
    b = M.metric_bundle(allr, 0.5, BY, 15, weight="w").select(*BY, "auc_roc", "auc_pr", "f1", "brier", "ece")
    t = M.optimise_threshold(allr, GRID_F8, BY, weight="w").where(F.col("split") == "val").select("run", F.col("tau").alias("val_tau"))
    sw = M.threshold_sweep(allr.where(F.col("split") == "test"), GRID_F8, ["run"], weight="w").select("run", F.col("tau").alias("val_tau"), F.col("f1").alias("test_f1_at_val_tau"))
    return b.join(t, "run").join(sw, ["run", "val_tau"])


F4_CLASSES = (
    "select run, split, 'class' as average, cast(1 as int) as cls, precision, recall, f1, cast(tp + fn as bigint) as support from (" + Q.rates(Q.conf("scores", BY)) + ") r "
    "union all select run, split, 'class', cast(0 as int), case when tn + fn > 0 then tn / (tn + fn) else 0.0 end, case when tn + fp > 0 then tn / (tn + fp) else 0.0 end, "
    "case when 2.0 * tn + fn + fp > 0 then 2.0 * tn / (2.0 * tn + fn + fp) else 0.0 end, cast(tn + fp as bigint) from (" + Q.conf("scores", BY) + ") c"
)


@case(
    "f4_classification_report",
    W("select * from per union all select run, split, 'macro', cast(null as int), avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from per group by run, split "
      "union all select run, split, 'weighted', cast(null as int), sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), "
      "cast(sum(support) as bigint) from per group by run, split", ("per", F4_CLASSES)),
    doubles=["precision", "recall", "f1"],
)
def q_f4(spark, sf):
    from ..operators.baseline import classification_report

    return classification_report(M.confusion(S(spark, sf), 0.5, BY), BY)


@case(
    "f5_cv_summary",
    W(
        "select run, metric, avg(value) as mean, stddev_pop(value) as std, min(value) as min, max(value) as max from ("
        + _long_sql(Q.bundle("(select *, cast(floor(" + Q.U("concat(row_id,'|fold')") + " * 5) as int) as fold from scores)", ["run", "fold"], 0.5, 15), ["run", "fold"], ["auc_roc", "auc_pr", "f1", "brier"])
        + ") l group by run, metric"
    ),
    doubles=["mean", "std", "min", "max"],
)
def q_f5(spark, sf):
    from ..functions.columns import uniform
    from ..operators.baseline import cv_summary

    s = S(spark, sf).withColumn("fold", F.floor(uniform(F.col("row_id"), "|fold") * 5).cast("int"))
    long = M.metrics_long(M.metric_bundle(s, 0.5, ["run", "fold"], 15), ["run", "fold"], ["auc_roc", "auc_pr", "f1", "brier"])
    return cv_summary(long, ["run", "metric"])


@case(
    "g19_sweep_summary",
    W("select b.run, b.auc_roc, b.auc_pr, b.f1, b.brier, cast(row_number() over (order by round(b.auc_roc, 9) desc, b.run) as int) as rank, "
      "avg(b.auc_roc) over () as mean_auc_roc, avg(b.auc_pr) over () as mean_auc_pr, avg(b.f1) over () as mean_f1, avg(b.brier) over () as mean_brier, "
      "stddev_samp(b.auc_roc) over () as std_auc_roc, stddev_samp(b.auc_pr) over () as std_auc_pr, stddev_samp(b.f1) over () as std_f1, "
      "stddev_samp(b.brier) over () as std_brier from (" + Q.bundle("(select * from scores where split = 'test')", ["run"], 0.5, 15) + ") b"),
    doubles=["auc_roc", "auc_pr", "f1", "brier"] + [f"{k}_{m}" for k in ("mean", "std") for m in ("auc_roc", "auc_pr", "f1", "brier")],
)
def q_g19(spark, sf):
    b = M.metric_bundle(S(spark, sf).where(F.col("split") == "test"), 0.5, ["run"], 15)
    return M.sweep_summary(b)


def _g20_sql() -> str:
    u = lambda tag: Q.U(f"concat(cast(row_id as varchar), '|{tag}')")
    parts = [f"select 'EDUCATION' as feature, 'categorical' as family, avg(-ln(greatest({u('edu_p')}, 1e-12))) / ln(7.0) as loss from accounts",
             f"select 'PAY_0', 'pay', avg(-ln(greatest({u('pay_p')}, 1e-12))) / ln(11.0) from accounts",
             "select 'AGE', 'numerical', avg(pow(AGE - MARRIAGE * 10.0, 2)) / 250.0 from accounts"]
    return Q.with_fixtures(
        "select family, loss as family_loss, (select avg(loss) from f) as total from f", "accounts", extra=[("f", " union all ".join(parts))])


@case("g20_reconstruction_score", _g20_sql(), doubles=["family_loss", "total"])
def q_g20(spark, sf):
    """Masked tokens of three families, their predictions hashed from the accounts' keys, normalised and averaged."""
    from ..functions.columns import uniform
    from ..sources import fixtures as fx

    a, k = fx.accounts(spark, sf), F.col("row_id").cast("string")
    none = F.lit(None).cast("double")
    row = lambda f, fam, p, v, q: F.struct(F.lit(f).alias("feature"), F.lit(fam).alias("family"), p.alias("p_true"), v.alias("value"), q.alias("predicted"))
    masked = F.array(
        row("EDUCATION", "categorical", uniform(k, "|edu_p"), none, none), row("PAY_0", "pay", uniform(k, "|pay_p"), none, none),
        row("AGE", "numerical", none, F.col("AGE").cast("double"), F.col("MARRIAGE") * F.lit(10.0)))
    preds = a.select(F.explode(masked).alias("r")).select("r.*")
    return M.reconstruction_score(M.normalised_losses(preds, {"EDUCATION": 7, "PAY_0": 11}, {"AGE": 250.0}))
