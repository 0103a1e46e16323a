"""Subgroup fairness.

Attributes are melted into (attribute, code) by a generator, so one grouped
job computes every subgroup of every attribute for every run and
calibrator. The reference subgroup is the largest one per group (lowest
code on ties), picked with a window over the few subgroup rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin_index, linspace_inner
from .metrics import P, Y, binned_gap, compressed, kept, score_sums, sliced

# Human-readable labels of the protected attributes.
SEX_LABELS = {1: "Male", 2: "Female"}
EDUCATION_LABELS = {1: "Grad school", 2: "University", 3: "High school", 4: "Other"}
MARRIAGE_LABELS = {1: "Married", 2: "Single", 3: "Other"}
ATTRIBUTE_LABELS = {"SEX": SEX_LABELS, "EDUCATION": EDUCATION_LABELS, "MARRIAGE": MARRIAGE_LABELS}
MIN_SUBGROUP_N = 50


def melt_attributes(scores: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per (score row, attribute): ``attribute``, ``code`` (string)."""
    arr = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("code")) for a in attrs])
    keep = [c for c in scores.columns if c not in attrs]
    return scores.select(*keep, F.explode(arr).alias("_a")).select(*keep, "_a.attribute", "_a.code")


def subgroup_metrics(long: DataFrame, tau: float = 0.5, n_bins: int = 10, by: list[str] = ("run", "attribute", "code"),
                     label: str = Y, score: str = P) -> DataFrame:
    """N, base rate, selection rate, TPR, FPR (NULL without positives /
    negatives), AUC (NULL if single class), ECE and Brier per subgroup."""
    by = list(by)
    return _subgroup_table(compressed(long, by, label, score), by, tau, n_bins)


def _subgroup_table(comp: DataFrame, by: list[str], tau: float, n_bins: int) -> DataFrame:
    sums = score_sums(comp, by, tau, n_bins)
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    n = pos + neg
    return sums.select(
        *by, n.cast("long").alias("n"), (pos / n).alias("base_rate"), ((tp + fp) / n).alias("selection_rate"),
        F.try_divide(tp, pos).alias("tpr"), F.try_divide(fp, neg).alias("fpr"), (F.col("sq") / n).alias("brier"),
        "auc_roc", (binned_gap() / n).alias("ece"),
    )


def label_table(spark, labels: dict[str, dict] | None = None) -> DataFrame:
    labels = ATTRIBUTE_LABELS if labels is None else labels
    rows = [(a, str(k), v) for a, m in labels.items() for k, v in m.items()]
    return spark.createDataFrame(rows, "attribute string, code string, label string")


def audit_attributes(scores: DataFrame, attrs: list[str], labels: dict[str, dict] | None = None, tau: float = 0.5,
                     n_bins: int = 10, by: list[str] = ("run",), min_n: int = MIN_SUBGROUP_N) -> DataFrame:
    """Subgroup metrics for every attribute with labels (fallback: the
    code itself) and the ``underpowered`` flag (n < min_n).

    Rows are compressed with all attributes side by side, checkpointed while
    this is built, and dealt out by slices of the score; melted there, they
    are not shuffled for each attribute."""
    by = list(by)
    key = [*by, "attribute", "code"]
    dealt = sliced(kept(compressed(scores, [*by, *attrs]))).repartition(*by, "_bk")
    long = melt_attributes(dealt, attrs).groupBy(*by, "_bk", "attribute", "code", "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    m = _subgroup_table(long, key, tau, n_bins)
    lt = F.broadcast(label_table(scores.sparkSession, labels))  # a few dozen fixed rows
    return m.join(lt, ["attribute", "code"], "left").withColumns(
        {"label": F.coalesce(F.col("label"), F.col("code")), "underpowered": F.col("n") < F.lit(min_n)}
    )


def _code_order():
    return [F.col("code").try_cast("double").asc_nulls_last(), F.col("code").asc()]


def disparity(sub: DataFrame, by: list[str] = ("run", "attribute")) -> DataFrame:
    """Deltas and ratios against the largest subgroup of each group."""
    by = list(by)
    w = Window.partitionBy(*by).orderBy(F.desc("n"), *_code_order())  # a handful of subgroups per group
    refs = {"ref_label": "label", "r_sel": "selection_rate", "r_tpr": "tpr", "r_fpr": "fpr", "r_auc": "auc_roc", "r_ece": "ece"}
    j = sub.dropna("any", subset=by).withColumns({r: F.first(c).over(w) for r, c in refs.items()})
    finite = lambda c: c.isNotNull() & ~F.isnan(c)
    ratio = F.when(finite(F.col("selection_rate")) & finite(F.col("r_sel")) & (F.col("r_sel") != 0), F.col("selection_rate") / F.col("r_sel"))
    tpr_d = F.col("tpr") - F.col("r_tpr")
    fpr_d = F.col("fpr") - F.col("r_fpr")
    return j.select(
        *by, "code", "label", "ref_label", "n",
        (F.col("selection_rate") - F.col("r_sel")).alias("selection_rate_diff"),
        ratio.alias("selection_rate_ratio"),
        tpr_d.alias("tpr_diff"), fpr_d.alias("fpr_diff"),
        F.abs(tpr_d).alias("equal_opportunity_violation"),
        F.greatest(F.abs(tpr_d), F.abs(fpr_d)).alias("equalised_odds_violation"),
        (F.col("auc_roc") - F.col("r_auc")).alias("auc_diff"),
        (F.col("ece") - F.col("r_ece")).alias("ece_diff"),
    )


def subgroup_reliability(scores: DataFrame, attrs: list[str], n_bins: int = 10, by: list[str] = ("run",), min_n: int = MIN_SUBGROUP_N) -> DataFrame:
    """I4: reliability points per subgroup, subgroups with n < min_n skipped.

    Rows are counted by (attributes, bin) before they are melted, so what is
    melted and shuffled does not grow with the rows or their distinct scores."""
    from .calibrate import points_of_bins

    by = list(by)
    cells = scores.groupBy(*by, *attrs, bin_index(F.col(P).cast("double"), linspace_inner(n_bins)).alias("bin")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(Y)).cast("double").alias("sy"), F.sum(F.col(P)).alias("sp"))
    key = [*by, "attribute", "code"]
    binned = melt_attributes(cells, attrs).groupBy(*key, "bin").agg(*(F.sum(c).alias(c) for c in ("n", "sy", "sp")))
    return points_of_bins(binned, key, min_n)


def attach_attributes(scores: DataFrame, accounts: DataFrame, attrs: list[str], left_key: str = "o_custkey", right_key: str = "row_id") -> DataFrame:
    """I5 alignment: equi-join score rows to the account attributes. Rows
    without an account would silently vanish in an inner join, so the join
    is left-outer and a missing account raises at execution."""
    a = accounts.select(F.col(right_key).alias("_acct"), *attrs)
    j = scores.join(a, scores[left_key] == a["_acct"], "left")
    return j.withColumn("_acct", F.when(F.col("_acct").isNull(), F.raise_error(F.lit("score rows without account attributes"))).otherwise(F.col("_acct"))).drop("_acct")


def audit_run(val: DataFrame, test: DataFrame, attrs: list[str], use_platt: bool = False, labels: dict | None = None,
              tau: float = 0.5, by: list[str] = ("run",)) -> DataFrame:
    """Optional Platt fit on val and applied to test, then the audit on test."""
    from .calibrate import apply_platt, clip_probs, fit_platt

    by = list(by)
    if use_platt:
        cal = apply_platt(test, fit_platt(val, by), by)
        name = "platt"
    else:
        cal = test.withColumn(P, clip_probs(P))
        name = "identity"
    return audit_attributes(cal, attrs, labels, tau, by=by).withColumn("calibrator", F.lit(name))


def fairness_summary(disp: DataFrame, by: list[str] = ("run", "calibrator", "attribute")) -> DataFrame:
    """Worst-case gaps per (run, calibrator, attribute)."""
    return disp.groupBy(*by).agg(
        F.max(F.abs("selection_rate_diff")).alias("max_abs_dp_diff"),
        F.max("equal_opportunity_violation").alias("max_eo_violation"),
        F.max("equalised_odds_violation").alias("max_eodds_violation"),
        F.min("selection_rate_ratio").alias("min_selection_ratio"),
    )
