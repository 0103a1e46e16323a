"""Uncertainty from repeated stochastic predictions.

Input: long samples ``(row_id, t, p)`` and labels ``(row_id, y_true)``.
Per-row statistics are one ``groupBy(row_id)``; deferral curves rank rows by
a signal with the distributed prefix sums and evaluate all fractions from
(bucket, score)-compressed counts, never by re-scanning rows per fraction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bernoulli_entropy
from ..functions.ranks import prefix_sums
from ..session import checkpoint_dir
from .metrics import rank_metrics

SIGNALS = ("predictive_entropy", "aleatoric", "mutual_info", "std")
EPS = 1e-12


def uncertainty(samples: DataFrame, labels: DataFrame | None = None, key: str = "row_id", p: str = "p") -> DataFrame:
    """Mean, population std, predictive entropy H(mean), aleatoric
    E_t[H(p_t)] and mutual information (their difference) per row.

    With ``labels``, a row that has samples but no label raises at execution."""
    g = samples.groupBy(key).agg(
        F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"), F.avg(bernoulli_entropy(p, EPS)).alias("aleatoric"),
        F.count(F.lit(1)).cast("int").alias("n_samples"),
    )
    g = g.withColumn("predictive_entropy", bernoulli_entropy("mean", EPS)).withColumn(
        "mutual_info", F.col("predictive_entropy") - F.col("aleatoric")
    )
    if labels is None:
        return g
    joined = g.join(labels.withColumn("_labelled", F.lit(True)), key, "left")
    missing = F.raise_error(F.concat(F.lit("no label for row "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")
    return joined.where(F.when(F.col("_labelled").isNull(), missing).otherwise(F.lit(True))).drop("_labelled")


def fractions(step: float = 0.05, stop: float = 0.65) -> list[float]:
    """numpy.arange(0, stop, step) as the same doubles."""
    out, k = [], 0
    while k * step < stop - 1e-12:
        out.append(k * step)
        k += 1
    return out


def refuse_curve(unc: DataFrame, signals: tuple[str, ...] = SIGNALS, fracs: list[float] | None = None, tau: float = 0.5,
                 min_keep: int = 20, key: str = "row_id", label: str = "y_true") -> DataFrame:
    """Defer the round_half_even(N * f) most uncertain rows (signal
    descending, ties by key) and score the rest.

    Each row gets its position in the deferral order; for fraction k it is
    retained iff position > n_defer(k). Rows are reduced to per-(signal,
    bucket, score) counts, buckets being the intervals between consecutive
    n_defer values, so every fraction is evaluated from compressed counts.
    Jobs run while this is built."""
    unknown = [s for s in signals if s not in SIGNALS]
    if unknown:
        raise ValueError(f"Unknown signal: {unknown}")
    fr = fracs if fracs is not None else fractions()
    # samples are summed up once; the ranks and the counts below are read several times
    checkpoint_dir(unc.sparkSession)
    unc = unc.select(key, label, "mean", *signals).checkpoint(eager=True)
    arr = F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).cast("double").alias("u")) for s in signals])
    long = unc.select(key, label, "mean", F.explode(arr).alias("_s")).select(key, label, "mean", "_s.signal", "_s.u")
    long = long.withColumns({"_neg_u": -F.col("u"), "_one": F.lit(1)})
    ranked = prefix_sums(long, ["signal"], "_neg_u", ["_one"], tiebreak=[key])
    ranked = ranked.withColumnRenamed("cum__one", "pos").withColumnRenamed("tot__one", "N")
    nd = F.array(*[F.bround(F.col("N").cast("double") * F.lit(f), 0) for f in fr])
    # bucket b = number of fractions whose deferred set excludes this row: retained for k < b
    ranked = ranked.withColumn("_b", F.size(F.filter(nd, lambda d: d < F.col("pos"))))
    correct = ((F.col("mean") >= F.lit(tau)).cast("int") == F.col(label)).cast("double")
    comp = ranked.groupBy("signal", "_b", "N", F.col("mean").alias("s")).agg(
        F.sum(F.col(label).cast("double")).alias("pos"), F.sum(F.lit(1.0) - F.col(label).cast("double")).alias("neg"),
        F.sum(correct).alias("ok"),
    ).checkpoint(eager=True)
    # retained set of fraction k = buckets > k ; deferred = buckets <= k
    ks = F.sequence(F.lit(0), F.lit(len(fr) - 1))
    per_k = comp.withColumn("k", F.explode(ks)).withColumn("kept", F.col("_b") > F.col("k"))
    agg = per_k.groupBy("signal", "k", "N").agg(
        F.sum(F.when(F.col("kept"), F.col("pos") + F.col("neg")).otherwise(0.0)).alias("n_ret"),
        F.sum(F.when(F.col("kept"), F.col("ok")).otherwise(0.0)).alias("ok_ret"),
        F.sum(F.when(F.col("kept"), F.col("pos")).otherwise(0.0)).alias("pos_ret"),
        F.sum(F.when(~F.col("kept"), F.col("ok")).otherwise(0.0)).alias("ok_def"),
        F.sum(F.when(~F.col("kept"), F.col("pos")).otherwise(0.0)).alias("pos_def"),
    )
    kept_scores = per_k.where("kept").groupBy("signal", "k", "s").agg(F.sum("pos").alias("y1"), F.sum("neg").alias("y0"))
    expanded = kept_scores.select("signal", "k", "s", F.explode(F.array(
        F.struct(F.lit(1).alias("y"), F.col("y1").alias("w")), F.struct(F.lit(0).alias("y"), F.col("y0").alias("w")))).alias("_e")
    ).select("signal", "k", "s", "_e.y", "_e.w").where(F.col("w") > 0)
    auc = rank_metrics(expanded, ["signal", "k"], label="y", score="s", weight="w").select("signal", "k", "auc_roc")
    frl = F.array(*[F.lit(float(f)) for f in fr])
    out = agg.join(auc, ["signal", "k"], "left").select(
        "signal", F.element_at(frl, F.col("k") + 1).alias("fraction_deferred"),
        (F.col("N") - F.col("n_ret")).cast("long").alias("n_deferred"), F.col("n_ret").cast("long").alias("n_retained"),
        (F.col("ok_ret") / F.col("n_ret")).alias("accuracy_retained"), F.col("auc_roc").alias("auc_roc_retained"),
        F.when(F.col("N") - F.col("n_ret") > 0, F.col("ok_def") / (F.col("N") - F.col("n_ret"))).otherwise(F.lit(float("nan"))).alias("defer_accuracy"),
        F.when(F.col("N") - F.col("n_ret") > 0, F.col("pos_def") / (F.col("N") - F.col("n_ret"))).otherwise(F.lit(float("nan"))).alias("defer_positive_rate"),
        "pos_ret",
    )
    return out.where((F.col("n_retained") >= min_keep) & (F.col("pos_ret") > 0) & (F.col("pos_ret") < F.col("n_retained"))).drop("pos_ret")


def spearman(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Spearman correlation (average ranks for ties) = Pearson on mid-ranks.

    Rows are compressed to distinct (x, y) pairs; each margin's mid-ranks come
    from the distributed prefix sums over distinct values; the correlation is
    a weighted Pearson over the pairs."""
    by = list(by)
    pairs = df.groupBy(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    g = by or ["_all"]
    if not by:
        pairs = pairs.withColumn("_all", F.lit(0))
    checkpoint_dir(df.sparkSession)
    pairs = pairs.checkpoint(eager=True)  # both margins and the sums read it

    def ranks(col: str) -> DataFrame:
        c = pairs.groupBy(*g, col).agg(F.sum("_w").alias("_c"))
        r = prefix_sums(c, g, col, ["_c"])
        return r.select(*g, col, (F.col("cum__c") - F.col("_c") + (F.col("_c") + 1.0) / 2.0).alias(f"r{col}"))

    j = pairs.join(ranks("_x"), [*g, "_x"]).join(ranks("_y"), [*g, "_y"])
    w, a, b = F.col("_w"), F.col("r_x"), F.col("r_y")
    s = j.groupBy(*g).agg(
        F.sum(w).alias("n"), F.sum(w * a).alias("sa"), F.sum(w * b).alias("sb"), F.sum(w * a * a).alias("saa"),
        F.sum(w * b * b).alias("sbb"), F.sum(w * a * b).alias("sab"),
    )
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    out = s.select(*g, F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb)).alias("spearman"), F.col("n").cast("long").alias("n"))
    return out.drop("_all") if not by else out


def headline(unc: DataFrame, tau: float = 0.5, label: str = "y_true") -> DataFrame:
    """AUC of the mean, accuracy, mean entropies and Spearman(entropy, misclassified)."""
    checkpoint_dir(unc.sparkSession)
    unc = unc.select(label, "mean", "predictive_entropy", "aleatoric", "mutual_info", "std").checkpoint(eager=True)  # samples are summed up once
    x = unc.withColumns({"_g": F.lit(0), "_mis": ((F.col("mean") >= F.lit(tau)).cast("int") != F.col(label)).cast("int")})
    a = x.groupBy("_g").agg(
        F.avg(1 - F.col("_mis")).alias("accuracy_at_0_5"), F.avg("predictive_entropy").alias("mean_predictive_entropy"),
        F.avg("aleatoric").alias("mean_aleatoric_entropy"), F.avg("mutual_info").alias("mean_mutual_information"),
        F.avg("std").alias("mean_std"),
    )
    auc = rank_metrics(x, ["_g"], label=label, score="mean").select("_g", F.col("auc_roc").alias("auc_roc_mean"))
    sp = spearman(x, "predictive_entropy", "_mis", ["_g"]).select("_g", F.col("spearman").alias("entropy_misclass_correlation"))
    return reduce(lambda l, r: l.join(r, "_g"), [a, auc, sp]).drop("_g")


def entropy_hist(unc: DataFrame, bins: int = 30, tau: float = 0.5, label: str = "y_true", col: str = "predictive_entropy") -> DataFrame:
    """Counts per equal-width bin over the common [min, max] range, correct vs incorrect."""
    x = unc.withColumns({"_g": F.lit(0), "correct": ((F.col("mean") >= F.lit(tau)).cast("int") == F.col(label))})
    rng = x.groupBy("_g").agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = x.join(F.broadcast(rng), "_g")  # one row
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width > 0, F.least(F.floor((F.col(col) - F.col("_lo")) / width * F.lit(float(bins))), F.lit(bins - 1))).otherwise(0)
    return j.groupBy("correct", b.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.min(F.col("_lo")).alias("range_lo"),
        F.max(F.col("_hi")).alias("range_hi"),
    )
