"""Profiling statistics (E1-E35): the tables behind the EDA figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import wilson


def zero_inflation(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Per month zero-payment share, avoidance share (pay 0, bill > 0),
    target rates for zero / non-zero / avoidance and risk ratio (0 guard)."""
    y = F.col(target).cast("double")
    parts = []
    for i in range(1, 7):
        pay, bill = F.col(f"PAY_AMT{i}"), F.col(f"BILL_AMT{i}")
        zero, avoid = pay == 0, (pay == 0) & (bill > 0)
        parts.append(F.struct(
            F.lit(i).alias("month"), F.lit(f"PAY_AMT{i}").alias("feature"),
            zero.cast("int").alias("z"), avoid.cast("int").alias("a"), (pay > 0).cast("int").alias("nz"), y.alias("y"),
        ))
    long = df.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    g = long.groupBy("month", "feature").agg(
        (F.lit(100.0) * F.sum("z") / F.count(F.lit(1))).alias("pct_zero"),
        (F.lit(100.0) * F.sum("a") / F.count(F.lit(1))).alias("pct_avoidance"),
        F.avg(F.when(F.col("z") == 1, F.col("y"))).alias("dr_zero"),
        F.avg(F.when(F.col("nz") == 1, F.col("y"))).alias("dr_nonzero"),
        F.coalesce(F.avg(F.when(F.col("a") == 1, F.col("y"))), F.lit(0.0)).alias("dr_avoidance"),
    )
    return g.withColumn(
        "risk_ratio", F.when(F.col("dr_nonzero") > 0, F.col("dr_zero") / F.col("dr_nonzero")).otherwise(F.lit(0.0))
    )


def rate_by_value(df: DataFrame, x: str, target: str = S.TARGET, z: float = 1.96) -> DataFrame:
    """N, target rate and Wilson interval per level of ``x``."""
    g = df.groupBy(x).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("rate"))
    lo, hi = wilson("rate", "n", z)
    return g.select(x, "n", "rate", lo.alias("ci_lo"), hi.alias("ci_hi"))


# ---------------------------------------------------------------- imports used below
from functools import reduce  # noqa: E402

from pyspark.sql import Window  # noqa: E402

from ..functions.dist import chi2_sf, ks_sf, norm_sf, t_sf2  # noqa: E402
from ..functions.ranks import exact_quantiles, prefix_sums  # noqa: E402
from .clean import melt, sample_kurtosis, sample_skew  # noqa: E402


def _y(target: str):
    return F.col(target).cast("int")


def class_distribution(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """N and share per class, imbalance ratio and majority-class accuracy."""
    g = df.groupBy(_y(target).alias("cls")).agg(F.count(F.lit(1)).cast("long").alias("n"))
    w = Window.partitionBy()  # two rows
    return g.select("cls", "n", (F.col("n") / F.sum("n").over(w)).alias("share"),
                    (F.max("n").over(w) / F.min("n").over(w)).alias("imbalance"),
                    (F.max("n").over(w) / F.sum("n").over(w)).alias("majority_accuracy"))


def contingency(df: DataFrame, xs: list[str], target: str = S.TARGET) -> DataFrame:
    """(feature, level, cls, observed) with every level x class cell present (zero-filled)."""
    long = melt(df, xs, keep=[target]).withColumn("level", F.col("value")).drop("value")
    obs = long.groupBy("feature", "level", _y(target).alias("cls")).agg(F.count(F.lit(1)).cast("double").alias("o"))
    classes = long.select("feature", _y(target).alias("cls")).distinct()
    levels = long.select("feature", "level").distinct()
    grid = levels.join(classes, "feature")  # levels x classes per feature (small)
    return grid.join(obs, ["feature", "level", "cls"], "left").fillna(0.0, ["o"])


def chi2_test(df: DataFrame, xs: list[str], target: str = S.TARGET, yates_2x2: bool = True) -> DataFrame:
    """Pearson chi-square of independence per feature (Yates
    correction when dof = 1), dof, p-value, Cramer's V and effect label."""
    c = contingency(df, xs, target)
    # totals by aggregation: no task holds all levels of a feature
    rows = c.groupBy("feature", "level").agg(F.sum("o").alias("_rt"))
    columns = c.groupBy("feature", "cls").agg(F.sum("o").alias("_ct"))
    whole = rows.groupBy("feature").agg(F.sum("_rt").alias("_N"), F.count(F.lit(1)).cast("int").alias("_r"))
    c = c.join(rows, ["feature", "level"]).join(columns, ["feature", "cls"]).join(whole, "feature").join(columns.groupBy("feature").agg(F.count(F.lit(1)).cast("int").alias("_c")), "feature")
    e = F.col("_rt") * F.col("_ct") / F.col("_N")
    dof = (F.col("_r") - 1) * (F.col("_c") - 1)
    diff = F.abs(F.col("o") - e)
    corr = F.when((dof == 1) & F.lit(yates_2x2), F.least(F.lit(0.5), diff)).otherwise(0.0)
    g = c.withColumn("_t", (diff - corr) * (diff - corr) / e).groupBy("feature").agg(
        F.sum("_t").alias("chi2"), F.first(dof).cast("int").alias("dof"), F.first("_N").alias("_N"),
        F.first(F.least(F.col("_r"), F.col("_c"))).alias("_k"))
    v = F.sqrt(F.col("chi2") / (F.col("_N") * F.greatest(F.col("_k") - 1, F.lit(1))))
    return g.select("feature", "chi2", "dof", chi2_sf("chi2", "dof").alias("p_value"), v.alias("cramers_v"),
                    F.when(v < 0.1, "negligible").when(v < 0.3, "small").otherwise("medium").alias("effect"))


def rate_by_level(df: DataFrame, xs: list[str], target: str = S.TARGET, z: float = 1.96) -> DataFrame:
    """N, target rate and Wilson interval per level of each feature."""
    long = melt(df, xs, keep=[target])
    g = long.groupBy("feature", F.col("value").alias("level")).agg(F.count(F.lit(1)).alias("n"), F.avg(_y(target).cast("double")).alias("rate"))
    lo, hi = wilson("rate", "n", z)
    return g.withColumns({"ci_lo": lo, "ci_hi": hi})


def mann_whitney(df: DataFrame, xs: list[str], target: str = S.TARGET) -> DataFrame:
    """E5: U of the class-0 sample, tie-corrected normal approximation with
    continuity (two-sided, on max(U0, U1)), and rank-biserial 1 - 2U/(n0 n1)."""
    long = melt(df, xs, keep=[target])
    comp = long.groupBy("feature", "value").agg(F.sum(F.when(_y(target) == 0, 1.0).otherwise(0.0)).alias("c0"),
                                                F.sum(F.when(_y(target) == 1, 1.0).otherwise(0.0)).alias("c1"))
    comp = comp.withColumn("t", F.col("c0") + F.col("c1"))
    r = prefix_sums(comp, ["feature"], "value", ["t"])
    mid = F.col("cum_t") - F.col("t") + (F.col("t") + 1.0) / 2.0
    g = r.groupBy("feature").agg(F.sum(F.col("c0") * mid).alias("R0"), F.sum("c0").alias("n0"), F.sum("c1").alias("n1"),
                                 F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties"))
    n0, n1 = F.col("n0"), F.col("n1")
    n = n0 + n1
    u0 = F.col("R0") - n0 * (n0 + 1.0) / 2.0
    mu = n0 * n1 / 2.0
    sigma = F.sqrt(n0 * n1 / 12.0 * ((n + 1.0) - F.col("ties") / (n * (n - 1.0))))
    umax = F.greatest(u0, n0 * n1 - u0)
    zz = (umax - mu - 0.5) / sigma
    return g.select("feature", u0.alias("u"), zz.alias("z"), F.least(F.lit(1.0), F.lit(2.0) * norm_sf(zz)).alias("p_value"),
                    (F.lit(1.0) - F.lit(2.0) * u0 / (n0 * n1)).alias("rank_biserial"))


def ks_two_sample(df: DataFrame, xs: list[str], target: str = S.TARGET) -> DataFrame:
    """D = max |F0 - F1| over distinct values; asymptotic p = Q_KS(sqrt(n0 n1/(n0+n1)) D)."""
    long = melt(df, xs, keep=[target])
    comp = long.groupBy("feature", "value").agg(F.sum(F.when(_y(target) == 0, 1.0).otherwise(0.0)).alias("c0"),
                                                F.sum(F.when(_y(target) == 1, 1.0).otherwise(0.0)).alias("c1"))
    r = prefix_sums(comp, ["feature"], "value", ["c0", "c1"])
    g = r.groupBy("feature").agg(F.max(F.abs(F.col("cum_c0") / F.col("tot_c0") - F.col("cum_c1") / F.col("tot_c1"))).alias("d"),
                                 F.first("tot_c0").alias("n0"), F.first("tot_c1").alias("n1"))
    lam = F.sqrt(F.col("n0") * F.col("n1") / (F.col("n0") + F.col("n1"))) * F.col("d")
    return g.select("feature", "d", ks_sf(lam).alias("p_value"))


def cohens_d(df: DataFrame, xs: list[str], target: str = S.TARGET) -> DataFrame:
    """(mean0 - mean1) / pooled sample std."""
    long = melt(df, xs, keep=[target])
    g = long.groupBy("feature").agg(
        *[F.avg(F.when(_y(target) == k, F.col("value"))).alias(f"m{k}") for k in (0, 1)],
        *[F.var_samp(F.when(_y(target) == k, F.col("value"))).alias(f"v{k}") for k in (0, 1)],
        *[F.count(F.when(_y(target) == k, F.col("value"))).alias(f"n{k}") for k in (0, 1)])
    sp = F.sqrt(((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / (F.col("n0") + F.col("n1") - 2))
    return g.select("feature", "m0", "m1", ((F.col("m0") - F.col("m1")) / sp).alias("cohens_d"))


def quantile_compare(df: DataFrame, xs: list[str], target: str = S.TARGET, qs: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Per feature and quantile, class-0 and class-1 values and their ratio."""
    long = melt(df, xs, keep=[target]).withColumn("cls", _y(target))
    q = exact_quantiles(long, ["feature", "cls"], "value", list(qs))
    p = q.groupBy("feature", "q").agg(F.max(F.when(F.col("cls") == 0, F.col("value"))).alias("q_class0"),
                                      F.max(F.when(F.col("cls") == 1, F.col("value"))).alias("q_class1"))
    return p.withColumn("ratio", F.when(F.col("q_class0") != 0, F.col("q_class1") / F.col("q_class0")))


def level_counts(df: DataFrame, x: str, target: str = S.TARGET) -> DataFrame:
    """Counts per (level, class) including zero cells."""
    return contingency(df, [x], target).select(F.col("level").alias(x), "cls", F.col("o").cast("long").alias("n"))


def pay_panel(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Long monthly panel (row_id, cls, month 1..6, pay, bill, pay_amt)."""
    arr = F.array(*[F.struct(F.lit(i).alias("month"), F.col(p).alias("pay"), F.col(f"BILL_AMT{i}").alias("bill"), F.col(f"PAY_AMT{i}").alias("pay_amt"))
                    for i, p in enumerate(S.PAY_STATUS, start=1)])
    return df.select("row_id", _y(target).alias("cls"), F.explode(arr).alias("_m")).select("row_id", "cls", "_m.*")


def month_value_share(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Share of each PAY value per (class, month), zero-filled over all observed values."""
    p = pay_panel(df, target)
    cnt = p.groupBy("cls", "month", "pay").agg(F.count(F.lit(1)).alias("n"))
    # (class, month) x observed values: both sides are small distinct sets
    grid = p.select("cls", "month").distinct().withColumn("_k", F.lit(1)).join(p.select("pay").distinct().withColumn("_k", F.lit(1)), "_k").drop("_k")
    tot = p.groupBy("cls", "month").agg(F.count(F.lit(1)).alias("tot"))
    return grid.join(cnt, ["cls", "month", "pay"], "left").join(tot, ["cls", "month"]).select(
        "cls", "month", "pay", (F.coalesce(F.col("n"), F.lit(0)) / F.col("tot")).alias("share"))


def trajectories(df: DataFrame, target: str = S.TARGET, z: float = 1.96) -> DataFrame:
    """Mean, SEM and CI per (class, group, month) for PAY status, bills and payments."""
    p = pay_panel(df, target)
    arr = F.array(*[F.struct(F.lit(g).alias("grp"), F.col(c).cast("double").alias("v")) for g, c in (("pay_status", "pay"), ("bill_amt", "bill"), ("pay_amt", "pay_amt"))])
    long = p.select("cls", "month", F.explode(arr).alias("_g")).select("cls", "month", "_g.*")
    g = long.groupBy("cls", "grp", "month").agg(F.avg("v").alias("mean"), (F.stddev_samp("v") / F.sqrt(F.count("v"))).alias("sem"))
    return g.withColumns({"ci_lo": F.col("mean") - F.lit(z) * F.col("sem"), "ci_hi": F.col("mean") + F.lit(z) * F.col("sem")})


def trend(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Spearman rho of the six monthly means against the month index per
    (class, group), t-test p-value (n - 2 dof) and its interpretation."""
    t = trajectories(df, target)
    w = Window.partitionBy("cls", "grp")  # six rows per group
    r = t.withColumns({"_rm": F.col("month").cast("double"),
                       "_rv": F.rank().over(w.orderBy("mean")) + (F.count(F.lit(1)).over(Window.partitionBy("cls", "grp", "mean")) - 1) / 2.0})
    g = r.groupBy("cls", "grp").agg(F.corr("_rm", "_rv").alias("rho"), F.count(F.lit(1)).alias("_n"))
    # month index 0..5 is in the same order as month 1..6, so ranks agree
    tt = F.col("rho") * F.sqrt((F.col("_n") - 2) / ((F.lit(1.0) - F.col("rho")) * (F.lit(1.0) + F.col("rho"))))
    p = F.when(F.abs(F.col("rho")) >= 1.0, F.lit(0.0)).otherwise(t_sf2(tt, F.col("_n") - 2))
    interp = F.when(F.abs("rho") > 0.8, "strong monotonic").when(F.abs("rho") > 0.5, "moderate").otherwise("weak")
    return g.select("cls", "grp", "rho", p.alias("p_value"), F.concat(interp, F.lit(" "), F.when(F.col("rho") > 0, "increasing").otherwise("decreasing")).alias("interpretation"))


def utilisation(df: DataFrame, target: str = S.TARGET, lo: float = -0.5, hi: float = 2.0, z: float = 1.96) -> DataFrame:
    """Utilisation bill/limit clipped to [lo, hi]: mean trajectory and CI per (class, month)."""
    arr = F.array(*[F.struct(F.lit(i).alias("month"), F.least(F.greatest(F.col(f"BILL_AMT{i}") / F.col("LIMIT_BAL"), F.lit(lo)), F.lit(hi)).alias("u"))
                    for i in range(1, 7)])
    long = df.where(F.col("LIMIT_BAL") != 0).select(_y(target).alias("cls"), F.explode(arr).alias("_u")).select("cls", "_u.*")
    g = long.groupBy("cls", "month").agg(F.avg("u").alias("mean"), (F.stddev_samp("u") / F.sqrt(F.count("u"))).alias("sem"))
    return g.withColumns({"ci_lo": F.col("mean") - F.lit(z) * F.col("sem"), "ci_hi": F.col("mean") + F.lit(z) * F.col("sem")})


def utilisation_distribution(df: DataFrame, month: int = 1, target: str = S.TARGET, lo: float = -0.5, hi: float = 2.0, bins: int = 80) -> DataFrame:
    """Histogram of one month's utilisation clipped to [lo, hi], counts and density per (class, bin)."""
    u = F.least(F.greatest(F.col(f"BILL_AMT{month}") / F.col("LIMIT_BAL"), F.lit(lo)), F.lit(hi))
    width = (hi - lo) / bins
    seen = df.where((F.col("LIMIT_BAL") != 0) & F.col(f"BILL_AMT{month}").isNotNull()).select(_y(target).alias("cls"), u.alias("u"))
    b = F.least(F.floor((F.col("u") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    g = seen.groupBy("cls", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("density", F.col("n") / (F.sum("n").over(Window.partitionBy("cls")) * F.lit(width)))  # at most ``bins`` rows


def repayment_median(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Median of pay / bill clipped to [0, 3] per (class, month); NULL
    when the bill is 0 (ignored by the median, not filled)."""
    arr = F.array(*[F.struct(F.lit(i).alias("month"), F.when(F.col(f"BILL_AMT{i}") != 0, F.least(F.greatest(F.col(f"PAY_AMT{i}") / F.col(f"BILL_AMT{i}"), F.lit(0.0)), F.lit(3.0))).alias("r"))
                    for i in range(1, 7)])
    long = df.select(_y(target).alias("cls"), F.explode(arr).alias("_r")).select("cls", "_r.*")
    return exact_quantiles(long, ["cls", "month"], "r", [0.5]).select("cls", "month", F.col("r").alias("median_ratio"))


def corr_matrix(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """Lower-triangle Pearson correlations (a before b in column
    order) in one pass; each pair over the rows in which both are present,
    whatever the number of columns."""
    by = list(by)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not by:
        return _corr_from_moments(df, cols)
    g = df.groupBy(*by).agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    st = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{k}").alias("r")) for k, (a, b) in enumerate(pairs)]))
    return g.select(*by, st.alias("_p")).select(*by, "_p.*")


def _corr_from_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairs at once: each task adds up every pair's moments by matrix
    products, about shared centres (the column means), over the rows in which
    both are present; a row for each pair and task is shuffled."""
    import numpy as np
    import pyarrow as pa

    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    centre = np.array([v or 0.0 for v in x.agg(*[F.avg(c) for c in x.columns]).first()])
    i, j = np.triu_indices(len(cols), 1)

    def moments(batches):
        total = None
        for batch in batches:
            v = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - centre[:, None]
            there = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            v = np.where(there > 0, v, 0.0)
            s, q = v @ there.T, (v * v) @ there.T
            now = np.stack([(there @ there.T)[i, j], s[i, j], s[j, i], q[i, j], q[j, i], (v @ v.T)[i, j]])
            total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(i.astype("int32")), pa.array(j.astype("int32")), *(pa.array(t) for t in total)], names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    parts = x.mapInArrow(moments, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
    g = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    r = (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)
    name = lambda k: F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(k) + 1)
    return g.select(name("i").alias("a"), name("j").alias("b"), F.when((vx > 0) & (vy > 0), r).alias("r"))


def lag_autocorr(df: DataFrame, cols: list[str] = S.BILL_AMT, target: str = S.TARGET, max_lag: int = 5, z: float = 1.96) -> DataFrame:
    """Per class and lag, mean Pearson r over all column pairs at that lag
    and a CI from the population std of those r over sqrt(pairs)."""
    pairs = [(lag, cols[i], cols[i + lag]) for lag in range(1, max_lag + 1) for i in range(len(cols) - lag)]
    g = df.groupBy(_y(target).alias("cls")).agg(*[F.corr(a, b).alias(f"c{k}") for k, (_, a, b) in enumerate(pairs)])
    st = F.explode(F.array(*[F.struct(F.lit(lag).alias("lag"), F.col(f"c{k}").alias("r")) for k, (lag, _, _) in enumerate(pairs)]))
    long = g.select("cls", st.alias("_p")).select("cls", "_p.*")
    r = long.groupBy("cls", "lag").agg(F.avg("r").alias("mean_r"), F.stddev_pop("r").alias("_sd"), F.count("r").alias("n_pairs"))
    return r.select("cls", "lag", "mean_r", "n_pairs", (F.lit(z) * F.col("_sd") / F.sqrt("n_pairs")).alias("ci_half"))


def association_rank(df: DataFrame, numeric: list[str], categorical: list[str], target: str = S.TARGET) -> DataFrame:
    """|point-biserial r| (with sign and t-test p) for numeric and PAY
    columns, Cramer's V for categorical ones, ranked by strength."""
    long = melt(df, numeric, keep=[target])
    pb = long.groupBy("feature").agg(F.corr("value", _y(target).cast("double")).alias("r"), F.count("value").alias("_n"))
    tt = F.col("r") * F.sqrt((F.col("_n") - 2) / (F.lit(1.0) - F.col("r") * F.col("r")))
    num = pb.select("feature", F.lit("point_biserial").alias("measure"), F.abs("r").alias("strength"),
                    F.when(F.col("r") >= 0, 1).otherwise(-1).alias("sign"), t_sf2(tt, F.col("_n") - 2).alias("p_value"))
    cat = chi2_test(df, categorical, target).select("feature", F.lit("cramers_v").alias("measure"), F.col("cramers_v").alias("strength"),
                                                   F.lit(None).cast("int").alias("sign"), "p_value")
    allm = num.unionByName(cat)
    return allm.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(F.round("strength", 9)), "feature")))  # one row per feature


def mutual_info(df: DataFrame, discrete: list[str], continuous: list[str], target: str = S.TARGET, bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) with the target; continuous
    columns are first cut at exact equal-mass quantile edges (bin = number
    of inner edges <= x)."""
    parts = []
    if discrete:
        parts.append(melt(df, discrete, keep=[target]).withColumn("level", F.col("value")))
    if continuous:
        long = melt(df, continuous, keep=[target])
        qs = [i / bins for i in range(1, bins)]
        e = exact_quantiles(long, ["feature"], "value", qs).groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("_e"))
        b = long.join(e, "feature").withColumn("level", F.size(F.filter("_e", lambda v: v <= F.col("value"))).cast("double")).drop("_e")
        parts.append(b)
    x = reduce(lambda a, b: a.unionByName(b), parts)
    c = x.groupBy("feature", "level", _y(target).alias("cls")).agg(F.count(F.lit(1)).cast("double").alias("nxy"))
    c = c.withColumns({"nx": F.sum("nxy").over(Window.partitionBy("feature", "level")), "ny": F.sum("nxy").over(Window.partitionBy("feature", "cls")),
                       "n": F.sum("nxy").over(Window.partitionBy("feature"))})
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return c.groupBy("feature").agg(F.sum(term).alias("mutual_info"))


def dagostino(df: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """D'Agostino-Pearson K^2 from the skewness and kurtosis z-scores; p = exp(-K^2/2)."""
    long = melt(df, cols)
    g = long.groupBy("feature").agg(F.count("value").cast("double").alias("n"), F.skewness("value").alias("b1"),
                                    (F.kurtosis("value") + 3.0).alias("b2"))
    n, b1, b2 = F.col("n"), F.col("b1"), F.col("b2")
    y = b1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + F.sqrt(2.0 * (beta2 - 1))
    delta = F.lit(1.0) / F.sqrt(0.5 * F.log(w2))
    al = F.sqrt(2.0 / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    zs = delta * F.log(y / al + F.sqrt((y / al) * (y / al) + 1))
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    t1 = F.lit(1.0) - F.lit(2.0) / (9.0 * a)
    den = F.lit(1.0) + x * F.sqrt(2.0 / (a - 4.0))
    t2 = F.signum(den) * F.pow((F.lit(1.0) - 2.0 / a) / F.abs(den), F.lit(1.0 / 3.0))
    zk = (t1 - t2) / F.sqrt(2.0 / (9.0 * a))
    k2 = zs * zs + zk * zk
    return g.select("feature", F.col("b1").alias("skew"), (F.col("b2") - 3.0).alias("kurtosis"), zs.alias("z_skew"), zk.alias("z_kurt"),
                    k2.alias("k2"), F.exp(-k2 / 2.0).alias("p_value"), (F.exp(-k2 / 2.0) >= alpha).alias("normal"))


def summary_stats(df: DataFrame, cols: list[str], target: str = S.TARGET) -> DataFrame:
    """Mean, sample std, mean by class, median, bias-corrected skew (G1) and excess kurtosis."""
    long = melt(df, cols, keep=[target])
    g = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                    F.avg(F.when(_y(target) == 0, F.col("value"))).alias("mean_0"),
                                    F.avg(F.when(_y(target) == 1, F.col("value"))).alias("mean_1"),
                                    sample_skew(F.col("value")).alias("skew"), sample_kurtosis(F.col("value")).alias("kurtosis"))
    med = exact_quantiles(long, ["feature"], "value", [0.5]).select("feature", F.col("value").alias("median"))
    return g.join(med, "feature")


def _edge_bin(x, edges: list[float]):
    """Right-closed bins over the given edges: number of edges strictly below x, minus one (lowest included)."""
    expr = sum([F.when(x > F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]], F.lit(0))
    return expr


def rate_grid(df: DataFrame, x: str, x_edges: list[float], zc: str, z_edges: list[float], target: str = S.TARGET) -> DataFrame:
    """Target rate and n on a 2-D grid of right-closed bins."""
    inside = (F.col(x) >= x_edges[0]) & (F.col(x) <= x_edges[-1]) & (F.col(zc) >= z_edges[0]) & (F.col(zc) <= z_edges[-1])
    return df.where(inside).groupBy(_edge_bin(F.col(x), x_edges).alias(f"{x}_bin"), _edge_bin(F.col(zc), z_edges).alias(f"{zc}_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(_y(target).cast("double")).alias("rate"))


def rate_by_bin(df: DataFrame, x: str, width: int, by: str, target: str = S.TARGET) -> DataFrame:
    """Target rate per (width-wide bin of x, by) with the bin midpoint."""
    b = (F.floor(F.col(x) / width) * width).cast("int")
    return df.groupBy(b.alias("bin"), F.col(by)).agg(F.count(F.lit(1)).alias("n"), F.avg(_y(target).cast("double")).alias("rate")).withColumn(
        "midpoint", F.col("bin") + F.lit(width / 2.0))


def box_stats(df: DataFrame, xs: list[str], target: str = S.TARGET, k: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (extreme values within k * IQR of the box) per (feature, class)."""
    long = melt(df, xs, keep=[target]).withColumn("cls", _y(target))
    q = exact_quantiles(long, ["feature", "cls"], "value", [0.25, 0.5, 0.75]).groupBy("feature", "cls").agg(
        *[F.max(F.when(F.col("q") == qq, F.col("value"))).alias(n) for qq, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    j = long.join(q, ["feature", "cls"])
    iqr = F.col("q3") - F.col("q1")
    return j.groupBy("feature", "cls", "q1", "median", "q3").agg(
        F.min(F.when(F.col("value") >= F.col("q1") - F.lit(k) * iqr, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(F.col("value") <= F.col("q3") + F.lit(k) * iqr, F.col("value"))).alias("whisker_hi"),
        F.count(F.lit(1)).alias("n"))


def clipped_boxes(df: DataFrame, cols: list[str], target: str = S.TARGET, lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    """Box statistics per class of columns clipped to their overall quantiles ``lo`` and ``hi``, with the
    Mann-Whitney test between the classes."""
    q = exact_quantiles(melt(df, cols), ["feature"], "value", [lo, hi])
    bounds = q.groupBy().agg(*(F.max(F.when((F.col("feature") == c) & (F.col("q") == x), F.col("value"))).alias(f"_{n}_{c}") for c in cols for x, n in ((lo, "lo"), (hi, "hi"))))
    wide = df.select(target, *cols).withColumn("_k", F.lit(1)).join(F.broadcast(bounds.withColumn("_k", F.lit(1))), "_k")  # one row of bounds
    clipped = wide.select(target, *(F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c).cast("double"), F.col(f"_lo_{c}")), F.col(f"_hi_{c}"))).alias(c) for c in cols))
    return box_stats(clipped, cols, target).join(mann_whitney(clipped, cols, target).select("feature", "u", "p_value"), "feature")


def transitions(df: DataFrame, frm: str = "PAY_2", to: str = "PAY_0", target: str = S.TARGET, lo: int = -2, hi: int = 4) -> DataFrame:
    """P(to | from) per class with both states clipped to [lo, hi]."""
    c = lambda col: F.least(F.greatest(F.col(col), F.lit(lo)), F.lit(hi)).cast("int")
    g = df.groupBy(_y(target).alias("cls"), c(frm).alias("from_state"), c(to).alias("to_state")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cls", "from_state")  # at most (hi-lo+1) rows
    return g.withColumns({"n_from": F.sum("n").over(w), "prob": F.col("n") / F.sum("n").over(w)})


def transition_gaps(df: DataFrame, min_n: int = 50, min_gap: float = 0.05, **kw) -> DataFrame:
    """Class-1 minus class-0 transition probabilities where both from-states have n > min_n and |gap| > min_gap."""
    t = transitions(df, **kw)
    a = t.where("cls = 0").select("from_state", "to_state", F.col("prob").alias("p0"), F.col("n_from").alias("n0"))
    b = t.where("cls = 1").select("from_state", "to_state", F.col("prob").alias("p1"), F.col("n_from").alias("n1"))
    j = a.join(b, ["from_state", "to_state"]).withColumn("gap", F.col("p1") - F.col("p0"))
    return j.where((F.col("n0") > min_n) & (F.col("n1") > min_n) & (F.abs("gap") > min_gap))


def ecdf(df: DataFrame, x: str, target: str = S.TARGET) -> DataFrame:
    """Empirical CDF per class at every distinct value; nulls are left out."""
    comp = df.where(F.col(x).isNotNull()).groupBy(_y(target).alias("cls"), F.col(x).cast("double").alias("value")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    r = prefix_sums(comp, ["cls"], "value", ["n"])
    return r.select("cls", "value", (F.col("cum_n") / F.col("tot_n")).alias("ecdf"))


def histogram(df: DataFrame, x: str, edges: list[float], target: str = S.TARGET) -> DataFrame:
    """Counts per class and bin (numpy convention: [e_i, e_i+1), last bin closed)."""
    xx = F.col(x).cast("double")
    inside = (xx >= edges[0]) & (xx <= edges[-1])
    b = sum([F.when(xx >= F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]], F.lit(0))
    return df.where(inside).groupBy(_y(target).alias("cls"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


#: Nodes in a bandwidth and bandwidths on either side of :func:`kde`.
KDE_NODES, KDE_REACH = 1024, 8.5


def kde(df: DataFrame, x: str, grid: list[float], target: str = S.TARGET) -> DataFrame:
    """Gaussian KDE per class on a grid, Scott bandwidth (std * n^-1/5); nulls are left out.

    Values are dealt linearly to nodes a 1/KDE_NODES of the bandwidth apart, and
    a grid point meets the nodes within KDE_REACH bandwidths only, through an
    equi-join on cells of that width. The error is below (1 / KDE_NODES)^2 / 8
    of the kernel's curvature, 1.2e-7 / bandwidth times 0.4, and the kernel
    beyond its reach is below 1e-15. A class of one value has no bandwidth and
    a null density."""
    import math

    value, cls = F.col(x).cast("double"), _y(target)
    seen = df.where(F.col(x).isNotNull())
    comp = seen.groupBy(cls.alias("cls"), value.alias("v")).agg(F.count(F.lit(1)).cast("double").alias("c"))
    st = seen.groupBy(cls.alias("cls")).agg(F.stddev_samp(value).alias("sd"), F.count(F.lit(1)).cast("double").alias("n"))
    st = st.select("cls", "n", (F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).alias("bw"))
    usable = F.col("bw") > 0
    at = F.col("v") / F.col("bw") * F.lit(float(KDE_NODES))
    share = at - F.floor(at)
    dealt = comp.join(st.where(usable), "cls").select("cls", F.explode(F.array(
        F.struct(F.floor(at).alias("node"), (F.col("c") * (1.0 - share)).alias("c")), F.struct((F.floor(at) + 1).alias("node"), (F.col("c") * share).alias("c")))).alias("_e"))
    cell = int(KDE_NODES * KDE_REACH)
    nodes = dealt.select("cls", "_e.*").groupBy("cls", "node").agg(F.sum("c").alias("c")).withColumn("cell", F.floor(F.col("node") / F.lit(float(cell))))
    points = st.withColumn("g", F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    place = F.col("g") / F.col("bw") * F.lit(float(KDE_NODES))
    spread = points.where(usable).withColumns({"place": place, "cell": F.explode(F.array(*(F.floor(place / F.lit(float(cell))) + d for d in (-1, 0, 1))))})
    u = (F.col("place") - F.col("node")) / F.lit(float(KDE_NODES))
    near = spread.join(nodes, ["cls", "cell"]).where(F.abs(u) <= KDE_REACH)
    mass = near.groupBy("cls", "g").agg(F.sum(F.col("c") * F.exp(-0.5 * u * u)).alias("mass"))
    density = F.when(usable, F.coalesce("mass", F.lit(0.0)) / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))))
    return points.join(mass, ["cls", "g"], "left").select("cls", "g", density.alias("density"))


def class_profile(df: DataFrame, cols: list[str], target: str = S.TARGET) -> DataFrame:
    """Class means normalised by each feature's overall min-max range."""
    long = melt(df, cols, keep=[target])
    g = long.groupBy("feature").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"),
                                    *[F.avg(F.when(_y(target) == k, F.col("value"))).alias(f"m{k}") for k in (0, 1)])
    rng = F.col("_mx") - F.col("_mn")
    return g.select("feature", *[F.when(rng != 0, (F.col(f"m{k}") - F.col("_mn")) / rng).alias(f"profile_{k}") for k in (0, 1)])


def state_composition(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Share of payment states per (class, month); 3 and above pooled."""
    p = pay_panel(df, target)
    state = (F.when(F.col("pay") <= -2, "no_use").when(F.col("pay") == -1, "paid_full").when(F.col("pay") == 0, "revolving")
             .when(F.col("pay") == 1, "delay_1").when(F.col("pay") == 2, "delay_2").otherwise("delay_3plus"))
    g = p.groupBy("cls", "month", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("cls", "month")))  # six states per group


def capped_summary(df: DataFrame, target: str = S.TARGET, q: float = 0.99) -> DataFrame:
    """Bills capped at their per-month q-quantile; mean and median per (class, month)."""
    p = pay_panel(df, target)
    cap = exact_quantiles(p, ["month"], "bill", [q]).select("month", F.col("bill").alias("cap"))
    c = p.join(F.broadcast(cap), "month").withColumn("capped", F.least(F.col("bill"), F.col("cap")))  # six rows
    m = c.groupBy("cls", "month").agg(F.avg("capped").alias("mean_capped"))
    med = exact_quantiles(c, ["cls", "month"], "capped", [0.5]).select("cls", "month", F.col("capped").alias("median_capped"))
    return m.join(med, ["cls", "month"])


def vif(df: DataFrame, cols: list[str], singular: float = 1e-10) -> DataFrame:
    """Variance inflation factors = diagonal of the inverse of the
    pairwise correlation matrix (one aggregate; only its p x p numbers reach
    the driver).

    +inf for a constant column, and for the columns that take part in a linear
    dependency (they have a part in an eigenvector whose eigenvalue is below
    ``singular``); the others have the factor that the independent part of the
    matrix gives. The rows come from a job that runs here."""
    import numpy as np

    place = {c: i for i, c in enumerate(cols)}
    m = np.eye(len(cols))
    for r in corr_matrix(df, cols).collect():
        m[place[r["a"]], place[r["b"]]] = m[place[r["b"]], place[r["a"]]] = np.nan if r["r"] is None else r["r"]
    off = np.isnan(m) & ~np.eye(len(cols), dtype=bool)
    constant = off.sum(1) == max(1, len(cols) - 1) if len(cols) > 1 else np.isnan(np.diag(m))
    d = np.full(len(cols), np.inf)
    left = np.flatnonzero(~constant)
    if len(left) and not np.isnan(m[np.ix_(left, left)]).any():
        values, vectors = np.linalg.eigh(m[np.ix_(left, left)])
        tiny = values < singular
        tied = (np.abs(vectors[:, tiny]) > 1e-6).any(1)
        d[left] = np.where(tied, np.inf, (vectors[:, ~tiny] ** 2 / values[~tiny]).sum(1))
    return df.sparkSession.createDataFrame([(c, float(x)) for c, x in zip(cols, d)], "feature string, vif double")


def qq_points(df: DataFrame, cols: list[str], grid: list[float]) -> DataFrame:
    """Sample quantiles on a probability grid next to standard-normal quantiles."""
    from ..functions.dist import norm_ppf_lit

    q = exact_quantiles(melt(df, cols), ["feature"], "value", grid)
    theo = df.sparkSession.createDataFrame([(float(p), norm_ppf_lit(p)) for p in grid], "q double, normal_quantile double")
    return q.join(F.broadcast(theo), "q")  # one row per grid point
