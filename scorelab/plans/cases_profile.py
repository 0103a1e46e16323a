"""Registered queries: profiling statistics (E1-E35) over the cleaned account table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import profile as PR
from ..operators.clean import clean_categoricals
from ..operators.neighbours import mutual_information
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

T = '"DEFAULT"'
CLEAN = ("select * replace (cast(case when EDUCATION in (0,5,6) then 4 else EDUCATION end as int) as EDUCATION, "
         "cast(case when MARRIAGE = 0 then 3 else MARRIAGE end as int) as MARRIAGE) from accounts")
CAT = ["SEX", "EDUCATION", "MARRIAGE"]
NUM = ["LIMIT_BAL", "AGE"] + S.BILL_AMT + S.PAY_AMT
CONT = ["LIMIT_BAL", "AGE", "BILL_AMT1", "PAY_AMT1"]


def A(spark, sf):
    return clean_categoricals(fx.accounts(spark, sf))


def W(body: str, *extra) -> str:
    return Q.with_fixtures(body, "accounts", extra=[("acc", CLEAN), *extra])


def melt_sql(cols: list[str], keep: str = f"{T}") -> str:
    return " union all ".join(f"select {keep}, '{c}' as feature, cast({c} as double) as value from acc" for c in cols)


@case("e1_class_distribution", W(f"select cast({T} as int) as cls, count(*) as n, count(*) / sum(count(*)) over () as share, "
                                 "max(count(*)) over () / min(count(*)) over () as imbalance, max(count(*)) over () / sum(count(*)) over () as majority_accuracy "
                                 f"from acc group by 1"), doubles=["share", "imbalance", "majority_accuracy"])
def q_e1(spark, sf):
    return PR.class_distribution(A(spark, sf))


def chi2_sql(cols: list[str]) -> str:
    long = f"select feature, value as level, cast({T} as int) as cls from ({melt_sql(cols)}) m"
    grid = "select l.feature, l.level, c.cls from (select distinct feature, level from lg) l join (select distinct feature, cls from lg) c on l.feature = c.feature"
    obs = "select feature, level, cls, count(*) * 1.0 as o from lg group by all"
    cells = (f"select g.feature, g.level, g.cls, coalesce(o.o, 0.0) as o from ({grid}) g left join ({obs}) o using (feature, level, cls)")
    m = ("select *, sum(o) over (partition by feature, level) as rt, sum(o) over (partition by feature, cls) as ct, sum(o) over (partition by feature) as N_, "
         "count(distinct level) over (partition by feature) as r_, count(distinct cls) over (partition by feature) as c_ from cells")
    e = "(rt * ct / N_)"
    t = (f"select feature, (abs(o - {e}) - case when (r_ - 1) * (c_ - 1) = 1 then least(0.5, abs(o - {e})) else 0.0 end) * "
         f"(abs(o - {e}) - case when (r_ - 1) * (c_ - 1) = 1 then least(0.5, abs(o - {e})) else 0.0 end) / {e} as t, "
         "cast((r_ - 1) * (c_ - 1) as int) as dof, N_, least(r_, c_) as k_ from m")
    g = "select feature, sum(t) as chi2, max(dof) as dof, max(N_) as N_, max(k_) as k_ from t group by feature"
    v = "sqrt(chi2 / (N_ * greatest(k_ - 1, 1)))"
    body = (f"select feature, chi2, dof, {Q.chi2_sf('chi2', 'dof')} as p_value, {v} as cramers_v, "
            f"case when {v} < 0.1 then 'negligible' when {v} < 0.3 then 'small' else 'medium' end as effect from g")
    return f"select * from (with lg as ({long}), cells as ({cells}), m as ({m}), t as ({t}), g as ({g}) {body}) z"


@case("e2_e4_chi2_cramers_v", W(chi2_sql(CAT + ["PAY_0"])), doubles=["chi2", "p_value", "cramers_v"])
def q_e2(spark, sf):
    return PR.chi2_test(A(spark, sf), CAT + ["PAY_0"])


@case("e2_e3_rate_by_level", W(
    "select feature, level, n, rate, (rate + 3.8415999999999997/(2*n)) / (1 + 3.8415999999999997/n) - 1.96 * sqrt((rate*(1-rate) + 3.8415999999999997/(4*n))/n) / (1 + 3.8415999999999997/n) as ci_lo, "
    "(rate + 3.8415999999999997/(2*n)) / (1 + 3.8415999999999997/n) + 1.96 * sqrt((rate*(1-rate) + 3.8415999999999997/(4*n))/n) / (1 + 3.8415999999999997/n) as ci_hi "
    f"from (select feature, value as level, count(*) as n, avg(cast({T} as double)) as rate from ({melt_sql(CAT)}) m group by all) g"),
    doubles=["level", "rate", "ci_lo", "ci_hi"])
def q_e2b(spark, sf):
    return PR.rate_by_level(A(spark, sf), CAT)


def mwu_sql(cols: list[str]) -> str:
    comp = (f"select feature, value, sum(case when {T} = 0 then 1.0 else 0.0 end) as c0, sum(case when {T} = 1 then 1.0 else 0.0 end) as c1 "
            f"from ({melt_sql(cols)}) m group by feature, value")
    r = ("select *, c0 + c1 as t, sum(c0 + c1) over (partition by feature order by value rows between unbounded preceding and current row) as cum from comp")
    g = ("select feature, sum(c0 * (cum - t + (t + 1.0) / 2.0)) as R0, sum(c0) as n0, sum(c1) as n1, sum(t * t * t - t) as ties from r group by feature")
    u0 = "(R0 - n0 * (n0 + 1.0) / 2.0)"
    sigma = "sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1.0) - ties / ((n0 + n1) * (n0 + n1 - 1.0))))"
    z = f"((greatest({u0}, n0 * n1 - {u0}) - n0 * n1 / 2.0 - 0.5) / {sigma})"
    body = f"select feature, {u0} as u, {z} as z, least(1.0, 2.0 * {Q.norm_sf(z)}) as p_value, 1.0 - 2.0 * {u0} / (n0 * n1) as rank_biserial from g"
    return f"select * from (with comp as ({comp}), r as ({r}), g as ({g}) {body}) z"


@case("e5_mann_whitney", W(mwu_sql(CONT)), doubles=["u", "z", "p_value", "rank_biserial"])
def q_e5(spark, sf):
    return PR.mann_whitney(A(spark, sf), CONT)


def ks_sql(cols: list[str]) -> str:
    comp = (f"select feature, value, sum(case when {T} = 0 then 1.0 else 0.0 end) as c0, sum(case when {T} = 1 then 1.0 else 0.0 end) as c1 "
            f"from ({melt_sql(cols)}) m group by feature, value")
    r = ("select *, sum(c0) over (partition by feature order by value rows between unbounded preceding and current row) as k0, "
         "sum(c1) over (partition by feature order by value rows between unbounded preceding and current row) as k1, "
         "sum(c0) over (partition by feature) as n0, sum(c1) over (partition by feature) as n1 from comp")
    g = "select feature, max(abs(k0 / n0 - k1 / n1)) as d, max(n0) as n0, max(n1) as n1 from r group by feature"
    return f"select * from (with comp as ({comp}), r as ({r}), g as ({g}) select feature, d, {Q.ks_sf('sqrt(n0 * n1 / (n0 + n1)) * d')} as p_value from g) z"


@case("e6_ks_two_sample", W(ks_sql(CONT)), doubles=["d", "p_value"])
def q_e6(spark, sf):
    return PR.ks_two_sample(A(spark, sf), CONT)


@case("e7_cohens_d", W(
    "select feature, m0, m1, (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)) as cohens_d from ("
    f"select feature, avg(value) filter (where {T} = 0) as m0, avg(value) filter (where {T} = 1) as m1, var_samp(value) filter (where {T} = 0) as v0, "
    f"var_samp(value) filter (where {T} = 1) as v1, count(value) filter (where {T} = 0) as n0, count(value) filter (where {T} = 1) as n1 "
    f"from ({melt_sql(CONT)}) m group by feature) g"), doubles=["m0", "m1", "cohens_d"])
def q_e7(spark, sf):
    return PR.cohens_d(A(spark, sf), CONT)


QS = [0.1, 0.25, 0.5, 0.75, 0.9]


@case("e8_quantile_compare", W(
    "select feature, q, q_class0, q_class1, case when q_class0 <> 0 then q_class1 / q_class0 end as ratio from ("
    + " union all ".join(f"select feature, {Q.lit(q)} as q, quantile_cont(value, {Q.lit(q)}) filter (where {T} = 0) as q_class0, "
                         f"quantile_cont(value, {Q.lit(q)}) filter (where {T} = 1) as q_class1 from ({melt_sql(CONT)}) m{i} group by feature" for i, q in enumerate(QS))
    + ") z"), doubles=["q", "q_class0", "q_class1", "ratio"])
def q_e8(spark, sf):
    return PR.quantile_compare(A(spark, sf), CONT, qs=tuple(QS))


@case("e9_level_counts", W(
    f"select l.EDUCATION, c.cls, cast(coalesce(o.n, 0) as bigint) as n from (select distinct cast(EDUCATION as double) as EDUCATION from acc) l "
    f"join (select distinct cast({T} as int) as cls from acc) c on true left join (select cast(EDUCATION as double) as EDUCATION, cast({T} as int) as cls, count(*) as n from acc group by all) o "
    "on o.EDUCATION = l.EDUCATION and o.cls = c.cls"), doubles=["EDUCATION"])
def q_e9(spark, sf):
    return PR.level_counts(A(spark, sf), "EDUCATION")


PANEL = " union all ".join(
    f"select row_id, cast({T} as int) as cls, {i} as month, {p} as pay, BILL_AMT{i} as bill, PAY_AMT{i} as pay_amt from acc"
    for i, p in enumerate(S.PAY_STATUS, start=1))


def WP(body: str, *extra) -> str:
    return W(body, ("panel", PANEL), *extra)


@case("e11_month_value_share", WP(
    "select g.cls, g.month, v.pay, coalesce(c.n, 0) / t.tot as share from (select distinct cls, month from panel) g join (select distinct pay from panel) v on true "
    "left join (select cls, month, pay, count(*) as n from panel group by all) c on c.cls = g.cls and c.month = g.month and c.pay = v.pay "
    "join (select cls, month, count(*) as tot from panel group by all) t on t.cls = g.cls and t.month = g.month"), doubles=["share"])
def q_e11(spark, sf):
    return PR.month_value_share(A(spark, sf))


TRAJ = ("select cls, grp, month, avg(v) as mean, stddev_samp(v) / sqrt(count(v)) as sem from ("
        "select cls, month, 'pay_status' as grp, cast(pay as double) as v from panel union all select cls, month, 'bill_amt', cast(bill as double) from panel "
        "union all select cls, month, 'pay_amt', cast(pay_amt as double) from panel) l group by cls, grp, month")


@case("e12_trajectories", WP(f"select *, mean - 1.96 * sem as ci_lo, mean + 1.96 * sem as ci_hi from ({TRAJ}) t"), doubles=["mean", "sem", "ci_lo", "ci_hi"])
def q_e12(spark, sf):
    return PR.trajectories(A(spark, sf))


def trend_sql() -> str:
    r = (f"select cls, grp, cast(month as double) as rm, rank() over (partition by cls, grp order by mean) + (count(*) over (partition by cls, grp, mean) - 1) / 2.0 as rv from ({TRAJ}) t")
    g = "select cls, grp, corr(rm, rv) as rho, count(*) as n_ from r group by cls, grp"
    tt = "(rho * sqrt((n_ - 2) / ((1.0 - rho) * (1.0 + rho))))"
    interp = "case when abs(rho) > 0.8 then 'strong monotonic' when abs(rho) > 0.5 then 'moderate' else 'weak' end"
    return WP(f"select cls, grp, rho, case when abs(rho) >= 1.0 then 0.0 else {Q.t_sf2(tt, 'n_ - 2')} end as p_value, "
              f"{interp} || ' ' || case when rho > 0 then 'increasing' else 'decreasing' end as interpretation from ({g}) g", ("r", r))


@case("e13_trend", trend_sql(), doubles=["rho", "p_value"])
def q_e13(spark, sf):
    return PR.trend(A(spark, sf))


UTIL = " union all ".join(f"select cast({T} as int) as cls, {i} as month, least(greatest(BILL_AMT{i} / LIMIT_BAL, -0.5), 2.0) as u from acc where LIMIT_BAL <> 0" for i in range(1, 7))


@case("e14_utilisation", W(f"select *, mean - 1.96 * sem as ci_lo, mean + 1.96 * sem as ci_hi from (select cls, month, avg(u) as mean, stddev_samp(u) / sqrt(count(u)) as sem from ({UTIL}) u group by all) g"),
      doubles=["mean", "sem", "ci_lo", "ci_hi"])
def q_e14(spark, sf):
    return PR.utilisation(A(spark, sf))


@case("e14_utilisation_distribution", W(
    f"select cls, bin, n, n / (sum(n) over (partition by cls) * 0.03125) as density from (select cls, cast(least(floor((u + 0.5) / 0.03125), 79) as int) as bin, count(*) as n from ({UTIL}) u where month = 1 group by all) g"),
    doubles=["density"])
def q_e14_distribution(spark, sf):
    return PR.utilisation_distribution(A(spark, sf))


REPAY = " union all ".join(f"select cast({T} as int) as cls, {i} as month, case when BILL_AMT{i} <> 0 then least(greatest(PAY_AMT{i} / BILL_AMT{i}, 0.0), 3.0) end as r from acc" for i in range(1, 7))


@case("e15_repayment_median", W(f"select cls, month, quantile_cont(r, 0.5) as median_ratio from ({REPAY}) r group by all"), doubles=["median_ratio"])
def q_e15(spark, sf):
    return PR.repayment_median(A(spark, sf))


CORR_COLS = S.FEATURES + ["DEFAULT"]


def corr_sql(cols: list[str], by: str = "") -> str:
    q = lambda c: T if c == "DEFAULT" else c
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    sel = (by + ", ") if by else ""
    grp = f" group by {by}" if by else ""
    return " union all ".join(f"select {sel}'{a}' as a, '{b}' as b, corr(cast({q(a)} as double), cast({q(b)} as double)) as r from acc{grp}" for a, b in pairs)


@case("e16_corr_matrix", W(corr_sql(CORR_COLS)), doubles=["r"])
def q_e16(spark, sf):
    return PR.corr_matrix(A(spark, sf), CORR_COLS)


@case("e17_corr_by_class", W(corr_sql(S.PAY_STATUS, f"cast({T} as int)").replace(f"select cast({T} as int), ", f"select cast({T} as int) as cls, ")), doubles=["r"])
def q_e17(spark, sf):
    return PR.corr_matrix(A(spark, sf).withColumn("cls", F.col("DEFAULT").cast("int")), S.PAY_STATUS, by=["cls"])


def lag_sql() -> str:
    cols = S.BILL_AMT
    parts = [f"select cast({T} as int) as cls, {lag} as lag, corr({cols[i]}, {cols[i + lag]}) as r from acc group by 1"
             for lag in range(1, 6) for i in range(len(cols) - lag)]
    return W(f"select cls, lag, avg(r) as mean_r, count(r) as n_pairs, 1.96 * stddev_pop(r) / sqrt(count(r)) as ci_half from ({' union all '.join(parts)}) p group by cls, lag")


@case("e18_lag_autocorr", lag_sql(), doubles=["mean_r", "ci_half"])
def q_e18(spark, sf):
    return PR.lag_autocorr(A(spark, sf))


def assoc_sql() -> str:
    numeric = NUM + S.PAY_STATUS
    pb = f"select feature, corr(value, cast({T} as double)) as r, count(value) as n_ from ({melt_sql(numeric)}) m group by feature"
    tt = "(r * sqrt((n_ - 2) / (1.0 - r * r)))"
    num = f"select feature, 'point_biserial' as measure, abs(r) as strength, case when r >= 0 then 1 else 0 - 1 end as sign, {Q.t_sf2(tt, 'n_ - 2')} as p_value from ({pb}) p"
    cat = f"select feature, 'cramers_v' as measure, cramers_v as strength, cast(null as int) as sign, p_value from ({chi2_sql(CAT)}) c"
    return W(f"select *, cast(row_number() over (order by round(strength, 9) desc, feature) as int) as rank from ({num} union all {cat}) a")


@case("e19_association_rank", assoc_sql(), doubles=["strength", "p_value"])
def q_e19(spark, sf):
    return PR.association_rank(A(spark, sf), NUM + S.PAY_STATUS, CAT)


def mi_sql() -> str:
    disc = f"select {T} as y, feature, value as level from ({melt_sql(CAT + S.PAY_STATUS)}) d"
    qs = "[" + ", ".join(Q.lit(i / 10) for i in range(1, 10)) + "]"
    cont = (f"select m.{T} as y, m.feature, cast(len(list_filter(e.edges, lambda v: v <= m.value)) as double) as level from ({melt_sql(CONT)}) m "
            f"join (select feature, quantile_cont(value, {qs}) as edges from ({melt_sql(CONT)}) q group by feature) e on e.feature = m.feature")
    c = ("select feature, level, y, count(*) * 1.0 as nxy from (" + disc + " union all " + cont + ") x group by all")
    w = ("select *, sum(nxy) over (partition by feature, level) as nx, sum(nxy) over (partition by feature, y) as ny, sum(nxy) over (partition by feature) as n from c")
    return W(f"select feature, sum(nxy / n * ln(nxy * n / (nx * ny))) as mutual_info from ({w}) w group by feature", ("c", c))


@case("e20_mutual_info", mi_sql(), doubles=["mutual_info"])
def q_e20(spark, sf):
    return PR.mutual_info(A(spark, sf), CAT + S.PAY_STATUS, CONT)


_KNN_LONG = f"select feature, cast({T} as int) as cls, value, count(*) as c from ({melt_sql(NUM)}) m where value is not null group by all"
_KNN_SIZES = "select feature, cls, sum(c) as of_class from vals group by all having sum(c) > 1"
# each value's rows of the same class in order of distance, until k of them besides itself
_KNN_NEAR = ("select feature, cls, value, c, of_class, k, min(dist) filter (where upto > k) as d from (select *, sum(c2) over (partition by feature, cls, value order by dist rows unbounded preceding) as upto from ("
             "select a.feature, a.cls, a.value, a.c, s.of_class, least(5, s.of_class - 1) as k, abs(b.value - a.value) as dist, b.c as c2 from vals a join sizes s using (feature, cls) join vals b on b.feature = a.feature and b.cls = a.cls)) group by all")
_KNN_COUNT = ("select n.feature, n.cls, n.value, n.c, n.of_class, n.k, sum(p.c) as m from near n join (select v.* from vals v join sizes using (feature, cls)) p on p.feature = n.feature "
              "and (case when n.d = 0 then p.value = n.value else p.value > n.value - n.d and p.value < n.value + n.d end) group by all")


@case("e20_knn_mutual_information", W(
    f"select feature, greatest(0.0, {Q.digamma('sum(c)')} + (sum(c * {Q.digamma('k')}) - sum(c * {Q.digamma('of_class')}) - sum(c * {Q.digamma('m')})) / sum(c)) as mi from counted group by feature",
    ("vals", _KNN_LONG), ("sizes", _KNN_SIZES), ("near", _KNN_NEAR), ("counted", _KNN_COUNT)), doubles=["mi"])
def q_e20_knn(spark, sf):
    """Mutual information of all numeric columns with the target by five nearest neighbours."""
    return mutual_information(A(spark, sf), NUM, k=5)


def dag_sql() -> str:
    g = ("select feature, count(value) * 1.0 as n, "
         "(sum(power(value - mu, 3)) / count(value)) / power(sum(power(value - mu, 2)) / count(value), 1.5) as b1, "
         "(sum(power(value - mu, 4)) / count(value)) / power(sum(power(value - mu, 2)) / count(value), 2) as b2 "
         f"from (select *, avg(value) over (partition by feature) as mu from ({melt_sql(NUM)}) m) x group by feature")
    y0 = "(b1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))))"
    beta2 = "(3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)))"
    w2 = f"(-1.0 + sqrt(2.0 * ({beta2} - 1)))"
    delta = f"(1.0 / sqrt(0.5 * ln({w2})))"
    al = f"sqrt(2.0 / ({w2} - 1))"
    y = f"(case when {y0} = 0 then 1.0 else {y0} end)"
    zs = f"({delta} * ln({y} / {al} + sqrt(({y} / {al}) * ({y} / {al}) + 1)))"
    e = "(3.0 * (n - 1) / (n + 1))"
    varb2 = "(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)))"
    x = f"((b2 - {e}) / sqrt({varb2}))"
    sb1 = "(6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))))"
    a = f"(6.0 + 8.0 / {sb1} * (2.0 / {sb1} + sqrt(1 + 4.0 / ({sb1} * {sb1}))))"
    t1 = f"(1.0 - 2.0 / (9.0 * {a}))"
    den = f"(1.0 + {x} * sqrt(2.0 / ({a} - 4.0)))"
    t2 = f"(sign({den}) * pow((1.0 - 2.0 / {a}) / abs({den}), 1.0 / 3.0))"
    zk = f"(({t1} - {t2}) / sqrt(2.0 / (9.0 * {a})))"
    k2 = f"({zs} * {zs} + {zk} * {zk})"
    return W(f"select feature, b1 as skew, b2 - 3.0 as kurtosis, {zs} as z_skew, {zk} as z_kurt, {k2} as k2, exp(-{k2} / 2.0) as p_value, "
             f"exp(-{k2} / 2.0) >= 0.05 as normal from ({g}) g")


@case("e22_dagostino", dag_sql(), doubles=["skew", "kurtosis", "z_skew", "z_kurt", "k2", "p_value"])
def q_e22(spark, sf):
    return PR.dagostino(A(spark, sf), NUM)


@case("e24_summary_stats", W(
    f"select feature, avg(value) as mean, stddev_samp(value) as std, avg(value) filter (where {T} = 0) as mean_0, avg(value) filter (where {T} = 1) as mean_1, "
    f"skewness(value) as skew, kurtosis(value) as kurtosis, quantile_cont(value, 0.5) as median from ({melt_sql(NUM)}) m group by feature"),
    doubles=["mean", "std", "mean_0", "mean_1", "skew", "kurtosis", "median"])
def q_e24(spark, sf):
    return PR.summary_stats(A(spark, sf), NUM)


AGE_EDGES = [20, 30, 40, 50, 60, 80]
LIM_EDGES = [0, 100000, 200000, 400000, 800000]


def _bin_sql(x: str, edges: list[float]) -> str:
    return "(" + " + ".join(f"(case when {x} > {e} then 1 else 0 end)" for e in edges[1:-1]) + ")"


@case("e25_rate_grid", W(
    f"select {_bin_sql('AGE', AGE_EDGES)} as AGE_bin, {_bin_sql('LIMIT_BAL', LIM_EDGES)} as LIMIT_BAL_bin, count(*) as n, avg(cast({T} as double)) as rate "
    f"from acc where AGE >= {AGE_EDGES[0]} and AGE <= {AGE_EDGES[-1]} and LIMIT_BAL >= {LIM_EDGES[0]} and LIMIT_BAL <= {LIM_EDGES[-1]} group by 1, 2"),
    doubles=["rate"])
def q_e25(spark, sf):
    return PR.rate_grid(A(spark, sf), "AGE", AGE_EDGES, "LIMIT_BAL", LIM_EDGES)


@case("e26_rate_by_age_education", W(
    f"select cast(floor(AGE / 5) * 5 as int) as bin, EDUCATION, count(*) as n, avg(cast({T} as double)) as rate, floor(AGE / 5) * 5 + 2.5 as midpoint from acc group by 1, 2, 5"),
    doubles=["rate", "midpoint"])
def q_e26(spark, sf):
    return PR.rate_by_bin(A(spark, sf), "AGE", 5, "EDUCATION")


@case("e27_box_stats", W(
    f"select b.feature, b.cls, q1, median, q3, min(value) filter (where value >= q1 - 1.5 * (q3 - q1)) as whisker_lo, "
    f"max(value) filter (where value <= q3 + 1.5 * (q3 - q1)) as whisker_hi, count(*) as n from (select feature, cast({T} as int) as cls, value from ({melt_sql(CONT)}) m) b "
    f"join (select feature, cast({T} as int) as cls, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3 "
    f"from ({melt_sql(CONT)}) m2 group by all) q on q.feature = b.feature and q.cls = b.cls group by all"),
    doubles=["q1", "median", "q3", "whisker_lo", "whisker_hi"])
def q_e27(spark, sf):
    return PR.box_stats(A(spark, sf), CONT)


_CAPS = ", ".join(f"quantile_cont(cast({c} as double), 0.02) as lo_{c}, quantile_cont(cast({c} as double), 0.98) as hi_{c}" for c in S.BILL_AMT)
_CAPPED = ", ".join(f"least(greatest(cast({c} as double), lo_{c}), hi_{c}) as {c}" for c in S.BILL_AMT)


@case("e27_clipped_boxes", Q.with_fixtures(
    f"select q.*, w.u, w.p_value from (select b.feature, b.cls, q1, median, q3, min(value) filter (where value >= q1 - 1.5 * (q3 - q1)) as whisker_lo, "
    f"max(value) filter (where value <= q3 + 1.5 * (q3 - q1)) as whisker_hi, count(*) as n from (select feature, cast({T} as int) as cls, value from ({melt_sql(S.BILL_AMT)}) m) b "
    f"join (select feature, cast({T} as int) as cls, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q3 "
    f"from ({melt_sql(S.BILL_AMT)}) m2 group by all) q on q.feature = b.feature and q.cls = b.cls group by all) q join ({mwu_sql(S.BILL_AMT)}) w on w.feature = q.feature",
    "accounts", extra=[("acc0", CLEAN), ("acc", f"select * replace ({_CAPPED}) from (select * from acc0, (select {_CAPS} from acc0) caps)")]),
    doubles=["q1", "median", "q3", "whisker_lo", "whisker_hi", "u", "p_value"])
def q_e27_clipped(spark, sf):
    """Bills clipped to P2-P98, boxes per class and the test of each month."""
    return PR.clipped_boxes(A(spark, sf), S.BILL_AMT)


TRANS = ("select cls, from_state, to_state, n, cast(sum(n) over (partition by cls, from_state) as bigint) as n_from, n / sum(n) over (partition by cls, from_state) as prob from ("
         f"select cast({T} as int) as cls, cast(least(greatest(PAY_2, -2), 4) as int) as from_state, cast(least(greatest(PAY_0, -2), 4) as int) as to_state, count(*) as n from acc group by all) g")


@case("e28_transitions", W(TRANS), doubles=["prob"])
def q_e28(spark, sf):
    return PR.transitions(A(spark, sf))


@case("e29_transition_gaps", W(
    "select a.from_state, a.to_state, a.prob as p0, a.n_from as n0, b.prob as p1, b.n_from as n1, b.prob - a.prob as gap from "
    "(select * from t where cls = 0) a join (select * from t where cls = 1) b using (from_state, to_state) "
    "where a.n_from > 50 and b.n_from > 50 and abs(b.prob - a.prob) > 0.05", ("t", TRANS)), doubles=["p0", "p1", "gap"])
def q_e29(spark, sf):
    return PR.transition_gaps(A(spark, sf))


@case("e30_ecdf", W(
    "select cls, value, sum(n) over (partition by cls order by value rows between unbounded preceding and current row) / sum(n) over (partition by cls) as ecdf from "
    f"(select cast({T} as int) as cls, cast(LIMIT_BAL as double) as value, count(*) * 1.0 as n from acc group by all) c"), doubles=["value", "ecdf"])
def q_e30(spark, sf):
    return PR.ecdf(A(spark, sf), "LIMIT_BAL")


HIST_EDGES = [float(x) for x in range(20, 81, 5)]


@case("e31_histogram", W(
    f"select cast({T} as int) as cls, (" + " + ".join(f"(case when cast(AGE as double) >= {e} then 1 else 0 end)" for e in HIST_EDGES[1:-1])
    + f") as bin, count(*) as n from acc where AGE >= {HIST_EDGES[0]} and AGE <= {HIST_EDGES[-1]} group by 1, 2"))
def q_e31(spark, sf):
    return PR.histogram(A(spark, sf), "AGE", HIST_EDGES)


KDE_GRID = [20.0 + 2.5 * k for k in range(25)]


@case("e31_kde", W(
    "select c.cls, g.g, sum(c.c * exp(-0.5 * ((g.g - c.v) / s.bw) * ((g.g - c.v) / s.bw))) / (max(s.n) * max(s.bw) * 2.5066282746310002) as density from "
    f"(select cast({T} as int) as cls, cast(AGE as double) as v, count(*) * 1.0 as c from acc group by all) c "
    f"join (select cast({T} as int) as cls, stddev_samp(cast(AGE as double)) * pow(count(*) * 1.0, -0.2) as bw, count(*) * 1.0 as n from acc group by 1) s on s.cls = c.cls "
    "join (select unnest([" + ", ".join(Q.lit(g) for g in KDE_GRID) + "]) as g) g on true group by c.cls, g.g"), doubles=["g", "density"])
def q_e31k(spark, sf):
    return PR.kde(A(spark, sf), "AGE", KDE_GRID)


@case("e32_class_profile", W(
    "select feature, case when mx - mn <> 0 then (m0 - mn) / (mx - mn) end as profile_0, case when mx - mn <> 0 then (m1 - mn) / (mx - mn) end as profile_1 from ("
    f"select feature, min(value) as mn, max(value) as mx, avg(value) filter (where {T} = 0) as m0, avg(value) filter (where {T} = 1) as m1 from ({melt_sql(NUM)}) m group by feature) g"),
    doubles=["profile_0", "profile_1"])
def q_e32(spark, sf):
    return PR.class_profile(A(spark, sf), NUM)


@case("e33_state_composition", WP(
    "select cls, month, state, n, n / sum(n) over (partition by cls, month) as share from (select cls, month, case when pay <= -2 then 'no_use' when pay = -1 then 'paid_full' "
    "when pay = 0 then 'revolving' when pay = 1 then 'delay_1' when pay = 2 then 'delay_2' else 'delay_3plus' end as state, count(*) as n from panel group by all) g"),
    doubles=["share"])
def q_e33(spark, sf):
    return PR.state_composition(A(spark, sf))


@case("e34_capped_summary", WP(
    "select cls, month, avg(capped) as mean_capped, quantile_cont(capped, 0.5) as median_capped from (select p.cls, p.month, least(p.bill, c.cap) as capped from panel p "
    f"join (select month, quantile_cont(bill, {Q.lit(0.99)}) as cap from panel group by month) c using (month)) x group by cls, month"),
    doubles=["mean_capped", "median_capped"])
def q_e34(spark, sf):
    return PR.capped_summary(A(spark, sf))


@case("e35_plot_sample", W(
    "select row_id, LIMIT_BAL, AGE, BILL_AMT1, \"DEFAULT\" from acc order by cast(('0x'||substr(md5(concat(cast(row_id as varchar), '|7|n')),1,15)) as bigint), row_id limit 200"),
    doubles=["LIMIT_BAL", "BILL_AMT1"])
def q_e35(spark, sf):
    from ..operators.split import sample_n

    return sample_n(A(spark, sf).select("row_id", "LIMIT_BAL", "AGE", "BILL_AMT1", "DEFAULT"), 200, seed=7)


@case("e21_vif", None)
def q_e21(spark, sf):
    """VIF of the numeric columns (driver inverts only the p x p matrix)."""
    return PR.vif(A(spark, sf), NUM)


@case("e21_vif_two_columns", W(
    "select unnest(['AGE', 'LIMIT_BAL']) as feature, 1.0 / (1.0 - pow(corr(AGE, LIMIT_BAL), 2)) as vif from acc"), doubles=["vif"])
def q_e21_two(spark, sf):
    return PR.vif(A(spark, sf), ["AGE", "LIMIT_BAL"])


QQ_GRID = [0.01 + 0.98 * k / 49 for k in range(50)]


def _qq_sql() -> str:
    from ..functions.dist import norm_ppf_lit

    qs = "[" + ", ".join(Q.lit(p) for p in QQ_GRID) + "]"
    nq = "[" + ", ".join(Q.lit(norm_ppf_lit(p)) for p in QQ_GRID) + "]"
    return W(f"select feature, unnest({qs}) as q, unnest(vals) as value, unnest({nq}) as normal_quantile from ("
             f"select feature, quantile_cont(value, {qs}) as vals from (" + melt_sql(["AGE", "LIMIT_BAL"]) + ") m group by feature) z")


@case("e23_qq_points", _qq_sql(), doubles=["q", "value", "normal_quantile"])
def q_e23(spark, sf):
    return PR.qq_points(A(spark, sf), ["AGE", "LIMIT_BAL"], QQ_GRID)
