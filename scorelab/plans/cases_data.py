"""Registered queries: fixtures, cleaning, validation, feature engineering."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import uniform
from ..operators import clean, features
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

ENG_DOUBLES = [f"UTIL_RATIO_{i}" for i in range(1, 7)] + [f"REPAY_RATIO_{i}" for i in range(1, 7)] + [
    "DELAY_TREND", "BILL_SLOPE", "AVG_UTIL_RATIO", "AVG_PAY_AMT", "PAY_AMT_VOLATILITY",
    "TOTAL_BILL", "TOTAL_PAY", "PAY_BILL_RATIO_TOTAL",
]


def eng_sql_cols(ddof: int = 0) -> list[str]:
    """DuckDB text of the 24 engineered columns."""
    c = []
    for i in range(1, 7):
        c.append(f"coalesce(BILL_AMT{i} / nullif(LIMIT_BAL, 0), 0.0) as UTIL_RATIO_{i}")
    for i in range(1, 7):
        c.append(f"greatest(-5.0, least(5.0, coalesce(PAY_AMT{i} / abs(nullif(BILL_AMT{i}, 0)), 0.0))) as REPAY_RATIO_{i}")
    pays = S.PAY_STATUS
    c.append("cast(" + " + ".join(f"(case when {p} > 0 then 1 else 0 end)" for p in pays) + " as int) as N_MONTHS_DELAYED")
    c.append(f"cast(greatest({', '.join(pays)}) as int) as MAX_DELAY")
    c.append("cast(PAY_0 as int) as RECENT_DELAY")
    c.append("PAY_0 - (" + " + ".join(f"cast({p} as double)" for p in pays[1:]) + ") / 5.0 as DELAY_TREND")
    c.append("cast(" + " + ".join(f"(case when {p} = -2 then 1 else 0 end)" for p in pays) + " as int) as N_MONTHS_NO_USE")
    bm = "((" + " + ".join(S.BILL_AMT) + ") / 6.0)"
    c.append("(0.0 + " + " + ".join(f"({i - 2.5}) * ({b} - {bm})" for i, b in enumerate(S.BILL_AMT)) + ") / 17.5 as BILL_SLOPE")
    c.append("(" + " + ".join(f"coalesce(BILL_AMT{i} / nullif(LIMIT_BAL, 0), 0.0)" for i in range(1, 7)) + ") / 6.0 as AVG_UTIL_RATIO")
    pm = "((" + " + ".join(S.PAY_AMT) + ") / 6.0)"
    c.append(f"{pm} as AVG_PAY_AMT")
    c.append("sqrt((0.0 + " + " + ".join(f"({p} - {pm}) * ({p} - {pm})" for p in S.PAY_AMT) + f") / {float(6 - ddof)}) as PAY_AMT_VOLATILITY")
    tb = "(" + " + ".join(S.BILL_AMT) + ")"
    tp = "(" + " + ".join(S.PAY_AMT) + ")"
    c.append(f"{tb} as TOTAL_BILL")
    c.append(f"{tp} as TOTAL_PAY")
    c.append(f"greatest(-5.0, least(5.0, coalesce({tp} / abs(nullif({tb}, 0)), 0.0))) as PAY_BILL_RATIO_TOTAL")
    return c


ENGINEERED_SQL = "select *, " + ", ".join(eng_sql_cols()) + " from accounts"


def accounts_dups(spark, sf):
    """Accounts plus a hash-chosen ~0.7 % of rows copied under a new row_id
    (the driver tables contain no exact duplicates)."""
    a = fx.accounts(spark, sf)
    extra = a.where(uniform(F.col("row_id").cast("string"), "|dup") < 0.007).withColumn(
        "row_id", F.col("row_id") + F.lit(1000000000000)
    )
    return a.unionByName(extra)


ACCOUNTS_DUPS_SQL = (
    "select * from accounts union all select * replace (row_id + 1000000000000 as row_id) from accounts where "
    + Q.U("concat(cast(row_id as varchar),'|dup')") + " < 0.007"
)

ACC_COLS = ", ".join(["row_id"] + [c if c != "DEFAULT" else '"DEFAULT"' for c in S.ALL_COLUMNS])


@case("fixture_accounts", Q.with_fixtures(f"select {ACC_COLS} from accounts", "accounts"), doubles=S.BILL_AMT + S.PAY_AMT + ["LIMIT_BAL"])
def q_fixture_accounts(spark, sf):
    return fx.accounts(spark, sf)


@case(
    "fixture_scores_summary",
    Q.with_fixtures(
        "select run, split, count(*) as n, sum(y_true) as n_pos, sum(y_prob) as sum_prob, sum(y_pred) as n_pred, sum(rare) as n_rare, "
        "count(distinct o_orderpriority) as n_priority from scores_attr group by run, split",
        "scores_attr",
    ).replace("sum(y_true) as n_pos", "cast(sum(y_true) as bigint) as n_pos").replace(
        "sum(y_pred) as n_pred", "cast(sum(y_pred) as bigint) as n_pred").replace("sum(rare) as n_rare", "cast(sum(rare) as bigint) as n_rare"),
    doubles=["sum_prob"],
)
def q_fixture_scores(spark, sf):
    s = fx.scores(spark, sf)
    return s.groupBy("run", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_true").cast("long").alias("n_pos"), F.sum("y_prob").alias("sum_prob"),
        F.sum("y_pred").cast("long").alias("n_pred"), F.sum("rare").cast("long").alias("n_rare"),
        F.count_distinct("o_orderpriority").alias("n_priority"),
    )


@case(
    "fixture_mc_summary",
    Q.with_fixtures("select t, count(*) as n, sum(p) as sum_p, min(p) as min_p, max(p) as max_p from mc group by t", "mc"),
    doubles=["sum_p", "min_p", "max_p"],
)
def q_fixture_mc(spark, sf):
    return fx.mc_samples(spark, sf).groupBy("t").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("sum_p"), F.min("p").alias("min_p"), F.max("p").alias("max_p")
    )


@case(
    "fixture_attention_summary",
    Q.with_fixtures(
        "select layer, head, count(*) as n, sum(w*w) as sum_w2, max(w) as max_w, sum(w) as sum_w from attention group by layer, head",
        "attention",
    ),
    doubles=["sum_w2", "max_w", "sum_w"],
)
def q_fixture_attention(spark, sf):
    return fx.attention(spark, sf).groupBy("layer", "head").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("w") * F.col("w")).alias("sum_w2"), F.max("w").alias("max_w"), F.sum("w").alias("sum_w")
    )


@case(
    "a3_rename_anonymous",
    Q.with_fixtures(
        "select " + ", ".join(f'{c} as X{i}' if c != "DEFAULT" else f'"DEFAULT" as Y' for i, c in enumerate(S.ALL_COLUMNS, start=1)).replace("X24", "Y") + ", row_id from accounts",
        "accounts",
    ),
    doubles=[f"X{i}" for i, c in enumerate(S.ALL_COLUMNS, start=1) if c in S.BILL_AMT + S.PAY_AMT + ["LIMIT_BAL"]],
)
def q_a3(spark, sf):
    from ..sources import io

    a = fx.accounts(spark, sf)
    anon = a.select("row_id", *[F.col(c).alias(f"X{i}") for i, c in enumerate(S.FEATURES, start=1)], F.col("DEFAULT").alias("Y"))
    # renaming back and forth: the anonymous table keeps its X names when the map does not apply
    return io.rename_anonymous(io.rename_anonymous(anon, {v: k for k, v in io.ANONYMOUS_MAP.items()}), {})


@case(
    "b1_clean_report",
    Q.with_fixtures(
        "select feature, value, cast(sum(b) as bigint) as n_before, cast(sum(a) as bigint) as n_after from ("
        "select 'EDUCATION' as feature, EDUCATION as value, 1 as b, 0 as a from accounts union all "
        "select 'EDUCATION', case when EDUCATION in (0,5,6) then 4 else EDUCATION end, 0, 1 from accounts union all "
        "select 'MARRIAGE', MARRIAGE, 1, 0 from accounts union all "
        "select 'MARRIAGE', case when MARRIAGE = 0 then 3 else MARRIAGE end, 0, 1 from accounts) t group by feature, value",
        "accounts",
    ),
)
def q_b1(spark, sf):
    return clean.clean_report(fx.accounts(spark, sf))


@case(
    "b2_drop_duplicates",
    Q.with_fixtures(
        "select count(*) as n_kept, cast(sum(row_id % 1000003) as bigint) as id_check from (select min(row_id) as row_id from d group by "
        + ", ".join(c if c != "DEFAULT" else '"DEFAULT"' for c in S.ALL_COLUMNS) + ") q",
        "accounts", extra=[("d", ACCOUNTS_DUPS_SQL)],
    ),
)
def q_b2(spark, sf):
    d = clean.drop_exact_duplicates(accounts_dups(spark, sf))
    return d.agg(F.count(F.lit(1)).alias("n_kept"), F.sum(F.col("row_id") % 1000003).cast("long").alias("id_check"))


@case(
    "b3_validate",
    None,
)
def q_b3(spark, sf):
    return clean.validate(clean.clean_categoricals(fx.accounts(spark, sf)))


def _b3_sql() -> str:
    cols = S.ALL_COLUMNS
    q = lambda c: '"DEFAULT"' if c == "DEFAULT" else c
    parts = ["select 'n_rows' as \"check\", cast(null as varchar) as \"column\", count(*) as n, false as is_issue from c"]
    for col in cols:
        parts.append(f"select 'missing', '{col}', count(*) filter (where {q(col)} is null), count(*) filter (where {q(col)} is null) > 0 from c")
    dom = [("SEX", "1,2"), ("EDUCATION", "1,2,3,4"), ("MARRIAGE", "1,2,3")] + [(p, ",".join(str(v) for v in S.VALID_PAY)) for p in S.PAY_STATUS]
    for col, vals in dom:
        parts.append(f"select 'invalid_domain', '{col}', count(*) filter (where {col} not in ({vals})), count(*) filter (where {col} not in ({vals})) > 0 from c")
    parts.append("select 'non_positive', 'LIMIT_BAL', count(*) filter (where LIMIT_BAL <= 0), count(*) filter (where LIMIT_BAL <= 0) > 0 from c")
    parts.append("select 'out_of_range', 'AGE', count(*) filter (where AGE < 18 or AGE > 100), count(*) filter (where AGE < 18 or AGE > 100) > 0 from c")
    parts.append("select 'non_binary', 'DEFAULT', count(*) filter (where \"DEFAULT\" not in (0,1)), count(*) filter (where \"DEFAULT\" not in (0,1)) > 0 from c")
    parts.append("select 'target_0', 'DEFAULT', count(*) filter (where \"DEFAULT\" = 0), false from c")
    parts.append("select 'target_1', 'DEFAULT', count(*) filter (where \"DEFAULT\" = 1), false from c")
    for b in S.BILL_AMT:
        parts.append(f"select 'negative_count', '{b}', count(*) filter (where {b} < 0), false from c")
    gcols = ", ".join(q(c) for c in cols)
    parts.append(f"select 'duplicated_rows', null, cast(sum(k - 1) as bigint), sum(k - 1) > 0 from (select count(*) as k from c group by {gcols}) g")
    clean_sql = ("select * replace (cast(case when EDUCATION in (0,5,6) then 4 else EDUCATION end as int) as EDUCATION, "
                 "cast(case when MARRIAGE = 0 then 3 else MARRIAGE end as int) as MARRIAGE) from accounts")
    return Q.with_fixtures(" union all ".join(parts), "accounts", extra=[("c", clean_sql)])


from .registry import CASES  # noqa: E402

CASES["b3_validate"].sql = _b3_sql()


@case("b4_validate_schema", None)
def q_b4(spark, sf):
    return clean.validate_schema(fx.accounts(spark, sf))


def _b4_sql() -> str:
    parts = []
    for col in S.FEATURES:
        parts.append(f"select 'null_values' as \"check\", '{col}' as \"column\", count(*) filter (where {col} is null) as n from accounts")
    for col in S.PAY_STATUS:
        parts.append(f"select 'invalid_pay', '{col}', count(*) filter (where {col} not between -2 and 8) from accounts")
    for col in S.CATEGORICAL:
        parts.append(f"select 'non_integer', '{col}', count(*) filter (where cast({col} as double) != floor(cast({col} as double))) from accounts")
    return Q.with_fixtures(" union all ".join(parts), "accounts")


CASES["b4_validate_schema"].sql = _b4_sql()


@case(
    "b5_duplicate_profile",
    Q.with_fixtures(
        "select cast(sum(k) as bigint) as n_rows, cast(coalesce(sum(k) filter (where k > 1), 0) as bigint) as n_in_dup_groups, "
        "cast(coalesce(sum(k - 1) filter (where k > 1), 0) as bigint) as n_extra_copies, "
        "sum(k * y) filter (where k > 1) / sum(k) filter (where k > 1) as target_rate_dup, sum(k * y) / sum(k) as target_rate_all "
        "from (select count(*) as k, max(\"DEFAULT\") as y from d group by "
        + ", ".join(c if c != "DEFAULT" else '"DEFAULT"' for c in S.ALL_COLUMNS) + ") g",
        "accounts", extra=[("d", ACCOUNTS_DUPS_SQL)],
    ),
    doubles=["target_rate_dup", "target_rate_all"],
)
def q_b5(spark, sf):
    return clean.duplicate_summary(accounts_dups(spark, sf))


B5_COLS = ["LIMIT_BAL", "AGE", "PAY_0", "BILL_AMT1", "PAY_AMT1"]
_B5_GROUPS = "select *, count(*) over (partition by " + ", ".join(c if c != "DEFAULT" else '"DEFAULT"' for c in S.ALL_COLUMNS) + ") as k from d"


@case(
    "b5_duplicate_feature_ratio",
    Q.with_fixtures(
        "select *, case when mean_all <> 0 then mean_dup / mean_all end as ratio from ("
        + " union all ".join(f"select '{c}' as feature, avg(cast({c} as double)) filter (where k > 1) as mean_dup, avg(cast({c} as double)) as mean_all from g" for c in B5_COLS) + ") m",
        "accounts", extra=[("d", ACCOUNTS_DUPS_SQL), ("g", _B5_GROUPS)],
    ),
    doubles=["mean_dup", "mean_all", "ratio"],
)
def q_b5_ratio(spark, sf):
    """Feature means of rows in duplicate groups over those of all rows."""
    return clean.duplicate_feature_ratio(accounts_dups(spark, sf), B5_COLS)


@case(
    "b6_zero_inflation",
    Q.with_fixtures(
        " union all ".join(
            f"select {i} as month, '{S.PAY_AMT[i-1]}' as feature, "
            f"100.0 * count(*) filter (where PAY_AMT{i} = 0) / count(*) as pct_zero, "
            f"100.0 * count(*) filter (where PAY_AMT{i} = 0 and BILL_AMT{i} > 0) / count(*) as pct_avoidance, "
            f"avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} = 0) as dr_zero, "
            f"avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} > 0) as dr_nonzero, "
            f"coalesce(avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} = 0 and BILL_AMT{i} > 0), 0.0) as dr_avoidance, "
            f"case when avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} > 0) > 0 then "
            f"avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} = 0) / avg(cast(\"DEFAULT\" as double)) filter (where PAY_AMT{i} > 0) else 0.0 end as risk_ratio "
            "from accounts"
            for i in range(1, 7)
        ),
        "accounts",
    ),
    doubles=["pct_zero", "pct_avoidance", "dr_zero", "dr_nonzero", "dr_avoidance", "risk_ratio"],
)
def q_b6(spark, sf):
    from ..operators.profile import zero_inflation

    return zero_inflation(fx.accounts(spark, sf))


def _quant_sql(cols: list[str], qs: list[float], src: str = "accounts") -> str:
    return " union all ".join(
        f"select '{c}' as feature, " + ", ".join(f"quantile_cont({c}, {q}) as q{j}" for j, q in enumerate(qs)) + f" from {src}" for c in cols
    )


IQR_COLS = S.NUMERICAL


@case(
    "b7_iqr_outliers",
    Q.with_fixtures(
        "select b.feature, q1, q3, iqr, lo, hi, cast(count(*) filter (where v < lo or v > hi) as bigint) as n_outliers, "
        "cast(count(*) as bigint) as n, 100.0 * count(*) filter (where v < lo or v > hi) / count(*) as pct_outliers from "
        "(select feature, q0 as q1, q1 as q3, q1 - q0 as iqr, q0 - 1.5 * (q1 - q0) as lo, q1 + 1.5 * (q1 - q0) as hi from ("
        + _quant_sql(IQR_COLS, [0.25, 0.75]) + ") z) b join (" + " union all ".join(
            f"select '{c}' as feature, cast({c} as double) as v from accounts" for c in IQR_COLS) + ") l on l.feature = b.feature "
        "group by b.feature, q1, q3, iqr, lo, hi",
        "accounts",
    ),
    doubles=["q1", "q3", "iqr", "lo", "hi", "pct_outliers"],
)
def q_b7(spark, sf):
    return clean.iqr_outliers(fx.accounts(spark, sf), IQR_COLS)


WINSOR_COLS = S.BILL_AMT + S.PAY_AMT


@case(
    "b8_winsor_report",
    None,
    doubles=["lo", "hi"],
)
def q_b8(spark, sf):
    from ..operators.split import stratified_split

    a = stratified_split(fx.accounts(spark, sf))
    bounds = clean.fit_winsor(a.where(F.col("split") == "train"), WINSOR_COLS)
    rep = clean.winsor_report(a, bounds, WINSOR_COLS)
    clipped = clean.apply_winsor(a, bounds, WINSOR_COLS)
    mx = clipped.agg(*[F.max(c).alias(c) for c in WINSOR_COLS])
    del mx
    return rep.join(bounds, "feature")


@case(
    "b9_log_effect",
    Q.with_fixtures(
        " union all ".join(
            f"select '{c}' as feature, skewness({c}) as skew_before, skewness(sign({c}) * ln(1 + abs({c}))) as skew_after from accounts"
            for c in S.BILL_AMT + S.PAY_AMT + ["LIMIT_BAL"]
        ),
        "accounts",
    ),
    doubles=["skew_before", "skew_after"],
)
def q_b9(spark, sf):
    return clean.log_effect(fx.accounts(spark, sf), S.BILL_AMT + S.PAY_AMT + ["LIMIT_BAL"])


RANGE_COLS = ["SEX", "EDUCATION", "MARRIAGE", "AGE"] + S.PAY_STATUS


@case(
    "b10_range_audit",
    Q.with_fixtures(
        " union all ".join(
            f"select '{c}' as feature, cast(count(distinct {c}) as bigint) as n_distinct, cast(min({c}) as double) as min, "
            f"cast(max({c}) as double) as max, avg(cast(\"DEFAULT\" as double)) as target_rate, array_to_string(list_sort(list(distinct cast({c} as bigint))), ',') as codes from accounts"
            for c in RANGE_COLS
        ),
        "accounts",
    ),
    doubles=["min", "max", "target_rate"],
)
def q_b10(spark, sf):
    return clean.range_audit(fx.accounts(spark, sf), RANGE_COLS)


@case(
    "c17_engineer_features",
    Q.with_fixtures("select row_id, " + ", ".join(eng_sql_cols()) + " from accounts", "accounts"),
    doubles=ENG_DOUBLES,
)
def q_c17(spark, sf):
    a = fx.accounts(spark, sf)
    return features.engineer_features(a).select("row_id", *features.ENGINEERED)


@case(
    "c13_c16_engineer_advanced",
    Q.with_fixtures(
        "select row_id, "
        + ", ".join(f"cast(case when PAY_AMT{i} = 0 and BILL_AMT{i} > 0 then 1 else 0 end as int) as PAY_AVOIDANCE_{i}" for i in range(1, 7))
        + ", cast(" + " + ".join(f"(case when PAY_AMT{i} = 0 and BILL_AMT{i} > 0 then 1 else 0 end)" for i in range(1, 7)) + " as int) as N_MONTHS_AVOIDANCE, "
        + ", ".join(f"cast(case when BILL_AMT{i} < 0 then 1 else 0 end as int) as CREDIT_BALANCE_{i}" for i in range(1, 7))
        + ", cast(greatest(" + ", ".join(f"(case when BILL_AMT{i} < 0 then 1 else 0 end)" for i in range(1, 7)) + ") as int) as HAS_ANY_CREDIT_BALANCE, "
        "cast(mx as int) as MAX_CONSECUTIVE_DELAYS, "
        "cast(case when LIMIT_BAL < e0 or LIMIT_BAL > e4 then null else (case when LIMIT_BAL > e1 then 1 else 0 end) + (case when LIMIT_BAL > e2 then 1 else 0 end) + (case when LIMIT_BAL > e3 then 1 else 0 end) end as int) as LIMIT_QUARTILE "
        "from accounts join runs using (row_id), (select quantile_cont(LIMIT_BAL, 0.0) as e0, quantile_cont(LIMIT_BAL, 0.25) as e1, quantile_cont(LIMIT_BAL, 0.5) as e2, "
        "quantile_cont(LIMIT_BAL, 0.75) as e3, quantile_cont(LIMIT_BAL, 1.0) as e4 from accounts) e",
        "accounts",
        extra=[("runs", "select row_id, max(len) as mx from (select row_id, grp, count(*) filter (where d) as len from ("
                "select row_id, pos, d, sum(case when d then 0 else 1 end) over (partition by row_id order by pos) as grp from ("
                + " union all ".join(f"select row_id, {k} as pos, {p} > 0 as d from accounts" for k, p in enumerate(S.PAY_STATUS))
                + ") m) g group by row_id, grp) r group by row_id")],
    ),
)
def q_c13(spark, sf):
    a = fx.accounts(spark, sf)
    new = [f"PAY_AVOIDANCE_{i}" for i in range(1, 7)] + ["N_MONTHS_AVOIDANCE"] + [f"CREDIT_BALANCE_{i}" for i in range(1, 7)] + [
        "HAS_ANY_CREDIT_BALANCE", "MAX_CONSECUTIVE_DELAYS", "LIMIT_QUARTILE"]
    return features.engineer_advanced(a).select("row_id", *new)


@case(
    "c18_class_weights",
    Q.with_fixtures(
        "select cls, n, sum(n) over () / (2.0 * n) as weight, cast(max(n) over () as double) / min(n) over () as imbalance from "
        "(select cast(\"DEFAULT\" as int) as cls, count(*) as n from accounts group by 1) g",
        "accounts",
    ),
    doubles=["weight", "imbalance"],
)
def q_c18(spark, sf):
    return features.class_weights(fx.accounts(spark, sf))


@case(
    "c19_pos_weight",
    Q.with_fixtures(
        "select n_pos, n_neg, case when n_pos > 0 then n_neg / n_pos end as pos_weight, n_neg / (n_pos + n_neg) as alpha_neg, "
        "n_pos / (n_pos + n_neg) as alpha_pos from (select cast(sum(\"DEFAULT\") as bigint) as n_pos, cast(sum(1 - \"DEFAULT\") as bigint) as n_neg from accounts) a",
        "accounts",
    ),
    doubles=["pos_weight", "alpha_neg", "alpha_pos"],
)
def q_c19(spark, sf):
    return features.pos_weight(fx.accounts(spark, sf))


C20_COLS = features.ENGINEERED


@case(
    "c20_engineered_corr",
    Q.with_fixtures(
        "select feature, r, cast(row_number() over (order by abs(round(r, 9)) desc, feature) as int) as rank from ("
        + " union all ".join(f"select '{c}' as feature, corr(cast({c} as double), cast(\"DEFAULT\" as double)) as r from e" for c in C20_COLS)
        + ") q",
        "accounts",
        extra=[("e", ENGINEERED_SQL)],
    ),
    doubles=["r"],
)
def q_c20(spark, sf):
    return features.engineered_corr(features.engineer_features(fx.accounts(spark, sf)), C20_COLS)


_C20_RANKED = ("select feature, cast(row_number() over (order by abs(round(r, 9)) desc, feature) as int) as rank from ("
               + " union all ".join(f"select '{c}' as feature, corr(cast({c} as double), cast(\"DEFAULT\" as double)) as r from e" for c in C20_COLS) + ") q")
_C20_LONG = " union all ".join(f"select '{c}' as feature, cast(\"DEFAULT\" as int) as cls, cast({c} as double) as value from e" for c in C20_COLS)


@case(
    "c20_clipped_summary",
    Q.with_fixtures(
        "select feature, rank, cls, p_lo, p_hi, count(value) as n, avg(value) as mean, stddev_samp(value) as std, quantile_cont(value, 0.5) as median from ("
        "select l.feature, rank, l.cls, p_lo, p_hi, least(greatest(value, p_lo), p_hi) as value from l join rk on rk.feature = l.feature and rk.rank <= 6 join "
        "(select feature, cls, quantile_cont(value, 0.01) as p_lo, quantile_cont(value, 0.99) as p_hi from l group by all) q on q.feature = l.feature and q.cls = l.cls where value is not null) c group by all",
        "accounts", extra=[("e", ENGINEERED_SQL), ("l", _C20_LONG), ("rk", _C20_RANKED)],
    ),
    doubles=["p_lo", "p_hi", "mean", "std", "median"],
)
def q_c20_summary(spark, sf):
    """Values of the six columns that go most with the target, clipped to P1-P99 of each class."""
    return features.clipped_summary(features.engineer_features(fx.accounts(spark, sf)), C20_COLS)


@case(
    "e10_rate_by_pay0",
    Q.with_fixtures(
        "select PAY_0, n, rate, (rate + 3.8416/(2*n)) / (1 + 3.8416/n) - 1.96 * sqrt((rate*(1-rate) + 3.8416/(4*n))/n) / (1 + 3.8416/n) as ci_lo, "
        "(rate + 3.8416/(2*n)) / (1 + 3.8416/n) + 1.96 * sqrt((rate*(1-rate) + 3.8416/(4*n))/n) / (1 + 3.8416/n) as ci_hi "
        "from (select PAY_0, count(*) as n, avg(cast(\"DEFAULT\" as double)) as rate from accounts group by PAY_0) g",
        "accounts",
    ),
    doubles=["rate", "ci_lo", "ci_hi"],
)
def q_e10(spark, sf):
    from ..operators.profile import rate_by_value

    return rate_by_value(fx.accounts(spark, sf), "PAY_0")
