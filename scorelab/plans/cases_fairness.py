"""Registered queries: subgroup fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fairness as FA
from ..operators.clean import clean_categoricals
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

ATTRS = ["SEX", "EDUCATION", "MARRIAGE", "o_orderpriority", "l_linestatus"]
SUB_COLS = ["base_rate", "selection_rate", "tpr", "fpr", "brier", "auc_roc", "ece"]
DISP_COLS = ["selection_rate_diff", "selection_rate_ratio", "tpr_diff", "fpr_diff", "equal_opportunity_violation",
             "equalised_odds_violation", "auc_diff", "ece_diff"]


def scored_accounts(spark, sf, split: str | None = "test"):
    """Score rows of the test split joined to the cleaned account attributes of the ordering customer."""
    s = fx.scores(spark, sf, attributes=True)
    if split:
        s = s.where(F.col("split") == split)
    acc = clean_categoricals(fx.accounts(spark, sf))
    return FA.attach_attributes(s.select("run", "split", "row_id", "y_true", "y_prob", "o_custkey", "o_orderpriority", "l_linestatus"), acc,
                                ["SEX", "EDUCATION", "MARRIAGE"]).drop("o_custkey")


CLEAN = ("select * replace (cast(case when EDUCATION in (0,5,6) then 4 else EDUCATION end as int) as EDUCATION, "
         "cast(case when MARRIAGE = 0 then 3 else MARRIAGE end as int) as MARRIAGE) from accounts")
SA = ("select s.run, s.split, s.row_id, s.y_true, s.y_prob, s.o_orderpriority, s.l_linestatus, a.SEX, a.EDUCATION, a.MARRIAGE "
      "from scores_attr s join acc a on s.o_custkey = a.row_id where s.split = 'test'")
LONG = " union all ".join(
    f"select run, split, row_id, y_true, y_prob, '{a}' as attribute, cast({a} as varchar) as code from sa" for a in ATTRS
)
LABELS = "select * from (values " + ", ".join(
    f"('{a}', '{k}', '{v}')" for a, m in FA.ATTRIBUTE_LABELS.items() for k, v in m.items()) + ") t(attribute, code, label)"
BY3 = ["run", "attribute", "code"]


def sub_sql() -> str:
    pred = "(case when y_prob >= cast('0.5' as double) then 1.0 else 0.0 end)"
    base = (
        "select run, attribute, code, count(*) as n, avg(cast(y_true as double)) as base_rate, "
        f"avg({pred}) as selection_rate, avg(case when y_true = 1 then {pred} end) as tpr, avg(case when y_true = 0 then {pred} end) as fpr, "
        "avg((y_prob - y_true) * (y_prob - y_true)) as brier from long group by run, attribute, code"
    )
    on = lambda x: " and ".join(f"b.{c} = {x}.{c}" for c in BY3)
    m = (f"select b.*, a.auc_roc, e.ece from ({base}) b join ({Q.rank_metrics('long', BY3)}) a on {on('a')} "
         f"join ({Q.calib_error('long', BY3, 10, 'equal_width')}) e on {on('e')}")
    return (f"select m.*, coalesce(l.label, m.code) as label, m.n < {FA.MIN_SUBGROUP_N} as underpowered from ({m}) m "
            f"left join ({LABELS}) l on l.attribute = m.attribute and l.code = m.code")


def W(body: str) -> str:
    return Q.with_fixtures(body, "accounts", "scores_attr", extra=[("acc", CLEAN), ("sa", SA), ("long", LONG)])


@case("i1_i2_subgroup_audit", W(sub_sql()), doubles=SUB_COLS)
def q_i2(spark, sf):
    return FA.audit_attributes(scored_accounts(spark, sf), ATTRS, by=["run"])


def disp_sql() -> str:
    ref = (f"select run, attribute, label as ref_label, selection_rate as r_sel, tpr as r_tpr, fpr as r_fpr, auc_roc as r_auc, ece as r_ece from ("
           f"select *, row_number() over (partition by run, attribute order by n desc, try_cast(code as double) nulls last, code) as rn from ({sub_sql()}) s) z where rn = 1")
    fin = lambda c: f"({c} is not null and not isnan({c}))"
    return (
        f"select s.run, s.attribute, s.code, s.label, r.ref_label, s.n, s.selection_rate - r.r_sel as selection_rate_diff, "
        f"case when {fin('s.selection_rate')} and {fin('r.r_sel')} and r.r_sel <> 0 then s.selection_rate / r.r_sel end as selection_rate_ratio, "
        "s.tpr - r.r_tpr as tpr_diff, s.fpr - r.r_fpr as fpr_diff, abs(s.tpr - r.r_tpr) as equal_opportunity_violation, "
        "greatest(abs(s.tpr - r.r_tpr), abs(s.fpr - r.r_fpr)) as equalised_odds_violation, s.auc_roc - r.r_auc as auc_diff, s.ece - r.r_ece as ece_diff "
        f"from ({sub_sql()}) s join ({ref}) r on s.run = r.run and s.attribute = r.attribute"
    )


@case("i3_disparity", W(disp_sql()), doubles=DISP_COLS)
def q_i3(spark, sf):
    return FA.disparity(FA.audit_attributes(scored_accounts(spark, sf), ATTRS, by=["run"]))


@case(
    "i4_subgroup_reliability",
    W("select b.run, b.attribute, b.code, b.bin, b.sp / b.n as confidence, b.sy / b.n as frequency, cast(b.n as bigint) as count from ("
      + Q.binned("long", BY3, 10) + ") b join (select run, attribute, code from long group by run, attribute, code having count(*) >= 50) k "
      "on b.run = k.run and b.attribute = k.attribute and b.code = k.code"),
    doubles=["confidence", "frequency"],
)
def q_i4(spark, sf):
    return FA.subgroup_reliability(scored_accounts(spark, sf), ATTRS)


@case(
    "i6_fairness_summary",
    W("select run, 'identity' as calibrator, attribute, max(abs(selection_rate_diff)) as max_abs_dp_diff, max(equal_opportunity_violation) as max_eo_violation, "
      "max(equalised_odds_violation) as max_eodds_violation, min(selection_rate_ratio) as min_selection_ratio from ("
      + disp_sql().replace("select s.run, s.attribute,", "select s.run, s.attribute,", 1) + ") d group by run, attribute"),
    doubles=["max_abs_dp_diff", "max_eo_violation", "max_eodds_violation", "min_selection_ratio"],
)
def q_i6(spark, sf):
    s = scored_accounts(spark, sf, split=None)
    test = s.where(F.col("split") == "test").withColumn("y_prob", F.least(F.greatest("y_prob", F.lit(1e-7)), F.lit(1 - 1e-7)))
    sub = FA.audit_attributes(test, ATTRS, by=["run"]).withColumn("calibrator", F.lit("identity"))
    return FA.fairness_summary(FA.disparity(sub, ["run", "calibrator", "attribute"]))


@case("i5_audit_run_platt", None)
def q_i5(spark, sf):
    """Platt fitted on val per run, applied to test, then the attribute audit (fit: rows-only check)."""
    s = scored_accounts(spark, sf, split=None)
    return FA.audit_run(s.where(F.col("split") == "val"), s.where(F.col("split") == "test"), ATTRS, use_platt=True)
