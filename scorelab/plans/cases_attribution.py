"""Registered queries: attention attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import attribution as L
from ..operators.encode import token_layout_df
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

AUG = ("select layer, row_id, i, j, 0.5 * a + case when i = j then 0.5 else 0.0 end as a from "
       "(select layer, row_id, i, j, avg(w) as a from attention group by all) h")
ROLL = ("select a.row_id, a.i, r.j, sum(a.a * r.r) as r from (select * from aug where layer = 1) a join "
        "(select row_id, i, j, a as r from aug where layer = 0) r on a.row_id = r.row_id and a.j = r.i group by a.row_id, a.i, r.j")
LAYOUT = "select * from (values " + ", ".join(
    f"({p}, '{f}', {g}, '{n}', {('cast(null as int)' if m is None else m)})" for p, f, g, n, m in S.token_layout()) + ") t(pos, feature, group_id, group_name, month)"


def W(body: str, *extra) -> str:
    return Q.with_fixtures(body, "attention", "attention_labels", extra=[("aug", AUG), ("roll", ROLL), ("layout", LAYOUT), *extra])


def R(spark, sf):
    return L.attention_rollout(fx.attention(spark, sf), 2)


@case("l1_attention_rollout", W("select row_id, i, j, r from roll"), doubles=["r"])
def q_l1(spark, sf):
    return R(spark, sf)


CLS_SQL = ("select j, case when sum(m) over () > 0 then m / sum(m) over () else m end as score from "
           "(select j, avg(r) as m from roll where i = 0 and j <> 0 group by j) g")


@case("l2_cls_scores", W(CLS_SQL), doubles=["score"])
def q_l2(spark, sf):
    return L.cls_scores(R(spark, sf))


@case("l3_rollout_by_class", W("select i, j, avg(r) filter (where y = 1) as mean_1, avg(r) filter (where y = 0) as mean_0, "
                               "avg(r) filter (where y = 1) - avg(r) filter (where y = 0) as diff from roll join attention_labels using (row_id) group by i, j"),
      doubles=["mean_1", "mean_0", "diff"])
def q_l3(spark, sf):
    return L.rollout_by_class(R(spark, sf), fx.attention_labels(spark, sf))


@case("l4_head_entropy", W("select layer, head, avg(h) as entropy from (select layer, head, row_id, sum(-w * ln(w + 1e-12)) as h from attention where i = 0 group by all) e group by all"),
      doubles=["entropy"])
def q_l4(spark, sf):
    return L.head_entropy(fx.attention(spark, sf))


@case("l5_mean_attention", W("select layer, head, i, j, avg(w) as mean_w from attention group by all"), doubles=["mean_w"])
def q_l5(spark, sf):
    return L.mean_attention(fx.attention(spark, sf))


@case("l5_mean_rollout", W("select i, j, avg(r) as mean_r from roll group by all"), doubles=["mean_r"])
def q_l5_rollout(spark, sf):
    return L.mean_rollout(R(spark, sf))


def l6_sql() -> str:
    assoc = ("select feature, abs(corr(v, y)) as assoc from (" + " union all ".join(
        f"select '{c}' as feature, cast({c} as double) as v, cast(\"DEFAULT\" as double) as y from accounts" for c in S.CATEGORICAL + S.PAY_STATUS[:4]) + ") m group by feature")
    att = f"select l.feature, c.score as attention from ({CLS_SQL}) c join layout l on l.pos = c.j"
    j = f"select a.feature, a.attention, b.assoc from ({att}) a join ({assoc}) b using (feature)"
    return Q.with_fixtures(
        "select *, rank_a - rank_b as rank_gap from (select *, cast(rank() over (order by round(attention, 9) desc, feature) as int) as rank_a, "
        f"cast(rank() over (order by round(assoc, 9) desc, feature) as int) as rank_b from ({j}) j) z",
        "attention", "accounts", extra=[("aug", AUG), ("roll", ROLL), ("layout", LAYOUT)])


@case("l6_compare_importance", l6_sql(), doubles=["attention", "assoc"])
def q_l6(spark, sf):
    layout = token_layout_df(spark)
    att = L.cls_scores(R(spark, sf)).join(layout.select(F.col("pos").alias("j"), "feature"), "j").select("feature", F.col("score").alias("attention"))
    acc = fx.accounts(spark, sf)
    from ..operators.clean import melt

    assoc = melt(acc, S.CATEGORICAL + S.PAY_STATUS[:4], keep=["DEFAULT"]).groupBy("feature").agg(
        F.abs(F.corr("value", F.col("DEFAULT").cast("double"))).alias("assoc"))
    return L.compare_importance(att, assoc, "attention", "assoc")


@case("l7_group_attention", W("select group_name, sum(w) as attention, count(*) as n_tokens, cast(rank() over (order by round(sum(w), 9) desc, group_name) as int) as rank from "
                              "(select j, avg(w) as w from attention where layer = 1 and i = 0 and j <> 0 group by j) c join layout l on l.pos = c.j group by group_name"),
      doubles=["attention"])
def q_l7(spark, sf):
    return L.group_attention(fx.attention(spark, sf), token_layout_df(spark), layer=1)
