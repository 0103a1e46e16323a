"""Registered queries: splits, sampling, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import clean, encode as EN, split as SP
from ..operators.clean import clean_categoricals
from ..operators.profile import chi2_test, ks_two_sample
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import CASES, case

T = '"DEFAULT"'
CLEAN = ("select * replace (cast(case when EDUCATION in (0,5,6) then 4 else EDUCATION end as int) as EDUCATION, "
         "cast(case when MARRIAGE = 0 then 3 else MARRIAGE end as int) as MARRIAGE) from accounts")


def H(key: str, tag: str) -> str:
    return f"cast(('0x'||substr(md5(concat(cast({key} as varchar), '{tag}')),1,15)) as bigint)"


SPLIT = (f"select *, case when r_ <= nt_ then 'test' when r_ <= nt_ + nv_ then 'val' else 'train' end as split from ("
         f"select *, round_even(n_ * {Q.lit(0.15)}, 0) as nt_, round_even((n_ - round_even(n_ * {Q.lit(0.15)}, 0)) * {Q.lit(0.15 / 0.85)}, 0) as nv_ from ("
         f"select *, row_number() over (partition by {T} order by {H('row_id', '|42')}, row_id) as r_, count(*) over (partition by {T}) as n_ from acc) a) b")


def W(body: str, *extra) -> str:
    return Q.with_fixtures(body, "accounts", extra=[("acc", CLEAN), ("sp", f"select * exclude (r_, n_, nt_, nv_) from ({SPLIT}) s"), *extra])


def A(spark, sf):
    return clean_categoricals(fx.accounts(spark, sf))


def AS(spark, sf):
    return SP.stratified_split(A(spark, sf))


@case("d1_stratified_split", W("select row_id, split from sp"))
def q_d1(spark, sf):
    return AS(spark, sf).select("row_id", "split")


WCOLS = S.BILL_AMT + S.PAY_AMT

CASES["b8_winsor_report"].sql = W(
    "select b.feature, cast(count(*) filter (where v < lo) as bigint) as n_low, cast(count(*) filter (where v > hi) as bigint) as n_high, max(lo) as lo, max(hi) as hi from ("
    + " union all ".join(f"select '{c}' as feature, cast({c} as double) as v from sp" for c in WCOLS)
    + ") l join (" + " union all ".join(f"select '{c}' as feature, quantile_cont({c}, {Q.lit(0.01)}) as lo, quantile_cont({c}, {Q.lit(0.99)}) as hi from sp where split = 'train'" for c in WCOLS)
    + ") b on b.feature = l.feature group by b.feature")


@case("b8_apply_winsor", W("select row_id, " + ", ".join(f"least(greatest({c}, lo_{c}), hi_{c}) as {c}" for c in WCOLS) + " from sp, ("
                           + "select " + ", ".join(f"quantile_cont({c}, {Q.lit(0.01)}) as lo_{c}, quantile_cont({c}, {Q.lit(0.99)}) as hi_{c}" for c in WCOLS)
                           + " from sp where split = 'train') b"), doubles=WCOLS)
def q_b8b(spark, sf):
    a = AS(spark, sf)
    b = clean.fit_winsor(a.where(F.col("split") == "train"), WCOLS)
    return clean.apply_winsor(a, b, WCOLS).select("row_id", *WCOLS)


SCOLS = S.NUMERICAL


@case("d2_d3_scaler", W("select row_id, " + ", ".join(f"({c} - m_{c}) / case when s_{c} = 0 then 1.0 else s_{c} end as {c}" for c in SCOLS) + ", EDUCATION from sp, ("
                        + "select " + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in SCOLS) + " from sp where split = 'train') p"),
      doubles=SCOLS)
def q_d2(spark, sf):
    a = AS(spark, sf)
    p = EN.fit_scaler(a.where(F.col("split") == "train"), SCOLS)
    return EN.apply_scaler(a, p, SCOLS).select("row_id", *SCOLS, "EDUCATION")


VOC = S.CATEGORICAL + S.PAY_STATUS


@case("d4_d5_vocab", W(" union all ".join(f"select '{c}' as feature, cast({c} as bigint) as value, cast(dense_rank() over (order by {c}) - 1 as int) as idx "
                                          f"from (select distinct {c} from sp where split = 'train') d" for c in VOC)))
def q_d4(spark, sf):
    return EN.build_vocab(AS(spark, sf).where(F.col("split") == "train"), VOC)


@case("d4_numeric_metadata", W(" union all ".join(f"select '{c}' as feature, avg({c}) as mean, stddev_samp({c}) as std, cast(min({c}) as double) as min, cast(max({c}) as double) as max "
                                                  f"from sp where split = 'train'" for c in S.NUMERICAL)), doubles=["mean", "std", "min", "max"])
def q_d4n(spark, sf):
    return EN.numeric_metadata(AS(spark, sf).where(F.col("split") == "train"), S.NUMERICAL)


@case("d6_encode_pay", W(" union all ".join(
    f"select row_id, '{p}' as feature, cast(case when {p} = -2 then 0 when {p} = -1 then 1 when {p} = 0 then 2 else 3 end as int) as state, "
    f"case when {p} > 0 then {p} / 8.0 else 0.0 end as severity, cast({p} + 2 as int) as raw from acc" for p in S.PAY_STATUS)), doubles=["severity"])
def q_d6(spark, sf):
    a = A(spark, sf)
    parts = []
    for p in S.PAY_STATUS:
        st, sev, raw = EN.encode_pay(p)
        parts.append(a.select("row_id", F.lit(p).alias("feature"), st.alias("state"), sev.alias("severity"), raw.alias("raw")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@case("d7_d8_tokenise_summary", W(
    "select kind, slot, code, count(*) as n from ("
    + " union all ".join(f"select 'cat_index' as kind, {i} as slot, cast(v.idx as int) as code from acc a join voc v on v.feature = '{c}' and v.value = a.{c}" for i, c in enumerate(S.CATEGORICAL))
    + " union all " + " union all ".join(f"select 'pay_state', {i}, cast(case when {p} = -2 then 0 when {p} = -1 then 1 when {p} = 0 then 2 else 3 end as int) from acc" for i, p in enumerate(S.PAY_STATUS))
    + ") t group by all", ("voc", " union all ".join(f"select '{c}' as feature, cast({c} as bigint) as value, dense_rank() over (order by {c}) - 1 as idx from (select distinct {c} from acc) d" for c in S.CATEGORICAL))))
def q_d7(spark, sf):
    a = A(spark, sf)
    toks = EN.tokenise(a, EN.build_vocab(a, S.CATEGORICAL))
    return EN.tokenise_summary(toks)


_NUMERIC = " union all ".join(f"select 'numeric' as kind, {i} as slot, cast(cast({c} as float) as double) as v from acc" for i, c in enumerate(S.NUMERICAL))
_SEVERITY = " union all ".join(f"select 'severity' as kind, {i} as slot, cast(cast(case when {p} > 0 then cast({p} as double) / 8.0 else 0.0 end as float) as double) as v from acc" for i, p in enumerate(S.PAY_STATUS))


@case("d8_token_value_ranges", W(f"select kind, cast(slot as int) as slot, min(v) as min, max(v) as max, avg(v) as mean from ({_NUMERIC} union all {_SEVERITY}) t group by kind, slot"),
      doubles=["min", "max", "mean"])
def q_d8(spark, sf):
    a = A(spark, sf)
    return EN.token_value_ranges(EN.tokenise(a, EN.build_vocab(a, S.CATEGORICAL)))


def mask_sql(p: float = 0.15, mn: int = 1, mx: int = 23, seed: int = 0) -> str:
    k = "cast(row_id as varchar)"
    long = " union all ".join(
        f"select row_id, {i} as pos, {Q.U(f'concat({k}, {chr(39)}|{i}|{seed}|sel{chr(39)})')} as u, {Q.U(f'concat({k}, {chr(39)}|{i}|{seed}|pick{chr(39)})')} as v, "
        f"{Q.U(f'concat({k}, {chr(39)}|{i}|{seed}|mode{chr(39)})')} as w from acc" for i in range(23))
    r = (f"select *, u < {Q.lit(p)} as s0, sum(case when u < {Q.lit(p)} then 1 else 0 end) over (partition by row_id) as cnt, "
         f"row_number() over (partition by row_id, u < {Q.lit(p)} order by v, pos) as rk from lg")
    sel = f"((s0 and rk <= {mx}) or (not s0 and rk <= greatest({mn} - cnt, 0)))"
    return W(f"select row_id, pos, {sel} as selected, cast(case when not {sel} then -1 when w < {Q.lit(0.8)} then 0 when w < {Q.lit(0.8 + 0.1)} then 1 else 2 end as int) as mode from r",
             ("lg", long), ("r", r))


@case("d9_mask_tokens", mask_sql())
def q_d9(spark, sf):
    m = EN.mask_tokens(A(spark, sf), p=0.15, min_mask=1, max_mask=23, seed=0)
    return m.select("row_id", F.posexplode(F.arrays_zip("mask_positions", "replace_mode")).alias("pos", "z")).select(
        "row_id", F.col("pos").cast("int").alias("pos"), F.col("z.mask_positions").alias("selected"), F.col("z.replace_mode").alias("mode"))


def batches_sql(bs: int = 64, seed: int = 0) -> str:
    r = (f"select row_id, {T} as y, row_number() over (partition by {T} order by {H('row_id', f'|{seed}|batch')}, row_id) as r_ from acc")
    c = (f"select greatest(1, cast(round_even({float(bs)!r} * sum({T}) / count(*), 0) as bigint)) as kp, count(*) - sum({T}) as nneg, sum({T}) as np_ from acc")
    c2 = f"select kp, {bs} - kp as kn, least(floor(np_ / kp), floor(nneg / ({bs} - kp))) as nb from c"
    return W(f"select row_id, cast(case when floor((r_ - 1) / case when y = 1 then kp else kn end) < nb then floor((r_ - 1) / case when y = 1 then kp else kn end) end as bigint) as batch "
             "from r, c2", ("r", r), ("c", c), ("c2", c2))


@case("d10_assign_batches", batches_sql())
def q_d10(spark, sf):
    return SP.assign_batches(A(spark, sf), 64, drop_last=True, seed=0).select("row_id", "batch")


@case("d11_stratified_sample", W(f"select row_id, {T} as y from (select *, row_number() over (partition by {T} order by {H('row_id', '|3|sample')}, row_id) as r_ from acc) a where r_ <= 100"))
def q_d11(spark, sf):
    return SP.stratified_sample(A(spark, sf), n=100, seed=3).select("row_id", F.col("DEFAULT").alias("y"))


@case("d11_stratified_fraction", W(f"select row_id, {T} as y from (select *, row_number() over (partition by {T} order by {H('row_id', '|3|sample')}, row_id) as r_, count(*) over (partition by {T}) as n_ from acc) a where r_ <= round_even(n_ * {Q.lit(0.07)}, 0)"))
def q_d11_fraction(spark, sf):
    return SP.stratified_sample(A(spark, sf), fraction=0.07, seed=3).select("row_id", F.col("DEFAULT").alias("y"))


@case("d12_sample_n", W(f"select row_id from acc order by {H('row_id', '|5|n')}, row_id limit 300"))
def q_d12(spark, sf):
    return SP.sample_n(A(spark, sf), 300, seed=5).select("row_id")


@case("d13_stratified_folds", W(f"select row_id, cast((row_number() over (partition by {T} order by {H('row_id', '|1|fold')}, row_id) - 1) % 5 as int) as fold from acc"))
def q_d13(spark, sf):
    return SP.stratified_folds(A(spark, sf), 5, seed=1).select("row_id", "fold")


@case("d14_split_homogeneity", None, doubles=["chi2", "p_value", "cramers_v"])
def q_d14(spark, sf):
    a = AS(spark, sf).withColumn("split_code", F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2))
    return chi2_test(a, ["split_code"])


@case("d15_split_drift", None, doubles=["d", "p_value"])
def q_d15(spark, sf):
    a = AS(spark, sf).where(F.col("split").isin("train", "test")).withColumn("_is_test", (F.col("split") == "test").cast("int"))
    return ks_two_sample(a, S.NUMERICAL, "_is_test")


@case("d16_token_layout", W(" union all ".join(
    f"select {p} as pos, '{f}' as feature, {g} as group_id, '{n}' as group_name, {('cast(null as int)' if m is None else m)} as month, count({'*' if f == 'CLS' else f}) as n_tokens from acc"
    for p, f, g, n, m in S.token_layout())))
def q_d16(spark, sf):
    return EN.token_layout_counts(A(spark, sf))


@case("d17_derive_seed", W("select row_id, cast(('0x'||substr(sha256(concat_ws('|', '42', 'mask', cast(row_id as varchar))),1,8)) as bigint) as seed from acc"))
def q_d17(spark, sf):
    return A(spark, sf).select("row_id", SP.derive_seed("42", "mask", F.col("row_id").cast("string")).alias("seed"))


@case("d18_feature_variance", W("select feature, floor(variance * 100.0 + 0.5) / 100.0 as variance_2dp from (" + " union all ".join(
    f"select '{c}' as feature, case when var_pop({c}) = 0 then 1.0 else var_pop({c}) end as variance from sp where split = 'train'" for c in S.NUMERICAL) + ") v"),
      doubles=["variance_2dp"])
def q_d18(spark, sf):
    """Variances reach 1e10, so the check compares them at 2 dp (summation order moves the 6th decimal)."""
    v = EN.feature_variance(AS(spark, sf).where(F.col("split") == "train"), S.NUMERICAL)
    return v.select("feature", (F.floor(F.col("variance") * 100.0 + 0.5).cast("double") / 100.0).alias("variance_2dp"))


def _d14_d15_sql():
    from . import cases_profile as CP

    acc2 = f"select *, case when split = 'train' then 0 when split = 'val' then 1 else 2 end as split_code from sp"
    d14 = CP.chi2_sql(["split_code"]).replace("from acc", "from acc2")
    acc3 = f"select * exclude ({T}), cast(split = 'test' as int) as {T} from sp where split in ('train', 'test')"
    d15 = CP.ks_sql(S.NUMERICAL).replace("from acc", "from acc3")
    CASES["d14_split_homogeneity"].sql = W(d14, ("acc2", acc2))
    CASES["d15_split_drift"].sql = W(d15, ("acc3", acc3))


_d14_d15_sql()
