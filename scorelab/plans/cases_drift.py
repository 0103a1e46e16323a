"""Registered queries: drift and reproducibility checks (M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import uniform
from ..operators import drift as D
from ..operators.encode import numeric_metadata
from ..operators.split import stratified_split
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import case

T = '"DEFAULT"'


def perturbed(spark, sf):
    """Accounts with a hash-chosen 10 % of BILL_AMT1 scaled by 1 + 2e-4 (beyond
    rtol 1e-4), 5 % of PAY_0 shifted by one and 1 % of rows dropped."""
    a = fx.accounts(spark, sf)
    k = F.col("row_id").cast("string")
    b = a.where(uniform(k, "|drop") >= 0.01).withColumns({
        "BILL_AMT1": F.when(uniform(k, "|b1") < 0.1, F.col("BILL_AMT1") * F.lit(1.0002)).otherwise(F.col("BILL_AMT1")),
        "PAY_0": F.when(uniform(k, "|p0") < 0.05, F.col("PAY_0") + 1).otherwise(F.col("PAY_0")).cast("int"),
    })
    return a, b


def _k(tag: str) -> str:
    return Q.U(f"concat(cast(row_id as varchar), '{tag}')")


PERT = (f"select * replace (case when {_k('|b1')} < 0.1 then BILL_AMT1 * 1.0002 else BILL_AMT1 end as BILL_AMT1, "
        f"cast(case when {_k('|p0')} < 0.05 then PAY_0 + 1 else PAY_0 end as int) as PAY_0) from accounts where {_k('|drop')} >= 0.01")


def m1_sql() -> str:
    cols = [c for c in S.ALL_COLUMNS]
    q = lambda c: T if c == "DEFAULT" else c
    j = "select a.*, b.row_id as rb, " + ", ".join(f"b.{q(c)} as b_{c}" for c in cols) + " from accounts a full outer join pert b on a.row_id = b.row_id"
    parts = []
    for c in cols:
        same = f"((a_{c} is null and b_{c} is null) or abs(cast(a_{c} as double) - cast(b_{c} as double)) <= 1e-6 + 1e-4 * abs(cast(b_{c} as double)))"
        parts.append(f"select '{c}' as \"column\", cast(count(*) filter (where row_id is not null and rb is not null and not coalesce({same}, false)) as bigint) as n_mismatch from j")
    parts.append("select '<only_left>', cast(count(*) filter (where rb is null) as bigint) from j")
    parts.append("select '<only_right>', cast(count(*) filter (where row_id is null) as bigint) from j")
    names = lambda src: f"(select json_keys(to_json(r)) from {src} r limit 1)"
    parts.append(f"select '<column_order>', cast(case when {names('accounts')} = {names('pert')} then 0 else 1 end as bigint)")
    body = " union all ".join(parts)
    j = j.replace("select a.*,", "select a.row_id, " + ", ".join(f"a.{q(c)} as a_{c}" for c in cols) + ",")
    return Q.with_fixtures(body, "accounts", extra=[("pert", PERT), ("j", j)])


@case("m1_table_diff", m1_sql())
def q_m1(spark, sf):
    a, b = perturbed(spark, sf)
    return D.table_diff(a, b, ["row_id"])


FP_COLS = ["LIMIT_BAL", "AGE", "BILL_AMT1", "PAY_AMT1"]


def _split_sql(seed: int) -> str:
    h = f"cast(('0x'||substr(md5(concat(cast(row_id as varchar), '|{seed}')),1,15)) as bigint)"
    return (f"select *, case when r_ <= nt_ then 'test' when r_ <= nt_ + nv_ then 'val' else 'train' end as split from ("
            f"select *, round_even(n_ * {Q.lit(0.15)}, 0) as nt_, round_even((n_ - round_even(n_ * {Q.lit(0.15)}, 0)) * {Q.lit(0.15 / 0.85)}, 0) as nv_ from ("
            f"select *, row_number() over (partition by {T} order by {h}, row_id) as r_, count(*) over (partition by {T}) as n_ from accounts) a) b")


def _fp_sql(src: str) -> str:
    return (f"select split, count(*) as n_rows, avg(cast({T} as double)) as target_rate, " + ", ".join(f"avg({c}) as mean_{c}" for c in FP_COLS)
            + f", (select json_keys(to_json(r)) from ({src}) r limit 1) as cols from ({src}) s group by split")


def m2_sql() -> str:
    o, e = _fp_sql(_split_sql(7)), _fp_sql(_split_sql(42))
    checks = ["select split, 'n_rows' as \"check\", o.n_rows = e.n_rows as passed from o join e using (split)",
              "select split, 'n_cols', len(o.cols) = len(e.cols) from o join e using (split)",
              "select split, 'columns', o.cols = e.cols from o join e using (split)",
              "select split, 'target_rate', abs(o.target_rate - e.target_rate) <= 1e-3 from o join e using (split)"]
    checks += [f"select split, 'mean_{c}', abs(o.mean_{c} - e.mean_{c}) <= 1e-4 + 1e-3 * abs(e.mean_{c}) from o join e using (split)" for c in FP_COLS]
    return Q.with_fixtures(" union all ".join(checks), "accounts", extra=[("o", o), ("e", e)])


def _fp(spark, sf, seed):
    a = stratified_split(fx.accounts(spark, sf), seed=seed)
    return D.fingerprint(a, ["split"], "DEFAULT", FP_COLS)


@case("m2_fingerprint_check", m2_sql())
def q_m2(spark, sf):
    """Fingerprint of the seed-7 split against the seed-42 ledger."""
    return D.check_fingerprint(_fp(spark, sf, 7), _fp(spark, sf, 42), ["split"], FP_COLS)


M3_SQL = ("select max(abs(a.y_prob - b.y_prob)) as max_abs_diff, coalesce(corr(a.y_prob, b.y_prob), 0.0) as pearson, count(*) filter (where a.y_prob is not null and b.y_prob is not null) as n, "
          "count(*) filter (where a.y_prob is null or b.y_prob is null) as n_unmatched, "
          "max(abs(a.y_prob - b.y_prob)) <= 0.05 and coalesce(corr(a.y_prob, b.y_prob), 0.0) >= 0.999 and count(*) filter (where a.y_prob is null or b.y_prob is null) = 0 as passed from "
          "(select * from scores where run = 'a' and split = 'test') a full outer join (select * from scores where run = 'b' and split = 'test') b using (row_id)")


@case("m3_score_drift", Q.with_fixtures(M3_SQL, "scores"),
    doubles=["max_abs_diff", "pearson"])
def q_m3(spark, sf):
    s = fx.scores(spark, sf, attributes=False).where(F.col("split") == "test")
    return D.score_drift(s.where(F.col("run") == "a"), s.where(F.col("run") == "b"))


def m4_sql() -> str:
    sp = _split_sql(42)
    doc = lambda split: " union all ".join(
        f"select '{c}.{st}' as path, printf('%.4f', cast({fn}({c}) as double)) as value from ({sp}) s where split = '{split}'"
        for c in S.NUMERICAL for st, fn in (("mean", "avg"), ("min", "min"), ("max", "max")))
    body = ("select coalesce(a.path, b.path) as path, a.value as va, b.value as vb, case when a.value is null then 'missing' when b.value is null then 'unexpected' else 'changed' end as status "
            "from a full outer join b on a.path = b.path where a.value is null or b.value is null or not (abs(cast(a.value as double) - cast(b.value as double)) <= 1e-6 + 1e-4 * abs(cast(b.value as double)))")
    return Q.with_fixtures(body, "accounts", extra=[("a", doc("val")), ("b", doc("test"))])


@case("m4_doc_diff", m4_sql())
def q_m4(spark, sf):
    a = stratified_split(fx.accounts(spark, sf), seed=42)

    def doc(split):
        m = numeric_metadata(a.where(F.col("split") == split), S.NUMERICAL)
        st = F.explode(F.array(*[F.struct(F.concat(F.col("feature"), F.lit(f".{k}")).alias("path"), F.format_string("%.4f", F.col(k)).alias("value"))
                                 for k in ("mean", "min", "max")]))
        return m.select(st.alias("s")).select("s.*")

    return D.doc_diff(doc("val"), doc("test")).select(F.col("path"), "va", "vb", "status")


@case("m5_manifest_check", Q.with_fixtures(
    "select r.run, s.split from (select distinct run from scores union all select 'd') r, (select distinct split from scores) s "
    "where (r.run, s.split) not in (select distinct run, split from scores)", "scores"))
def q_m5(spark, sf):
    s = fx.scores(spark, sf, attributes=False)
    runs = s.select("run").distinct().unionByName(spark.createDataFrame([("d",)], "run string"))
    required = runs.withColumn("_k", F.lit(1)).join(s.select("split").distinct().withColumn("_k", F.lit(1)), "_k").drop("_k")  # runs x splits
    return D.manifest_check(required, s, ["run", "split"])


@case("m6_content_hash", None)
def q_m6(spark, sf):
    """sha256 of every parquet file of the input directory (listed by the binaryFile source, hashed in pieces)."""
    from ..sources.io import content_hash

    return content_hash(spark, sf, "*.parquet").select("path", "length", "sha256")


@case("m6_content_roots", None)
def q_m6_roots(spark, sf):
    """Merkle root of the bytes of every parquet file of the input directory, read in splits."""
    from ..sources.io import content_roots

    return content_roots(spark, sf, "*.parquet")


def m7_sql() -> str:
    return f"select bool_and(passed) as all_passed, count(*) as n_checks, count(*) filter (where not passed) as n_failed from (select passed from ({m2_sql()}) f union all select passed from ({Q.with_fixtures(M3_SQL, 'scores')}) s) u"


@case("m7_check_report", m7_sql())
def q_m7(spark, sf):
    chk = q_m2(spark, sf).select("check", "passed")
    drift = q_m3(spark, sf).select(F.lit("score_drift").alias("check"), "passed")
    return D.report([chk, drift])
