"""Registered queries: sources and sinks (A1-A12). Writers write under the
shared checkpoint folder (the cluster's spark.checkpoint.dir) and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schema as S
from ..operators.profile import class_distribution
from ..operators.split import stratified_split
from ..session import checkpoint_dir
from ..sources import fixtures as fx
from ..sources import io
from . import sqltext as Q
from .cases_drift import _split_sql
from .registry import case


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/scorelab-io/{name}-{uuid.uuid4().hex[:8]}"


@case("a1_load_first_available", "select cast(i as int) as attempt, 'parquet' as source, ok, (not ok) as has_error, n as rows_loaded from (values (0, false), (1, true)) v(i, ok), (select count(*) as n from customer) c")
def q_a1(spark, sf):
    """Missing candidates fall through; the provenance lists every attempt."""
    df, prov = io.load_first_available(spark, [("parquet", f"{sf}/no_such_table.parquet", {}), ("parquet", f"{sf}/customer.parquet", {})])
    n = df.agg(F.count(F.lit(1)).alias("rows_loaded"))
    short = prov.select("attempt", "source", "ok", F.col("error").isNotNull().alias("has_error"), F.lit(1).alias("_k"))
    return short.join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


@case("a1_fallback_while_reading", "select * from (values (0, 'parquet', false), (1, 'csv', false), (2, 'parquet', true)) v(attempt, source, ok), (select count(*) as rows_loaded, sum(c_acctbal) as balance from customer) c", doubles=["balance"])
def q_a1_reading(spark, sf):
    """Candidates that fail while they are read, a file that is no Parquet and a CSV with rows that don't parse, fall through; a repeated one is tried once."""
    broken, ragged = _scratch(spark, "broken.parquet"), _scratch(spark, "ragged.csv")
    names = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_acctbal")
    names.select("c_name").write.text(broken)
    names.select(F.concat_ws(",", F.when(F.col("c_custkey") % 2 == 0, "no number").otherwise(F.col("c_custkey").cast("string")), F.col("c_acctbal").cast("string"))).write.text(ragged)
    csv = ("csv", ragged, {"schema": "c_custkey long, c_acctbal double"})
    df, prov = io.load_first_available(spark, [("parquet", broken, {}), csv, csv, ("parquet", f"{sf}/customer.parquet", {})])
    n = df.agg(F.count(F.lit(1)).alias("rows_loaded"), F.sum("c_acctbal").alias("balance"))
    return prov.select("attempt", "source", "ok", F.lit(1).alias("_k")).join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


A2_COLS = ["row_id"] + S.ALL_COLUMNS
A2_Q = [c if c != "DEFAULT" else '"DEFAULT"' for c in A2_COLS]


@case("a2_read_with_banner", Q.with_fixtures("select " + ", ".join(f"cast({q} as double) as {q}" for q in A2_Q) + " from accounts", "accounts"), doubles=A2_COLS)
def q_a2(spark, sf):
    """Accounts written as CSV files, each with a banner line above its header, read back in full."""
    path = _scratch(spark, "banner")
    lines = fx.accounts(spark, sf).select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in A2_COLS]).alias("value"))
    top = ["credit accounts export, all, columns", ",".join(A2_COLS)]

    def with_banner(frames):
        import pandas as pd

        yield pd.DataFrame({"value": top})
        yield from frames

    lines.mapInPandas(with_banner, "value string").write.mode("overwrite").text(path)
    top_of, last = path.rsplit("/", 1)
    return io.read_with_banner(spark, ["no_such_file.csv", "no_such_file.csv", last], ", ".join(f"{c} double" for c in A2_COLS), roots=("/no/such/root", top_of))


@case("a4_normalise_schema", Q.with_fixtures("select row_id, " + ", ".join(c if c != "DEFAULT" else '"DEFAULT"' for c in S.ALL_COLUMNS) + " from accounts", "accounts"),
      doubles=["LIMIT_BAL"] + S.BILL_AMT + S.PAY_AMT)
def q_a4(spark, sf):
    """Raw-looking headers (PAY_1, 'default payment next month', ID, an extra column) normalised."""
    a = fx.accounts(spark, sf)
    raw = a.withColumnsRenamed({"PAY_0": "PAY_1", "DEFAULT": "default payment next month"}).withColumns(
        {"ID": F.col("row_id"), "extra": F.lit(1)})
    return io.normalise_schema(raw, keep=["row_id"])


@case("a5_a7_write_read_scores", Q.with_fixtures("select run, split, count(*) as n from scores where run in ('a', 'b') and split = 'test' group by run, split", "scores"))
def q_a5(spark, sf):
    """Score table written partitioned by run/split, read back with pruning."""
    path = _scratch(spark, "scores")
    io.write_scores(fx.scores(spark, sf, attributes=False), path)
    back = io.read_scores(spark, path, runs=["a", "b"], split="test", strict=True)
    return back.groupBy("run", "split").agg(F.count(F.lit(1)).alias("n"))


@case("a5_write_splits", Q.with_fixtures("select split, count(*) as n, sum(LIMIT_BAL) as sum_limit from scores_split group by split", "accounts", extra=[("scores_split", _split_sql(42))]), doubles=["sum_limit"])
def q_a5_splits(spark, sf):
    """Accounts written as one dataset partitioned by split, read back."""
    path = _scratch(spark, "splits")
    io.write_splits(stratified_split(fx.accounts(spark, sf), seed=42), path)
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("LIMIT_BAL").alias("sum_limit"))


@case("a6_write_report", Q.with_fixtures("select cast(\"DEFAULT\" as bigint) as cls, count(*) as n, count(*) / sum(count(*)) over () as share from accounts group by 1", "accounts"), doubles=["share"])
def q_a6(spark, sf):
    path = _scratch(spark, "report")
    io.write_report(class_distribution(fx.accounts(spark, sf)), path)
    return spark.read.json(path).select("cls", "n", "share")


@case("a8_baseline_metrics", Q.with_fixtures("select * exclude (run), run as model from (" + Q.bundle("scores", ["run"], 0.5, 15) + ") b where run in ('a', 'c')", "scores"),
      doubles=["auc_roc", "auc_pr", "f1", "accuracy", "precision", "recall", "brier", "ece"])
def q_a8(spark, sf):
    from ..operators import metrics as M

    s = fx.scores(spark, sf, attributes=False)
    b = M.metric_bundle(s, 0.5, ["run"], 15).withColumnRenamed("run", "model").withColumnRenamed("auc_pr", "avg_precision")
    return io.read_baseline_metrics(b, ("a", "c"))


@case("a9_training_curves", "select o_orderpriority as run, cast(year(o_orderdate) as int) as epoch, avg(o_totalprice) / 100000.0 as train_loss, 1.0 * count(*) filter (where o_orderstatus = 'F') / count(*) as val_auc_roc from orders group by all",
      doubles=["train_loss", "val_auc_roc"])
def q_a9(spark, sf):
    """Curves read from CSV logs, one folder for each run; the figures of an epoch are taken from a year's orders."""
    path = _scratch(spark, "logs")
    log = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderpriority").alias("run"), F.year("o_orderdate").alias("epoch")).agg(
        (F.avg("o_totalprice") / 100000.0).alias("train_loss"), (F.count(F.when(F.col("o_orderstatus") == "F", 1)) / F.count(F.lit(1))).alias("val_auc_roc"), F.lit("note, with a comma").alias("extra"))
    log.write.partitionBy("run").option("header", True).csv(path)
    return io.read_training_logs(spark, path)


@case("a10_read_attention", Q.with_fixtures("select cast(layer as int) as layer, count(*) as n from attention group by layer", "attention"))
def q_a10(spark, sf):
    a = fx.attention(spark, sf).withColumn("key", F.concat(F.lit("layer_"), F.col("layer").cast("string"))).drop("layer")
    return io.read_attention(a).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@case("a11_to_markdown", Q.with_fixtures(
    "select '| ' || concat_ws(' | ', cast(cls as varchar), cast(n as varchar), printf('%.4f', share)) || ' |' as line from "
    "(select cast(\"DEFAULT\" as int) as cls, count(*) as n, count(*) / sum(count(*)) over () as share from accounts group by 1) d", "accounts"))
def q_a11(spark, sf):
    d = class_distribution(fx.accounts(spark, sf)).select("cls", "n", F.format_string("%.4f", "share").alias("share"))
    return io.to_markdown(d)


_LINES = "select c_mktsegment as segment, count(*) as n, printf('%.2f', max(c_acctbal)) as best_balance from customer group by 1"


@case("a11_table_lines", f"with t as ({_LINES}), r as (select *, row_number() over (order by segment) as k, count(*) over () as m from t) "
      "select 'markdown' as fmt, v.n, v.line from (values (-1, '| segment | n | best_balance |'), (0, '|---|---|---|')) v(n, line) union all select 'markdown', k, '| ' || segment || ' | ' || n || ' | ' || best_balance || ' |' from r "
      "union all select 'csv', 0, 'segment,n,best_balance' union all select 'csv', k, segment || ',' || n || ',' || best_balance from r "
      "union all select 'latex', v.n, v.line from (values (-3, '\\begin{tabular}{lll}'), (-2, '\\hline'), (-1, 'segment & n & best\\_balance \\\\'), (0, '\\hline')) v(n, line) "
      "union all select 'latex', k, segment || ' & ' || n || ' & ' || best_balance || ' \\\\' from r union all select distinct 'latex', m + 1, '\\hline' from r union all select distinct 'latex', m + 2, '\\end{tabular}' from r")
def q_a11_lines(spark, sf):
    """A result table as markdown, CSV and LaTeX, with header lines, in order."""
    t = spark.read.parquet(f"{sf}/customer.parquet").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.format_string("%.2f", F.max("c_acctbal")).alias("best_balance"))
    out = None
    for fmt in ("markdown", "csv", "latex"):
        lines = io.table_lines(t, fmt, ["segment"]).select(F.lit(fmt).alias("fmt"), "n", "line")
        out = lines if out is None else out.unionByName(lines)
    return out


@case("a12_export_results", "select * from (values ('max_depth', '10', 'int'), ('class_weight', 'None', 'none'), ('max_features', '0.3', 'float'), ('criterion', 'entropy', 'string')) p(param, value, kind), "
      "(select avg(c_acctbal) filter (where c_nationkey < 12) as baseline_auc, avg(c_acctbal) filter (where c_nationkey >= 12) as tuned_auc, cast(0.31 as double) as best_threshold, count(distinct c_nationkey) as n_importance, count(distinct c_mktsegment) as n_cv from customer) c",
      doubles=["baseline_auc", "tuned_auc", "best_threshold"])
def q_a12_export(spark, sf):
    """Results exported and read back: typed parameters, scores, threshold and the tables' rows."""
    path = _scratch(spark, "results")
    c = spark.read.parquet(f"{sf}/customer.parquet")
    metrics = c.groupBy(F.when(F.col("c_nationkey") < 12, "baseline").otherwise("tuned").alias("model")).agg(F.avg("c_acctbal").alias("auc_roc"))
    cv = c.groupBy(F.col("c_mktsegment").alias("metric")).agg(F.avg("c_acctbal").alias("mean"))
    importance = c.groupBy(F.col("c_nationkey").cast("string").alias("feature")).agg(F.avg("c_acctbal").alias("importance"))
    params = {"max_depth": 10, "class_weight": None, "max_features": 0.3, "criterion": "entropy"}
    io.export_results(metrics, cv, importance, params, 0.31000000000000005, {"max_depth": [5, None]}, path)
    one = spark.read.json(f"{path}/config").select("baseline_auc", "tuned_auc", "best_threshold", F.lit(1).alias("_k"))
    for name in ("importance", "cv"):
        rows = spark.read.option("header", True).csv(f"{path}/{name}").agg(F.count(F.lit(1)).alias(f"n_{name}"))
        one = one.join(rows.withColumn("_k", F.lit(1)), "_k")
    return io.read_config(spark, path).select("param", "value", "kind", F.lit(1).alias("_k")).join(one, "_k").drop("_k")


PARAM_SQL = ("select row_id, case when row_id % 5 = 0 then 'None' when row_id % 5 = 1 then cast(AGE as varchar) "
             "when row_id % 5 = 2 then printf('%.2f', BILL_AMT1) when row_id % 5 = 3 then (case when SEX = 1 then 'True' else 'False' end) else 'sqrt' end as value from accounts")


@case("a12_coerce_params", Q.with_fixtures(
    "select row_id, value, case when trim(value) in ('None', 'null', '') then 'none' when trim(value) in ('True', 'False', 'true', 'false') then 'bool' "
    "when regexp_matches(trim(value), '^-?[0-9]+$') then 'int' when regexp_matches(trim(value), '^-?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][-+]?[0-9]+)?$') then 'float' else 'string' end as kind, "
    "case when trim(value) in ('True', 'true') then true when trim(value) in ('False', 'false') then false end as as_bool, "
    "case when regexp_matches(trim(value), '^-?[0-9]+$') then cast(trim(value) as bigint) end as as_int, "
    "case when regexp_matches(trim(value), '^-?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][-+]?[0-9]+)?$') then cast(trim(value) as double) end as as_double from p",
    "accounts", extra=[("p", PARAM_SQL)]), doubles=["as_double"])
def q_a12(spark, sf):
    a = fx.accounts(spark, sf)
    k = F.col("row_id") % 5
    v = (F.when(k == 0, "None").when(k == 1, F.col("AGE").cast("string")).when(k == 2, F.format_string("%.2f", "BILL_AMT1"))
         .when(k == 3, F.when(F.col("SEX") == 1, "True").otherwise("False")).otherwise("sqrt"))
    return io.coerce_params(a.select("row_id", v.alias("value")))
