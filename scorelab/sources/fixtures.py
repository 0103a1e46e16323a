"""Deterministic fixtures derived from the driver tables.

The driver tables carry no labels, scores or attention, so the evaluation
inputs are derived from them with md5-based uniforms (identical doubles in
Spark and DuckDB). All derivations are joins, aggregations and generators
that scale with the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import uniform
from .tables import table

# Years mapped to months 1..6 (1 = most recent).
YEARS = [2001, 2000, 1999, 1998, 1997, 1996]
# Per-run label signal of the synthetic scorers.
RUN_SIGNAL = [("a", 0.30), ("b", 0.25), ("c", 0.10)]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer in the account-table schema (+ ``row_id``)."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice", "o_orderstatus"
    )
    # Money is summed and rounded as exact decimals, so the result does not
    # depend on the order in which partitions are combined.
    price = F.col("o_totalprice").cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    aggs = []
    for i, yr in enumerate(YEARS, start=1):
        in_year = F.col("y") == yr
        aggs += [
            F.sum(F.when(in_year, price).otherwise(zero)).alias(f"tot{i}"),
            F.sum(F.when(in_year & (F.col("o_orderstatus") == "F"), price).otherwise(zero)).alias(f"paid{i}"),
            F.sum(F.when(in_year, 1).otherwise(0)).alias(f"cnt{i}"),
        ]
    m = o.groupBy("o_custkey").agg(*aggs)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = c.join(m, c.c_custkey == m.o_custkey, "left")
    key = F.col("c_custkey").cast("string")
    tenth = F.lit(0.1).cast("decimal(2,1)")
    neg = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).otherwise(0.0).cast("decimal(18,2)")
    pay = [(F.least(F.coalesce(F.col(f"cnt{i}"), F.lit(0)), F.lit(10)) - 2).cast("int") for i in range(1, 7)]
    cols = [
        F.col("c_custkey").alias("row_id"),
        (F.lit(10000.0) * (F.lit(1) + F.col("c_custkey") % 80)).cast("double").alias("LIMIT_BAL"),
        (F.lit(1) + F.col("c_custkey") % 2).cast("int").alias("SEX"),
        F.floor(uniform(key, "|edu") * 7).cast("int").alias("EDUCATION"),
        F.floor(uniform(key, "|mar") * 4).cast("int").alias("MARRIAGE"),
        (F.lit(21) + F.col("c_custkey") % 55).cast("int").alias("AGE"),
    ]
    for name, p in zip(["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"], pay):
        cols.append(p.alias(name))
    for i in range(1, 7):
        cols.append(F.round(F.coalesce(F.col(f"tot{i}"), zero) * tenth + neg, 2).cast("double").alias(f"BILL_AMT{i}"))
    for i in range(1, 7):
        cols.append(F.round(F.coalesce(F.col(f"paid{i}"), zero) * tenth, 2).cast("double").alias(f"PAY_AMT{i}"))
    cols.append(
        F.when(uniform(key, "|y") < F.lit(0.30) + F.lit(0.08) * pay[0].cast("double"), 1).otherwise(0).cast("int").alias("DEFAULT")
    )
    return j.select(*cols)


def scores(spark: SparkSession, sf_dir: str, attributes: bool = True) -> DataFrame:
    """Long score table ``(run, split, row_id, y_true, y_prob, y_pred)`` over lineitem.

    With ``attributes`` the order priority is joined in (one sort-merge join
    on the order key) together with the line attributes and a rare flag.
    """
    li = table(spark, sf_dir, "lineitem")
    rid = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("|"), F.col("l_partkey").cast("string"), F.lit("|"),
        F.col("l_suppkey").cast("string"), F.lit("|"), F.col("l_linenumber").cast("string"), F.lit("|"),
        F.col("l_quantity").cast("int").cast("string"),
    )
    base = li.select(
        rid.alias("row_id"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("y_true"),
        "l_linestatus", "l_linenumber", "l_orderkey",
    )
    # split and rare flag depend on the line only: hash them once per line,
    # before the per-run explode
    base = base.withColumn("split", F.when(uniform(F.col("row_id"), "|split") < 0.5, "val").otherwise("test"))
    if attributes:
        base = base.withColumn("rare", F.when(uniform(F.col("row_id"), "|rare") < 0.0005, 1).otherwise(0).cast("int"))
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
        base = base.join(o, base.l_orderkey == o.o_orderkey, "inner").drop("o_orderkey")
    runs = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(k).alias("k")) for r, k in RUN_SIGNAL])
    x = base.withColumn("_r", F.explode(runs))
    prob = F.least(
        F.lit(0.99),
        F.greatest(
            F.lit(0.01),
            F.round(F.lit(0.25) + F.col("_r.k") * F.col("y_true") + F.lit(0.5) * (uniform(F.col("row_id"), "|", F.col("_r.run")) - 0.5), 6),
        ),
    )
    out = x.select(
        F.col("_r.run").alias("run"), "split", "row_id", "y_true", prob.alias("y_prob"),
        *(["l_linestatus", "l_linenumber", "o_orderpriority", "o_custkey", "rare"] if attributes else []),
    )
    return out.withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int"))


def mc_samples(spark: SparkSession, sf_dir: str, n_samples: int = 30) -> DataFrame:
    """``(row_id, t, p)``: ``n_samples`` stochastic predictions per customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    key = F.col("c_custkey").cast("string")
    x = c.withColumn("_m", uniform(key, "|m")).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))  # hashed once for each customer
    p = F.least(
        F.lit(0.99),
        F.greatest(
            F.lit(0.01),
            F.lit(0.5) + F.lit(0.4) * (F.col("_m") - 0.5) * 2 + F.lit(0.2) * (uniform(key, "|", F.col("t").cast("string"), "|mc") - 0.5),
        ),
    )
    return x.select(F.col("c_custkey").alias("row_id"), F.col("t").cast("int").alias("t"), p.alias("p"))


def attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(layer, row_id, head, i, j, w)``: 64-dim embeddings read as 8x8
    score grids per (layer, head), softmax-normalised along j.

    The normalisation is an array fold per (row, layer, head, i): no shuffle.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    cell = e.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(31))))
    lh = (F.col("c") / 8).cast("int")
    i = F.col("c") % 8
    xs = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda j: F.exp(F.element_at(F.col("embedding"), (i * 8 + j + F.lit(7) * lh) % 64 + 1).cast("double")),
    )
    rows = cell.select(
        F.col("vec_id").alias("row_id"),
        (lh / 2).cast("int").alias("layer"),
        (lh % 2).cast("int").alias("head"),
        i.cast("int").alias("i"),
        xs.alias("xs"),
    ).withColumn("den", F.aggregate("xs", F.lit(0.0), lambda a, v: a + v))
    return rows.select(
        "layer", "row_id", "head", "i", F.posexplode("xs").alias("j", "x"), "den"
    ).select("layer", "row_id", "head", "i", F.col("j").cast("int").alias("j"), (F.col("x") / F.col("den")).alias("w"))


def attention_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), (F.col("label") >= 5).cast("int").alias("y")
    )


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second real label set: ``labels`` joined to ``documents`` (quality x lang)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "inner")
