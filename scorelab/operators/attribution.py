"""Attention attribution (L1-L7) over long attention rows
``(layer, row_id, head, i, j, w)``.

Matrix products are joins on the inner index within a row (bounded: seq_len
cells per key), aggregated per (row_id, i, j); no matrix leaves Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CLS = 0


def head_mean(attn: DataFrame) -> DataFrame:
    return attn.groupBy("layer", "row_id", "i", "j").agg(F.avg("w").alias("a"))


def attention_rollout(attn: DataFrame, n_layers: int) -> DataFrame:
    """L1: R = A_0; R = A_l R for l >= 1 with A_l = 0.5 * head-mean + 0.5 * I."""
    hm = head_mean(attn)
    aug = hm.withColumn("a", F.lit(0.5) * F.col("a") + F.when(F.col("i") == F.col("j"), F.lit(0.5)).otherwise(F.lit(0.0)))
    r = aug.where(F.col("layer") == 0).select("row_id", "i", "j", F.col("a").alias("r"))
    for layer in range(1, n_layers):
        a = aug.where(F.col("layer") == layer).select("row_id", "i", F.col("j").alias("k"), "a")
        rr = r.select("row_id", F.col("i").alias("k"), "j", "r")
        r = a.join(rr, ["row_id", "k"]).groupBy("row_id", "i", "j").agg(F.sum(F.col("a") * F.col("r")).alias("r"))
    return r


def cls_scores(rollout: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """L2: mean rollout, CLS row, self cell dropped, renormalised to sum to 1."""
    m = rollout.where((F.col("i") == CLS) & (F.col("j") != CLS)).groupBy("j").agg(F.avg("r").alias("m"))
    tot = F.sum("m").over(Window.partitionBy())  # seq_len - 1 rows
    return m.select("j", F.when(tot > 0, F.col("m") / tot).otherwise(F.col("m")).alias("score"))


def rollout_by_class(rollout: DataFrame, labels: DataFrame, label: str = "y") -> DataFrame:
    """L3: mean rollout per class and the difference (class 1 - class 0);
    raises when a class is absent."""
    j = rollout.join(labels, "row_id")
    g = j.groupBy("i", "j").agg(F.avg(F.when(F.col(label) == 1, F.col("r"))).alias("mean_1"), F.avg(F.when(F.col(label) == 0, F.col("r"))).alias("mean_0"))
    chk = F.when(F.col("mean_1").isNull() | F.col("mean_0").isNull(), F.raise_error(F.lit("Need at least one sample in each class."))).otherwise(F.col("mean_1") - F.col("mean_0"))
    return g.withColumn("diff", chk)


def head_entropy(attn: DataFrame, eps: float = 1e-12) -> DataFrame:
    """L4: CLS-row attention entropy per (layer, head), averaged over rows."""
    e = attn.where(F.col("i") == CLS).groupBy("layer", "head", "row_id").agg(F.sum(-F.col("w") * F.log(F.col("w") + F.lit(eps))).alias("h"))
    return e.groupBy("layer", "head").agg(F.avg("h").alias("entropy"))


def mean_attention(attn: DataFrame) -> DataFrame:
    """Mean attention map per (layer, head, i, j)."""
    return attn.groupBy("layer", "head", "i", "j").agg(F.avg("w").alias("mean_w"))


def mean_rollout(rollout: DataFrame) -> DataFrame:
    """Mean rollout over all rows, a cell for each (i, j)."""
    return rollout.groupBy("i", "j").agg(F.avg("r").alias("mean_r"))


def compare_importance(a: DataFrame, b: DataFrame, a_col: str, b_col: str, key: str = "feature") -> DataFrame:
    """Inner join on the shared features, rank under each measure and the rank gap."""
    j = a.select(key, a_col).join(b.select(key, b_col), key)
    w = Window.partitionBy()  # one row per shared feature
    return j.withColumns({"rank_a": F.rank().over(w.orderBy(F.desc(F.round(a_col, 9)), key)).cast("int"),
                          "rank_b": F.rank().over(w.orderBy(F.desc(F.round(b_col, 9)), key)).cast("int")}).withColumn(
        "rank_gap", F.col("rank_a") - F.col("rank_b"))


def group_attention(attn: DataFrame, layout: DataFrame, layer: int) -> DataFrame:
    """Final-layer CLS attention (heads and rows averaged) summed per
    feature group of the token layout, with ranks."""
    cls = attn.where((F.col("layer") == layer) & (F.col("i") == CLS) & (F.col("j") != CLS)).groupBy("j").agg(F.avg("w").alias("w"))
    j = cls.join(F.broadcast(layout.select(F.col("pos").alias("j"), "group_name")), "j")  # 24-row layout
    g = j.groupBy("group_name").agg(F.sum("w").alias("attention"), F.count(F.lit(1)).alias("n_tokens"))
    return g.withColumn("rank", F.rank().over(Window.partitionBy().orderBy(F.desc(F.round("attention", 9)), "group_name")).cast("int"))
