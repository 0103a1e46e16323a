"""Splits, sampling, folds and batches.

Every random choice is a hash of (row key, seed), so results are
reproducible across partitionings and executor losses. Ranks within a class
come from the distributed prefix-sum primitive, never a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import hash_order
from ..functions.ranks import prefix_sums


def _class_rank(df: DataFrame, target: str, key: str, seed: int, tag: str = "") -> DataFrame:
    """Adds ``_rank`` (1-based position within the class in hash order) and ``_n_class``."""
    x = df.withColumns({"_h": hash_order(F.col(key).cast("string"), f"|{seed}{tag}"), "_one": F.lit(1)})
    r = prefix_sums(x, [target], "_h", ["_one"], tiebreak=[key], value_range=(0.0, float(2 ** 60)))
    return r.withColumnRenamed("cum__one", "_rank").withColumnRenamed("tot__one", "_n_class").drop("_h", "_one")


def stratified_split(df: DataFrame, target: str = S.TARGET, test: float = 0.15, val: float = 0.15, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Adds ``split`` in {train, val, test} with exact per-class counts:
    n_test = round_half_even(n_c * test), n_val = round_half_even((n_c - n_test) * val / (1 - test)).
    The split is a function of (key, seed) only, so the raw and engineered
    tables get the same rows."""
    r = _class_rank(df, target, key, seed)
    n_test = F.bround(F.col("_n_class") * F.lit(test), 0)
    n_val = F.bround((F.col("_n_class") - n_test) * F.lit(val / (1.0 - test)), 0)
    split = F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_test + n_val, "val").otherwise("train")
    return r.withColumn("split", split).drop("_rank", "_n_class")


def assign_batches(df: DataFrame, batch_size: int, target: str = S.TARGET, drop_last: bool = True, seed: int = 0, key: str = "row_id") -> DataFrame:
    """Stratified batches. k_pos = max(1, round_half_even(bs * pos_rate)),
    k_neg = bs - k_pos, full batches = min(pos // k_pos, neg // k_neg); rows
    beyond form one residual batch unless ``drop_last`` (then batch NULL)."""
    r = _class_rank(df, target, key, seed, "|batch")
    counts = r.groupBy().agg(
        F.sum(F.when(F.col(target) == 1, 1).otherwise(0)).alias("_np"), F.count(F.lit(1)).alias("_nn")
    )
    kp = F.greatest(F.lit(1), F.bround(F.lit(float(batch_size)) * F.col("_np") / F.col("_nn"), 0).cast("long"))
    c = counts.select(
        kp.alias("_kp"), (F.lit(batch_size) - kp).alias("_kn"), "_np", (F.col("_nn") - F.col("_np")).alias("_nneg")
    ).withColumn("_nb", F.least(F.floor(F.col("_np") / F.col("_kp")), F.floor(F.col("_nneg") / F.col("_kn")))).select(
        F.when((F.col("_np") == 0) | (F.col("_nneg") == 0), F.raise_error(F.lit("assign_batches requires both classes")))
        .when(F.col("_kn") <= 0, F.raise_error(F.lit("derived k_neg is non-positive; increase batch_size")))
        .otherwise(F.col("_kp")).alias("_kp"), "_kn", "_nb",
    )
    j = r.withColumn("__k", F.lit(1)).join(F.broadcast(c.withColumn("__k", F.lit(1))), "__k").drop("__k")  # one-row parameter table
    k = F.when(F.col(target) == 1, F.col("_kp")).otherwise(F.col("_kn"))
    b = F.floor((F.col("_rank") - 1) / k)
    batch = F.when(b < F.col("_nb"), b).otherwise(F.lit(None) if drop_last else F.col("_nb"))
    return j.withColumn("batch", batch.cast("long")).drop("_rank", "_n_class", "_kp", "_kn", "_nb")


def stratified_sample(df: DataFrame, target: str = S.TARGET, n: int | None = None, fraction: float | None = None, seed: int = 0, key: str = "row_id") -> DataFrame:
    """The first n (or round_half_even(fraction * n_c)) rows of each class in hash order."""
    r = _class_rank(df, target, key, seed, "|sample")
    lim = F.lit(n) if n is not None else F.bround(F.col("_n_class") * F.lit(fraction), 0)
    return r.where(F.col("_rank") <= lim).drop("_rank", "_n_class")


def sample_n(df: DataFrame, n: int, seed: int = 0, key: str = "row_id") -> DataFrame:
    """N rows in hash order. A top-n by a hash key: each task keeps n
    candidates, so only n * tasks rows reach the final merge."""
    return df.withColumn("_h", hash_order(F.col(key).cast("string"), f"|{seed}|n")).orderBy("_h", key).limit(n).drop("_h")


def stratified_folds(df: DataFrame, k: int, target: str = S.TARGET, seed: int = 0, key: str = "row_id") -> DataFrame:
    """fold = (rank within class - 1) mod k, ranks in hash order."""
    r = _class_rank(df, target, key, seed, "|fold")
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n_class")


def derive_seed(*parts) -> Column:
    """First 4 bytes of sha256('|'.join(parts)) as an unsigned int."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 8), 16, 10).cast("long")
