"""Scaling, vocabularies and token encoding.

Fit steps are one aggregate over the training rows and return small
parameter DataFrames (one row per column or per code); apply steps are
projections or broadcast joins against those bounded tables, so they also
run on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import uniform
from .clean import melt

# PAY status states.
PAY_STATE_NO_BILL, PAY_STATE_PAID_FULL, PAY_STATE_MINIMUM, PAY_STATE_DELINQUENT = 0, 1, 2, 3
MAX_PAY_DELAY = 8
#: Most categorical codes that a broadcast row may hold.
MAX_CODES = 100_000


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, std) with population std; a zero std becomes 1."""
    g = melt(train, cols).groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("_s"))
    return g.select("feature", "mean", F.when(F.col("_s") == 0, F.lit(1.0)).otherwise(F.col("_s")).alias("std"))


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str]) -> DataFrame:
    """D3: (x - mean) / std for the listed columns; other columns pass through.
    ``params`` has one row per column; it is pivoted to one row and joined
    on a constant key with a broadcast (a fixed-size parameter table)."""
    wide = params.groupBy().pivot("feature", cols).agg(F.first("mean").alias("m"), F.first("std").alias("s"))
    wide = wide.select(*[F.col(f"{c}_m").alias(f"__m_{c}") for c in cols], *[F.col(f"{c}_s").alias(f"__s_{c}") for c in cols]).withColumn("__k", F.lit(1))
    j = df.withColumn("__k", F.lit(1)).join(F.broadcast(wide), "__k")
    out = j.withColumns({c: (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}") for c in cols})
    return out.drop("__k", *[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def build_vocab(train: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, idx) with codes sorted numerically, idx from 0."""
    from pyspark.sql import Window

    d = melt(train, cols).select("feature", F.col("value").cast("long").alias("value")).distinct()
    return d.withColumn("idx", (F.dense_rank().over(Window.partitionBy("feature").orderBy("value")) - 1).cast("int"))  # one row per code


def numeric_metadata(train: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample std, min, max per numeric column."""
    return melt(train, cols).groupBy("feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                                    F.min("value").alias("min"), F.max("value").alias("max"))


def encode_pay(c, strict: bool = True):
    """(state, severity, raw + 2) for one PAY column; out of [-2, 8] raises (strict) or gives NULLs."""
    x = F.col(c) if isinstance(c, str) else c
    bad = (x < -2) | (x > MAX_PAY_DELAY)
    state = (F.when(x == -2, PAY_STATE_NO_BILL).when(x == -1, PAY_STATE_PAID_FULL).when(x == 0, PAY_STATE_MINIMUM)
             .otherwise(PAY_STATE_DELINQUENT))
    sev = F.when(x > 0, x.cast("double") / F.lit(float(MAX_PAY_DELAY))).otherwise(F.lit(0.0))
    guard = F.raise_error(F.concat(F.lit("PAY value "), x.cast("string"), F.lit(f" outside valid range [-2, {MAX_PAY_DELAY}]"))) if strict else F.lit(None)
    return (F.when(bad, guard.cast("int")).otherwise(state).cast("int"), F.when(bad, F.lit(None)).otherwise(sev), F.when(bad, F.lit(None)).otherwise(x + 2).cast("int"))


def tokenise(df: DataFrame, vocab: DataFrame, key: str = "row_id", target: str = S.TARGET) -> DataFrame:
    """Nested token record per row: cat_indices[3], pay_state_ids[6],
    pay_severities[6], pay_raw[6], num_values[14], label. A categorical code
    missing from the vocabulary raises, naming the feature and value.

    The vocabulary becomes one row that holds a map (at most ``MAX_CODES``
    codes, else it raises); with that row broadcast, the whole step is a
    projection of each row."""
    place = lambda feature, value: F.concat(feature, F.lit("="), value.cast("long").cast("string"))
    codes = vocab.where(F.col("feature").isin(S.CATEGORICAL)).limit(MAX_CODES + 1).groupBy().agg(
        F.count(F.lit(1)).alias("_n"), F.map_from_entries(F.collect_list(F.struct(place(F.col("feature"), F.col("value")), "idx"))).alias("_map"))
    codes = codes.select(F.when(F.col("_n") > MAX_CODES, F.raise_error(F.lit(f"more than {MAX_CODES} codes"))).otherwise(F.col("_map")).alias("_map"), F.lit(1).alias("_k"))

    def code(c: str):
        at = place(F.lit(c), F.col(c))
        return F.coalesce(F.col("_map")[at], F.raise_error(F.concat(F.lit("no code for "), F.coalesce(at, F.lit(f"{c}=null")))).cast("int"))

    df = df.withColumn("_k", F.lit(1)).join(F.broadcast(codes), "_k")  # one row
    enc = [encode_pay(p) for p in S.PAY_STATUS]
    return df.select(
        key,
        F.array(*[code(c) for c in S.CATEGORICAL]).alias("cat_indices"),
        F.array(*[e[0] for e in enc]).alias("pay_state_ids"),
        F.array(*[e[1].cast("float") for e in enc]).alias("pay_severities"),
        F.array(*[e[2] for e in enc]).alias("pay_raw"),
        F.array(*[F.col(c).cast("float") for c in S.NUMERICAL]).alias("num_values"),
        F.col(target).cast("long").alias("label"),
    )


def tokenise_summary(tokens: DataFrame) -> DataFrame:
    """Counts per categorical index and per PAY state, severity range."""
    cat = tokens.select(F.posexplode("cat_indices").alias("slot", "idx")).groupBy("slot", "idx").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("cat_index").alias("kind"), F.col("slot").cast("int").alias("slot"), F.col("idx").cast("int").alias("code"), "n")
    st = tokens.select(F.posexplode("pay_state_ids").alias("slot", "s")).groupBy("slot", "s").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("pay_state").alias("kind"), F.col("slot").cast("int").alias("slot"), F.col("s").cast("int").alias("code"), "n")
    return cat.unionByName(st)


def token_value_ranges(tokens: DataFrame) -> DataFrame:
    """Min, max and mean of the severities and of each numeric value, one row per (kind, slot)."""
    both = [tokens.select(F.lit(kind).alias("kind"), F.posexplode(col).alias("slot", "v")) for kind, col in (("severity", "pay_severities"), ("numeric", "num_values"))]
    v = F.col("v").cast("double")
    return both[0].unionByName(both[1]).groupBy("kind", "slot").agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"))


def mask_tokens(tokens: DataFrame, p: float = 0.15, min_mask: int = 1, max_mask: int = 23, seed: int = 0,
                mask_frac: float = 0.8, random_frac: float = 0.1, n_tokens: int = 23, key: str = "row_id") -> DataFrame:
    """Per row, Bernoulli(p) token selection from hash draws, topped up
    to ``min_mask`` (lowest secondary draw among unselected) and trimmed to
    ``max_mask`` (lowest secondary draw kept), then 80/10/10 replace modes
    (0 mask, 1 random, 2 keep; -1 not selected). Array operations only: no
    shuffle, one output row per input row."""
    k = F.col(key).cast("string")
    draw = lambda i, tag: uniform(k, F.lit("|"), i.cast("string"), f"|{seed}|{tag}")
    first = F.array(*[uniform(k, f"|{i}|{seed}|sel") for i in range(n_tokens)])
    x = tokens.select(key, first.alias("_u"))
    at = F.sequence(F.lit(0), F.lit(n_tokens - 1))
    x = x.withColumns({"_s": F.filter(at, lambda i: F.get("_u", i) < F.lit(p)), "_r": F.filter(at, lambda i: F.get("_u", i) >= F.lit(p))})
    # the second draw is made for the rows that are topped up or trimmed, the third for selected tokens
    lowest = lambda c, n: F.transform(F.slice(F.array_sort(F.transform(c, lambda i: F.struct(draw(i, "pick").alias("v"), i.alias("pos")))), 1, n), lambda t: t["pos"])
    cnt = F.size("_s")
    chosen = F.when(cnt < min_mask, F.concat(F.slice("_s", 1, max_mask), lowest(F.col("_r"), F.lit(min_mask) - cnt))).when(cnt > max_mask, lowest(F.col("_s"), F.lit(max_mask))).otherwise(F.col("_s"))
    x = x.select(key, chosen.alias("_c"))
    selected = F.transform(at, lambda i: F.array_contains("_c", i))

    def replaced(i):
        w = draw(i, "mode")
        return F.when(w < F.lit(mask_frac), F.lit(0)).when(w < F.lit(mask_frac + random_frac), F.lit(1)).otherwise(F.lit(2))

    mode = F.transform(at, lambda i: F.when(~F.array_contains("_c", i), F.lit(-1)).otherwise(replaced(i)))
    return x.select(key, selected.alias("mask_positions"), mode.alias("replace_mode"))


def token_layout_df(spark) -> DataFrame:
    """The 24-row token layout dimension (pos, feature, group, month)."""
    return spark.createDataFrame(S.token_layout(), "pos int, feature string, group_id int, group_name string, month int")


def token_layout_counts(df: DataFrame) -> DataFrame:
    """D16 over a table: the layout with each position's number of tokens
    (rows with a value; the leading position has one for every row)."""
    features = [f for _, f, *_ in S.token_layout() if f in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("CLS"), *[F.count(c).alias(c) for c in features])
    counts = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_tokens")) for c in ["CLS", *features]])).alias("r")).select("r.*")
    return token_layout_df(df.sparkSession).join(counts, "feature")  # 24 rows each


def feature_variance(train: DataFrame, cols: list[str]) -> DataFrame:
    """Population variance per numeric column on the training rows; 0 -> 1."""
    g = melt(train, cols).groupBy("feature").agg(F.var_pop("value").alias("_v"))
    return g.select("feature", F.when(F.col("_v") == 0, F.lit(1.0)).otherwise(F.col("_v")).alias("variance"))
