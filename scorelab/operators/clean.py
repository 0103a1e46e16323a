"""Cleaning, validation and data-quality profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.columns import count_if
from ..functions.ranks import exact_quantiles

# Undocumented codes and the bucket they fold into.
EDUCATION_UNDOCUMENTED = [0, 5, 6]
EDUCATION_OTHERS = 4
MARRIAGE_UNDOCUMENTED = [0]
MARRIAGE_OTHERS = 3


def clean_categoricals(df: DataFrame) -> DataFrame:
    """B1: fold EDUCATION {0,5,6} -> 4 and MARRIAGE 0 -> 3 (a projection)."""
    return df.withColumns(
        {
            "EDUCATION": F.when(F.col("EDUCATION").isin(EDUCATION_UNDOCUMENTED), F.lit(EDUCATION_OTHERS))
            .otherwise(F.col("EDUCATION")).cast("int"),
            "MARRIAGE": F.when(F.col("MARRIAGE").isin(MARRIAGE_UNDOCUMENTED), F.lit(MARRIAGE_OTHERS))
            .otherwise(F.col("MARRIAGE")).cast("int"),
        }
    )


def clean_report(df: DataFrame) -> DataFrame:
    """B1 report: (feature, value, n_before, n_after) for EDUCATION and MARRIAGE.

    One pass: each row contributes its raw code and its cleaned code.
    """
    both = df.select("EDUCATION", "MARRIAGE").withColumns(
        {
            "e2": F.when(F.col("EDUCATION").isin(EDUCATION_UNDOCUMENTED), F.lit(EDUCATION_OTHERS)).otherwise(F.col("EDUCATION")),
            "m2": F.when(F.col("MARRIAGE").isin(MARRIAGE_UNDOCUMENTED), F.lit(MARRIAGE_OTHERS)).otherwise(F.col("MARRIAGE")),
        }
    )
    ev = F.array(
        F.struct(F.lit("EDUCATION").alias("feature"), F.col("EDUCATION").alias("value"), F.lit(1).alias("b"), F.lit(0).alias("a")),
        F.struct(F.lit("EDUCATION").alias("feature"), F.col("e2").alias("value"), F.lit(0).alias("b"), F.lit(1).alias("a")),
        F.struct(F.lit("MARRIAGE").alias("feature"), F.col("MARRIAGE").alias("value"), F.lit(1).alias("b"), F.lit(0).alias("a")),
        F.struct(F.lit("MARRIAGE").alias("feature"), F.col("m2").alias("value"), F.lit(0).alias("b"), F.lit(1).alias("a")),
    )
    x = both.select(F.explode(ev).alias("e")).select("e.*")
    return x.groupBy("feature", F.col("value").cast("int").alias("value")).agg(
        F.sum("b").cast("long").alias("n_before"), F.sum("a").cast("long").alias("n_after")
    )


def drop_exact_duplicates(df: DataFrame, key: str = "row_id", cols: list[str] | None = None) -> DataFrame:
    """B2: keep one row per identical content, the one with the smallest key."""
    cols = cols or [c for c in df.columns if c != key]
    return df.groupBy(*cols).agg(F.min(key).alias(key)).select(key, *cols)


def duplicate_summary(df: DataFrame, target: str = S.TARGET, key: str = "row_id") -> DataFrame:
    """Rows, rows in duplicate groups (all copies), extra copies,
    target rate among duplicates and overall. Groups are counted, never
    materialised."""
    cols = [c for c in df.columns if c != key]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    dup = F.col("_c") > 1
    return g.agg(
        F.sum("_c").cast("long").alias("n_rows"),
        F.sum(F.when(dup, F.col("_c")).otherwise(0)).cast("long").alias("n_in_dup_groups"),
        F.sum(F.when(dup, F.col("_c") - 1).otherwise(0)).cast("long").alias("n_extra_copies"),
        (F.sum(F.when(dup, F.col("_c") * F.col(target))) / F.sum(F.when(dup, F.col("_c")))).alias("target_rate_dup"),
        (F.sum(F.col("_c") * F.col(target)) / F.sum("_c")).alias("target_rate_all"),
    )


def duplicate_feature_ratio(df: DataFrame, features: list[str], key: str = "row_id") -> DataFrame:
    """Mean of each feature among duplicated rows / overall mean (inf guard -> NULL)."""
    cols = [c for c in df.columns if c != key]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    dup = F.col("_c") > 1
    aggs = []
    for f in features:
        aggs += [
            (F.sum(F.when(dup, F.col("_c") * F.col(f))) / F.sum(F.when(dup, F.col("_c")))).alias(f"d_{f}"),
            (F.sum(F.col("_c") * F.col(f)) / F.sum("_c")).alias(f"a_{f}"),
        ]
    one = g.agg(*aggs)
    st = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"d_{f}").alias("mean_dup"), F.col(f"a_{f}").alias("mean_all")) for f in features]))
    return one.select(st.alias("s")).select("s.*").withColumn(
        "ratio", F.when(F.col("mean_all") != 0, F.col("mean_dup") / F.col("mean_all"))
    )


def validate(df: DataFrame, target: str = S.TARGET, key: str = "row_id") -> DataFrame:
    """One aggregate pass, reshaped to (check, column, n, is_issue)."""
    cols = [c for c in df.columns if c != key]
    checks: list[tuple[str, str | None, object, bool]] = [
        ("n_rows", None, F.count(F.lit(1)), True),
    ]
    for c in cols:
        checks.append(("missing", c, count_if(F.col(c).isNull()), True))
    checks.append(("invalid_domain", "SEX", count_if(~F.col("SEX").isin(S.VALID_SEX)), True))
    checks.append(("invalid_domain", "EDUCATION", count_if(~F.col("EDUCATION").isin(S.VALID_EDUCATION)), True))
    checks.append(("invalid_domain", "MARRIAGE", count_if(~F.col("MARRIAGE").isin(S.VALID_MARRIAGE)), True))
    for c in S.PAY_STATUS:
        checks.append(("invalid_domain", c, count_if(~F.col(c).isin(S.VALID_PAY)), True))
    checks.append(("non_positive", "LIMIT_BAL", count_if(F.col("LIMIT_BAL") <= 0), True))
    checks.append(("out_of_range", "AGE", count_if((F.col("AGE") < 18) | (F.col("AGE") > 100)), True))
    checks.append(("non_binary", target, count_if(~F.col(target).isin(0, 1)), True))
    checks.append(("target_0", target, count_if(F.col(target) == 0), False))
    checks.append(("target_1", target, count_if(F.col(target) == 1), False))
    for c in S.BILL_AMT:
        checks.append(("negative_count", c, count_if(F.col(c) < 0), False))
    one = df.agg(*[e.cast("long").alias(f"c{i}") for i, (_, _, e, _) in enumerate(checks)])
    dups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.sum(F.col("_c") - 1).cast("long").alias("n")
    ).select(F.lit("duplicated_rows").alias("check"), F.lit(None).cast("string").alias("column"), "n", F.lit(True).alias("flag"))
    st = F.explode(
        F.array(
            *[
                F.struct(F.lit(ch).alias("check"), F.lit(c).cast("string").alias("column"), F.col(f"c{i}").alias("n"), F.lit(flag).alias("flag"))
                for i, (ch, c, _, flag) in enumerate(checks)
            ]
        )
    )
    long = one.select(st.alias("s")).select("s.*").unionByName(dups)
    return long.select("check", "column", "n", ((F.col("flag")) & (F.col("n") > 0) & (F.col("check") != "n_rows")).alias("is_issue"))


def invalid_values(df: DataFrame) -> DataFrame:
    """The offending values, (check, column, value, n): PAY codes outside
    their domain and categorical values that are no integers."""
    kinds = [("invalid_pay", c) for c in S.PAY_STATUS if c in df.columns] + [("non_integer", c) for c in S.CATEGORICAL if c in df.columns]

    def bad(kind: str, c: str):
        x = F.col(c).cast("double")
        wrong = ~F.col(c).isin(S.VALID_PAY) if kind == "invalid_pay" else x != F.floor(x)
        return F.when(wrong, F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column"), x.alias("value")))

    found = df.select(F.explode(F.array(*[bad(k, c) for k, c in kinds])).alias("r")).where("r is not null")
    return found.select("r.*").groupBy("check", "column", "value").agg(F.count(F.lit(1)).alias("n"))


def require_valid(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """B4, strict: the table itself if nothing is wrong, else a ValueError that
    names the failed checks and the offending values. Two jobs run here."""
    failed = validate_schema(df, required).where("n != 0").collect()  # one row for each check and column
    if failed:
        values = invalid_values(df).orderBy(F.desc("n"), "check", "column", "value").limit(20).collect()
        raise ValueError(f"not ready to encode: {[tuple(r) for r in failed]}; most frequent offending values: {[tuple(r) for r in values]}")
    return df


def validate_schema(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Encode-readiness as (check, column, n): missing columns (n = -1),
    null counts, invalid PAY codes, non-integer categorical values."""
    required = required or S.FEATURES
    missing = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    aggs = []
    meta = []
    for c in present:
        aggs.append(count_if(F.col(c).isNull()).alias(f"null_{c}"))
        meta.append(("null_values", c, f"null_{c}"))
    for c in [c for c in S.PAY_STATUS if c in present]:
        aggs.append(count_if(~F.col(c).isin(S.VALID_PAY)).alias(f"pay_{c}"))
        meta.append(("invalid_pay", c, f"pay_{c}"))
    for c in [c for c in S.CATEGORICAL if c in present]:
        aggs.append(count_if(F.col(c).cast("double") != F.floor(F.col(c).cast("double"))).alias(f"int_{c}"))
        meta.append(("non_integer", c, f"int_{c}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(ch).alias("check"), F.lit(c).alias("column"), F.col(a).cast("long").alias("n")) for ch, c, a in meta]
    rows += [F.struct(F.lit("missing_column").alias("check"), F.lit(c).alias("column"), F.lit(-1).cast("long").alias("n")) for c in missing]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Quartiles (linear interpolation), fences and outlier counts per column."""
    long = melt(df, cols)
    q = exact_quantiles(long, ["feature"], "value", [0.25, 0.75])
    b = q.groupBy("feature").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    b = b.withColumns({"lo": F.col("q1") - F.lit(k) * F.col("iqr"), "hi": F.col("q3") + F.lit(k) * F.col("iqr")})
    j = long.join(b, "feature")
    return j.groupBy("feature", "q1", "q3", "iqr", "lo", "hi").agg(
        count_if((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))).alias("n_outliers"),
        F.count(F.lit(1)).cast("long").alias("n"),
    ).withColumn("pct_outliers", F.lit(100.0) * F.col("n_outliers") / F.col("n"))


def fit_winsor(df: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """B8 fit: (feature, lo, hi) percentiles on the given (training) rows."""
    q = exact_quantiles(melt(df, cols), ["feature"], "value", [lower, upper])
    return q.groupBy("feature").agg(
        F.max(F.when(F.col("q") == lower, F.col("value"))).alias("lo"),
        F.max(F.when(F.col("q") == upper, F.col("value"))).alias("hi"),
    )


def apply_winsor(df: DataFrame, bounds: DataFrame, cols: list[str]) -> DataFrame:
    """B8 apply: clip each column to its bounds. ``bounds`` has one row per
    column (a fixed-size table) and is pivoted into one row and joined on a
    constant key, so the apply step is a broadcast projection and also runs
    on streaming DataFrames."""
    wide = bounds.groupBy().pivot("feature", cols).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    wide = wide.select(*[F.col(f"{c}_lo").alias(f"__lo_{c}") for c in cols], *[F.col(f"{c}_hi").alias(f"__hi_{c}") for c in cols])
    j = df.join(F.broadcast(wide.withColumn("__k", F.lit(1))), F.lit(1) == F.col("__k"), "inner")
    out = j.withColumns({c: F.least(F.greatest(F.col(c), F.col(f"__lo_{c}")), F.col(f"__hi_{c}")) for c in cols})
    return out.drop("__k", *[f"__lo_{c}" for c in cols], *[f"__hi_{c}" for c in cols])


def winsor_report(df: DataFrame, bounds: DataFrame, cols: list[str]) -> DataFrame:
    """Number of values clipped below / above per column."""
    long = melt(df, cols).join(bounds, "feature")
    return long.groupBy("feature").agg(
        count_if(F.col("value") < F.col("lo")).alias("n_low"),
        count_if(F.col("value") > F.col("hi")).alias("n_high"),
    )


def signed_log1p(c) -> "F.Column":
    """sign(x) * log1p(|x|)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.signum(c) * F.log1p(F.abs(c))


def sample_skew(x: "F.Column") -> "F.Column":
    """Bias-corrected sample skewness G1 from Spark's population g1."""
    n = F.count(x).cast("double")
    return F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)


def sample_kurtosis(x: "F.Column") -> "F.Column":
    """Bias-corrected excess kurtosis G2 from Spark's population g2."""
    n = F.count(x).cast("double")
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)


def log_effect(df: DataFrame, cols: list[str]) -> DataFrame:
    """Skewness before and after the signed log transform, per column."""
    long = melt(df, cols)
    return long.groupBy("feature").agg(
        sample_skew(F.col("value")).alias("skew_before"),
        sample_skew(signed_log1p("value")).alias("skew_after"),
    )


def range_audit(df: DataFrame, cols: list[str], target: str = S.TARGET) -> DataFrame:
    """Distinct codes (sorted, comma-joined), min, max and target rate per column."""
    long = melt(df, cols, keep=[target])
    # one row for each code: the list is as long as the column's domain
    codes = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("double")).alias("t"))
    return codes.groupBy("feature").agg(
        F.count("value").cast("long").alias("n_distinct"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.sum("t") / F.sum("n")).alias("target_rate"),
        F.array_join(F.transform(F.array_sort(F.collect_list("value")), lambda v: v.cast("long").cast("string")), ",").alias("codes"),
    )


def melt(df: DataFrame, cols: list[str], keep: list[str] | None = None, name: str = "feature", value: str = "value") -> DataFrame:
    """Wide -> long (feature, value) as doubles via a generator (no shuffle)."""
    keep = keep or []
    arr = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*keep, F.explode(arr).alias("_kv")).select(*keep, f"_kv.{name}", f"_kv.{value}")


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
