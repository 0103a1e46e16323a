"""Reproducibility and drift checks (M1-M7): every check is a join or an
aggregate that returns a small report table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _numeric(dt) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType))


def table_diff(a: DataFrame, b: DataFrame, keys: list[str], rtol: float = 1e-4, atol: float = 1e-6) -> DataFrame:
    """M1: per column, rows that differ beyond |a-b| <= atol + rtol |b| (NaN
    equals NaN; strings compared exactly), plus rows present on one side only.
    A column of one side alone counts all that side's rows as mismatches; a
    different order of the shared columns is one mismatch of ``<column_order>``."""
    lone = [(side, c) for side, x, y in (("left", a, b), ("right", b, a)) for c in x.columns if c not in keys and c not in y.columns]
    cols = [c for c in a.columns if c not in keys and c in b.columns]
    j = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(1).alias("_in_a")).join(
        b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(1).alias("_in_b")), keys, "full_outer")
    types = {f.name: f.dataType for f in a.schema.fields}
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    aggs = [F.sum(F.when(F.col("_in_b").isNull(), 1).otherwise(0)).alias("_only_a"), F.sum(F.when(F.col("_in_a").isNull(), 1).otherwise(0)).alias("_only_b")]
    for c in cols:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        if _numeric(types[c]):
            xd, yd = x.cast("double"), y.cast("double")
            same = (xd.isNull() & yd.isNull()) | (F.isnan(xd) & F.isnan(yd)) | (F.abs(xd - yd) <= F.lit(atol) + F.lit(rtol) * F.abs(yd))
        else:
            same = x.eqNullSafe(y)
        aggs.append(F.sum(F.when(both & ~F.coalesce(same, F.lit(False)), 1).otherwise(0)).alias(f"m_{c}"))
    aggs += [F.count("_in_a").alias("_n_left"), F.count("_in_b").alias("_n_right")]
    one = j.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").cast("long").alias("n_mismatch")) for c in cols]
    rows += [F.struct(F.lit("<only_left>").alias("column"), F.col("_only_a").cast("long").alias("n_mismatch")),
             F.struct(F.lit("<only_right>").alias("column"), F.col("_only_b").cast("long").alias("n_mismatch"))]
    rows += [F.struct(F.lit(f"<{side}_column>{c}").alias("column"), F.col(f"_n_{side}").cast("long").alias("n_mismatch")) for side, c in lone]
    moved = cols != [c for c in b.columns if c in cols]
    rows += [F.struct(F.lit("<column_order>").alias("column"), F.lit(int(moved)).cast("long").alias("n_mismatch"))]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fingerprint(df: DataFrame, by: list[str], target: str, cols: list[str]) -> DataFrame:
    """M2: (group, n_rows, n_cols, columns, target_rate, column means)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns) - len(by)).alias("n_cols"),
                               F.lit(",".join(c for c in df.columns if c not in by)).alias("columns"),
                               F.avg(F.col(target).cast("double")).alias("target_rate"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def check_fingerprint(observed: DataFrame, expected: DataFrame, by: list[str], cols: list[str], rate_tol: float = 1e-3,
                      rtol: float = 1e-3, atol: float = 1e-4) -> DataFrame:
    """M2: compare against an expected fingerprint; one row per (group, check)."""
    o = observed.select(*by, *[F.col(c).alias(f"o_{c}") for c in observed.columns if c not in by])
    e = expected.select(*by, *[F.col(c).alias(f"e_{c}") for c in expected.columns if c not in by])
    j = o.join(e, by, "full_outer")
    checks = [F.struct(F.lit("n_rows").alias("check"), (F.col("o_n_rows") == F.col("e_n_rows")).alias("passed")),
              F.struct(F.lit("n_cols").alias("check"), (F.col("o_n_cols") == F.col("e_n_cols")).alias("passed")),
              F.struct(F.lit("columns").alias("check"), (F.col("o_columns") == F.col("e_columns")).alias("passed")),
              F.struct(F.lit("target_rate").alias("check"), (F.abs(F.col("o_target_rate") - F.col("e_target_rate")) <= rate_tol).alias("passed"))]
    for c in cols:
        oc, ec = F.col(f"o_mean_{c}"), F.col(f"e_mean_{c}")
        checks.append(F.struct(F.lit(f"mean_{c}").alias("check"), (F.abs(oc - ec) <= F.lit(atol) + F.lit(rtol) * F.abs(ec)).alias("passed")))
    return j.select(*by, F.explode(F.array(*checks)).alias("c")).select(*by, "c.check", F.coalesce(F.col("c.passed"), F.lit(False)).alias("passed"))


def score_drift(a: DataFrame, b: DataFrame, key: str = "row_id", score: str = "y_prob", max_thr: float = 5e-2, corr_thr: float = 0.999) -> DataFrame:
    """M3: max |p_a - p_b| and Pearson r over rows joined by key (r = 0 when a
    side is constant). Rows, or scores, that one side lacks fail the check."""
    j = a.select(key, F.col(score).alias("pa")).join(b.select(key, F.col(score).alias("pb")), key, "full_outer")
    both = F.col("pa").isNotNull() & F.col("pb").isNotNull()
    g = j.agg(F.max(F.abs(F.col("pa") - F.col("pb"))).alias("max_abs_diff"), F.coalesce(F.corr("pa", "pb"), F.lit(0.0)).alias("pearson"),
              F.count(F.when(both, 1)).alias("n"), F.count(F.when(~both, 1)).alias("n_unmatched"))
    return g.withColumn("passed", F.coalesce((F.col("max_abs_diff") <= max_thr) & (F.col("pearson") >= corr_thr), F.lit(False)) & (F.col("n_unmatched") == 0))


def flatten_json(df: DataFrame, col: str = "doc", key: str = "doc_id", depth: int = 64) -> DataFrame:
    """M4 helper: (key, path, value) of every leaf of a JSON object column.

    Objects are opened level by level until none is left, so a document of any
    nesting is compared in full; deeper than ``depth`` levels is an error.
    Paths are dotted; arrays, and empty objects, are leaves compared as text."""
    as_map = lambda c: F.from_json(c, "map<string,string>")
    opens = lambda c: F.coalesce(F.ltrim(c).startswith("{") & (F.size(as_map(c)) > 0), F.lit(False))
    level = df.select(key, F.explode(as_map(F.col(col))).alias("path", "value"))
    out = level.where(~opens(F.col("value")))
    for _ in range(depth):
        level = level.where(opens(F.col("value")))
        if not level.limit(1).count():  # one probe for each level of nesting
            return out
        level = level.select(key, "path", F.explode(as_map(F.col("value"))).alias("part", "value")).select(key, F.concat("path", F.lit("."), "part").alias("path"), "value")
        out = out.unionByName(level.where(~opens(F.col("value"))))
    raise ValueError(f"a document is nested deeper than {depth} levels")


def doc_diff(a: DataFrame, b: DataFrame, key: list[str] = ("path",), value: str = "value", rtol: float = 1e-4, atol: float = 1e-6) -> DataFrame:
    """M4: missing / unexpected / changed paths between two flattened documents."""
    key = list(key)
    j = a.select(*key, F.col(value).alias("va")).join(b.select(*key, F.col(value).alias("vb")), key, "full_outer")
    na, nb = F.col("va").try_cast("double"), F.col("vb").try_cast("double")
    same = F.when(na.isNotNull() & nb.isNotNull(), F.abs(na - nb) <= F.lit(atol) + F.lit(rtol) * F.abs(nb)).otherwise(F.col("va").eqNullSafe(F.col("vb")))
    status = F.when(F.col("va").isNull() & F.col("vb").isNotNull(), "missing").when(F.col("vb").isNull() & F.col("va").isNotNull(), "unexpected") \
        .when(~same, "changed").otherwise("same")
    return j.withColumn("status", status).where(F.col("status") != "same")


def manifest_check(required: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """M5: required entries that are missing (anti join)."""
    return required.join(found.select(*keys).distinct(), keys, "left_anti")


def report(checks: list[DataFrame]) -> DataFrame:
    """M7: roll-up of (check, passed) tables: all_passed and counts."""
    u = reduce(lambda x, y: x.unionByName(y), [c.select(F.col("check").cast("string"), F.col("passed").cast("boolean")) for c in checks])
    return u.agg(F.bool_and("passed").alias("all_passed"), F.count(F.lit(1)).alias("n_checks"), F.sum(F.when(F.col("passed"), 0).otherwise(1)).alias("n_failed"))
