"""Distributed prefix sums and mid-ranks without a single-task window.

``Window.orderBy(x)`` without ``partitionBy`` moves every row into one task.
``prefix_sums`` instead deals the rows out by ranges of (group, order key),
whose edges Spark samples from the rows themselves, so that crowded values do
not crowd a task; it runs a local window inside each (group, range) and adds
the exclusive running total of the preceding ranges. A group covers
neighbouring ranges only, so the totals table has at most groups + ranges
rows; it is joined back without a forced broadcast. Where the domain of the
values is known, narrow slices of it take the place of sampled ranges.

Inputs should be *compressed* (one row per group and distinct order value,
with counts); then a hot value is a single row and cannot skew a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


#: Slices of a known domain for each shuffle partition, and most slices of a group.
SLICES, MOST_SLICES = 256, 1 << 16


def slice_of(order: str, value_range: tuple[float, float], partitions: int):
    """The equal-width slice of the domain that a value is in.

    There are many slices for each partition, so that values crowded into a
    hundredth of the domain still spread over all tasks; their totals are at
    most MOST_SLICES rows a group."""
    lo, hi = float(value_range[0]), float(value_range[1])
    n = min(MOST_SLICES, SLICES * partitions)
    x = (F.col(order).cast("double") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(n))
    return F.least(F.lit(n - 1), F.greatest(F.lit(0), F.floor(x).cast("int")))


def partitions(df: DataFrame, n_buckets: int | None = None) -> int:
    if n_buckets:
        return max(1, int(n_buckets))
    try:
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # pragma: no cover - conf always present in practice
        return 8


def prefix_sums(
    df: DataFrame,
    by: list[str],
    order: str,
    cols: list[str],
    n_buckets: int | None = None,
    tiebreak: list[str] | None = None,
    value_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of c in ascending ``order``
    within ``by``) and ``tot_<c>`` (group total) for each c in ``cols``.

    ``order`` values must be distinct within a group (compress first) and
    numeric. Ties on ``order`` would be summed in arbitrary order.

    ``value_range=(lo, hi)`` declares the domain of ``order`` (probabilities,
    uniform hashes): buckets are then narrow equal-width slices of it
    (:func:`slice_of`), computed per row with no extra job. Otherwise the ranges are sampled, and the rows
    checkpointed, by a job that runs here.
    """
    nb = partitions(df, n_buckets)
    by = list(by)
    if not by:
        out = prefix_sums(df.withColumn("_g", F.lit(0)), ["_g"], order, cols, n_buckets, tiebreak, value_range)
        return out.drop("_g")
    if nb > 1 and value_range is not None:
        bucketed = df.withColumn("_bk", slice_of(order, value_range, nb))
    elif nb > 1:
        # The input is evaluated once, dealt out by ranges of (group, value)
        # and kept in the shared checkpoint folder, so that all branches, and
        # a retry after a lost executor, see the same ranges. This runs a job.
        checkpoint_dir(df.sparkSession)
        keys = [*by, order, *(tiebreak or [])]
        bucketed = df.repartitionByRange(nb, *keys).withColumn("_bk", F.spark_partition_id()).checkpoint(eager=True)
    else:
        bucketed = df.withColumn("_bk", F.lit(0))
    totals = bucketed.groupBy(*by, "_bk").agg(*[F.sum(c).alias(f"_bt_{c}") for c in cols])
    wb = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*by)
    offsets = totals.select(
        *by,
        "_bk",
        *[(F.sum(f"_bt_{c}").over(wb) - F.col(f"_bt_{c}")).alias(f"_off_{c}") for c in cols],
        *[F.sum(f"_bt_{c}").over(wall).alias(f"tot_{c}") for c in cols],
    )
    wl = Window.partitionBy(*by, "_bk").orderBy(order, *(tiebreak or [])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = bucketed.join(offsets, [*by, "_bk"], "inner")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.sum(c).over(wl) + F.col(f"_off_{c}"))
    return out.drop("_bk", *[f"_off_{c}" for c in cols])


def midranks(df: DataFrame, by: list[str], value: str, count: str = "n", n_buckets: int | None = None,
             value_range: tuple[float, float] | None = None) -> DataFrame:
    """Compressed ``(by, value, count)`` -> adds ``midrank`` (1-based, ties averaged)
    and ``n_total`` per group."""
    out = prefix_sums(df, by, value, [count], n_buckets, value_range=value_range)
    return out.withColumn(
        "midrank", F.col(f"cum_{count}") - F.col(count) + (F.col(count) + F.lit(1.0)) / F.lit(2.0)
    ).withColumnRenamed(f"tot_{count}", "n_total").drop(f"cum_{count}")


def compress(df: DataFrame, by: list[str], value: str, label: str | None = None, weight: str | None = None) -> DataFrame:
    """Group rows into one row per (by, value) with counts ``n`` and, when a
    0/1 ``label`` is given, ``pos``/``neg``. Map-side partial aggregation keeps
    the shuffle proportional to the distinct values, not the rows."""
    w = F.col(weight).cast("double") if weight else F.lit(1)
    aggs = [F.sum(w).alias("n")]
    if label:
        aggs += [
            F.sum(F.when(F.col(label) == 1, w).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(w)).alias("neg"),
        ]
    return df.groupBy(*by, value).agg(*aggs)


def exact_quantiles(df: DataFrame, by: list[str], value: str, qs: list[float], n_buckets: int | None = None, weight: str | None = None,
                    value_range: tuple[float, float] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default,
    DuckDB ``quantile_cont``) for every group, without holding a group in
    one task: counts per distinct value -> distributed prefix sums -> pick
    the values covering positions floor(h) and floor(h)+1, h = (n-1) q.

    Returns ``(by..., q, value)`` with one row per group and q. Nulls ignored.
    With ``weight`` (whole numbers) a row stands for that many; ``value_range``
    as in :func:`prefix_sums`.
    """
    n = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    comp = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(n.alias("_n"))
    ps = prefix_sums(comp, list(by), value, ["_n"], n_buckets, value_range=value_range)
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    x = ps.select(*by, value, "_n", F.col("cum__n").alias("_cum"), F.col("tot__n").alias("_tot"), F.explode(qarr).alias("q"))
    h = (F.col("_tot") - 1).cast("double") * F.col("q")
    first = F.col("_cum") - F.col("_n")  # 0-based position of the first copy
    last = F.col("_cum") - 1
    lo = F.floor(h)
    hi = F.least(lo + 1, F.col("_tot") - 1)
    x = x.withColumn("_h", h).where(((lo >= first) & (lo <= last)) | ((hi >= first) & (hi <= last)))
    lo_v = F.max(F.when((F.floor(F.col("_h")) >= first) & (F.floor(F.col("_h")) <= last), F.col(value).cast("double")))
    hi_v = F.max(F.when((hi >= first) & (hi <= last), F.col(value).cast("double")))
    g = x.groupBy(*by, "q").agg(lo_v.alias("_lo"), hi_v.alias("_hi"), F.first("_h").alias("_h"))
    frac = F.col("_h") - F.floor(F.col("_h"))
    return g.select(*by, "q", (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias(value))
