"""Mutual information of continuous columns with a class by nearest neighbours.

The estimator of Ross (2014): for each row, the distance to its k-th nearest
row of the same class, and the number of rows of any class that are nearer.
Values are compressed to distinct ones with counts, so ties cost nothing. In
one dimension the k nearest rows of a class lie within k distinct values on
either side: the values are dealt out by ranges of (column, class, value) and
each range gets the k values before and behind it as a halo. The rows within
the distance are counted by prefix sums over values and query points in one
order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.dist import digamma
from ..functions.ranks import prefix_sums
from ..session import checkpoint_dir
from .clean import melt

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this module


def kth_distances(x: np.ndarray, count: np.ndarray, k: int, begin: int, end: int) -> np.ndarray:
    """Distance from each of the sorted distinct values begin..end to its k-th nearest row, itself apart."""
    n = end - begin
    at = np.arange(begin, end)[:, None] + np.arange(-k, k + 1)
    there = (at >= 0) & (at < len(x))
    near = np.clip(at, 0, len(x) - 1)
    distance = np.where(there, np.abs(x[near] - x[begin:end, None]), np.inf)
    rows = np.where(there, count[near] - (at == np.arange(begin, end)[:, None]), 0)
    order = np.argsort(distance, axis=1, kind="stable")
    upto = np.cumsum(np.take_along_axis(rows, order, 1), 1)
    first = np.argmax(upto >= k, axis=1)
    return np.take_along_axis(distance, order, 1)[np.arange(n), first]


def mutual_information(df: DataFrame, cols: list[str], target: str = S.TARGET, k: int = 5) -> DataFrame:
    """(feature, mi) in nats, not below 0; nulls are left out.

    A class of n rows uses min(k, n - 1) neighbours; a class of one row is left
    out. A row counts as nearer if x - d < its value < x + d; where d is 0 (k
    equal rows of the class) the rows of equal value count. Unlike estimators
    that add noise, ties are kept. Jobs run while this is built."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    long = melt(df, cols, keep=[target]).where("value is not null").select("feature", F.col(target).cast("int").alias("cls"), "value")
    comp = long.groupBy("feature", "cls", "value").agg(F.count(F.lit(1)).alias("c"))
    sizes = comp.groupBy("feature", "cls").agg(F.sum("c").alias("of_class")).where("of_class > 1")  # a row for each column and class
    comp = comp.join(sizes, ["feature", "cls"]).withColumn("k", F.least(F.lit(k), F.col("of_class") - 1).cast("int"))
    ordered = comp.repartitionByRange("feature", "cls", "value").sortWithinPartitions("feature", "cls", "value").withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    # the k first and last values of each range and class: a few rows for each range
    ends = [Window.partitionBy("part", "feature", "cls").orderBy(o) for o in (F.col("value"), F.desc("value"))]
    edge = ordered.select("part", "feature", "cls", "value", "c", *(F.row_number().over(w).alias(n) for w, n in zip(ends, ("up", "down")))).where((F.col("up") <= k) | (F.col("down") <= k))
    held: dict[tuple, list] = {}
    for r in edge.select("part", "feature", "cls", "value", "c").collect():
        held.setdefault((r["feature"], r["cls"]), []).append((r["part"], r["value"], r["c"]))
    halo = spark.sparkContext.broadcast({g: sorted(v) for g, v in held.items()})

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = pa.Table.from_batches(batches).combine_chunks() if (batches := list(batches)) else None  # a range's distinct values
        if batch is None or not batch.num_rows:
            return
        feature, cls = np.asarray(batch.column("feature").to_pylist()), np.asarray(batch.column("cls"))
        value, count, want, part = (np.asarray(batch.column(n)) for n in ("value", "c", "k", "part"))
        cuts = [0, *(np.flatnonzero((feature[1:] != feature[:-1]) | (cls[1:] != cls[:-1])) + 1).tolist(), len(value)]
        out = np.empty(len(value))
        for a, b in zip(cuts, cuts[1:]):
            around = halo.value[str(feature[a]), int(cls[a])]
            before = [(v, c) for p, v, c in around if p < part[a]][-int(want[a]) :]
            behind = [(v, c) for p, v, c in around if p > part[a]][: int(want[a])]
            x = np.concatenate([[v for v, _ in before], value[a:b], [v for v, _ in behind]])
            n = np.concatenate([[c for _, c in before], count[a:b], [c for _, c in behind]])
            out[a:b] = kth_distances(x, n, int(want[a]), len(before), len(before) + b - a)
        yield pa.RecordBatch.from_arrays([*(batch.column(n).combine_chunks() for n in ("feature", "cls", "value", "c", "k", "of_class")), pa.array(out)], names=["feature", "cls", "value", "c", "k", "of_class", "d"])

    near = ordered.select("feature", "cls", "value", "c", "k", "of_class", "part").mapInArrow(distances, "feature string, cls int, value double, c long, k int, of_class long, d double").checkpoint(eager=True)
    # of equal keys, order 0 comes before the values themselves and order 2 behind them
    tied = F.col("d") == 0
    ask = lambda side, at, order: F.struct(F.lit(side).alias("side"), at.alias("at"), order.alias("ord"))
    asked = near.select("feature", "cls", "value", F.explode(F.array(
        ask("hi", F.col("value") + F.col("d"), F.when(tied, 2).otherwise(0)), ask("lo", F.col("value") - F.col("d"), F.when(tied, 0).otherwise(2)))).alias("q"))
    points = near.groupBy("feature", "value").agg(F.sum("c").alias("w")).select("feature", F.col("value").alias("at"), F.lit(1).alias("ord"), "w", F.lit(None).cast("int").alias("cls"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("side"))
    both = points.unionByName(asked.select("feature", "q.at", "q.ord", F.lit(0).cast("long").alias("w"), "cls", "value", "q.side"))
    upto = prefix_sums(both, ["feature"], "at", ["w"], tiebreak=["ord"]).where("side is not null")
    inside = upto.groupBy("feature", "cls", "value").agg((F.max(F.when(F.col("side") == "hi", F.col("cum_w"))) - F.max(F.when(F.col("side") == "lo", F.col("cum_w")))).alias("m"))
    g = near.join(inside, ["feature", "cls", "value"]).groupBy("feature").agg(
        F.sum("c").alias("n"), *(F.sum(F.col("c") * digamma(F.col(x))).alias(f"psi_{x}") for x in ("k", "of_class", "m")))
    mi = digamma(F.col("n")) + (F.col("psi_k") - F.col("psi_of_class") - F.col("psi_m")) / F.col("n")
    return g.select("feature", F.greatest(F.lit(0.0), mi).alias("mi"))
