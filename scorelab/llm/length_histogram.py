"""Exact length histogram of encoded documents (operator 2).

Documents are aggregated by their number of tokens. Suffix sums over the
histogram then answer, for every context limit, how many documents and tokens
reach it and how many tokens are left when every document is cut to it. The
sums run in two steps (runs of ``RUN`` lengths, then within a run), so that no
task holds more than one run or one row for each run.

Defined results: a null text counts as empty; empty texts have length 0;
repeated rows each count; an empty table has an empty histogram; columns other
than the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_codec import encoder_for
from .bytewords import pieces, text_buffers
from .common import materialise
from .pretokens import classes_of_ranks

RUN = 1024


def lengths(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """length: number of tokens of every row's whole text."""
    classes = classes_of_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(path, classes)
        for batch in batches:
            data, offs = text_buffers(batch.column(0))
            for _, _, part, at in pieces(data, offs, 1 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(enc.encode(part, at)[1]))], names=["length"])

    return docs.select(text).mapInArrow(run, "length long")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds, for each length, the documents and tokens of this length or more, the tokens left by cutting there, and the share of documents of at most this length."""
    by_run = histogram.withColumn("run", F.expr(f"length div {RUN}"))
    runs = by_run.groupBy("run").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t"))
    # one row for each run of lengths: at most the longest document's length over RUN
    beyond = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = runs.select("run", F.coalesce(F.sum("d").over(beyond), F.lit(0)).alias("d_beyond"), F.coalesce(F.sum("t").over(beyond), F.lit(0)).alias("t_beyond"), F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    own = Window.partitionBy("run").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return by_run.join(tails, "run").select(
        "length", "n_docs",
        (F.sum("n_docs").over(own) + F.col("d_beyond")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("length")).over(own) + F.col("t_beyond")).alias("tokens_at_least"),
        "all_docs", "all_tokens",
    ).select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("tokens_cut_here"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("share_up_to"),
    )


def histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Suffix sums over the histogram, which is written once, so that every text is encoded once."""
    return suffix_sums(materialise(lengths(docs, path, text).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")), "lengths"))


def at_limit(sums: DataFrame, limit: int) -> DataFrame:
    """Documents, documents beyond ``limit``, and tokens left when every document is cut to ``limit`` (one row)."""
    beyond = F.col("length") > limit
    return sums.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.max(F.when(beyond, F.col("docs_at_least"))), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum(F.when(~beyond, F.col("n_docs") * F.col("length")).otherwise(F.col("n_docs") * limit)), F.lit(0)).alias("tokens_left"),
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """The least length that at least ``share`` of the documents do not exceed (one row)."""
    return sums.where(F.col("share_up_to") >= share).agg(F.min("length").alias("length"))
