"""Line dedup over a corpus (operator 11), in DataFrame functions only.

Lines are exploded and their normalised keys hashed (two 64-bit hashes); the
distinct documents of each hash are counted, and the lines of a hash over the
threshold are dropped everywhere but in its last document. Only hashes are
shuffled to decide that. The decisions come back as positions for each
document, and the lines left are put together again in order of position, so
whole texts move once.

A line that a third of all documents share is one row for each document, which
pre-aggregates by hash; the join of its rows with the decision meets one row
on the other side, so Spark can split it. No array holds more than the lines
of one document.

Defined results: a null or empty text has one empty line; rows with one doc_id
are one document to the count and each keep a row of their own, also if their
texts are equal; a null doc_id is one document, before all others; repeated
lines within a document count once and share one fate; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"
#: Shortest key in code points, and fewest documents, for a key to lose lines.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Stands for a null doc_id.
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _documents(docs: DataFrame, text: str, key: str) -> DataFrame:
    """doc, mark (equal for rows with equal text), lines."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(whole).alias("mark"), F.split(whole, "\n", -1).alias("lines"))


def shared_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """The long lines (doc, mark, pos, h, g), and of the keys in ``least_docs`` documents or more (h, g, n_docs, last_doc); both written."""
    lines = _documents(docs, text, key).select("doc", "mark", F.posexplode("lines").alias("pos", "line"))
    keyed = lines.where(F.length("line") >= least_chars).select("doc", "mark", "pos", line_key(F.col("line")).alias("k")).where(F.length("k") >= least_chars)
    long = materialise(keyed.select("doc", "mark", "pos", F.xxhash64("k").alias("h"), F.xxhash64(F.lit(least_chars), F.col("k")).alias("g")), "long_lines")
    counted = long.groupBy("h", "g").agg(F.countDistinct("doc").alias("n_docs"), F.max("doc").alias("last_doc"))
    return long, materialise(counted.where(F.col("n_docs") >= least_docs), "shared_lines")


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that is left) of every row of ``docs``.

    Jobs run while this is built: hashed lines and shared keys are written to
    the shared folder, so a lost executor costs no second count."""
    long, shared = shared_lines(docs, text, key, least_chars, least_docs)
    fated = long.join(shared, ["h", "g"]).where(F.col("doc") != F.col("last_doc"))
    gone = fated.groupBy("doc", "mark").agg(F.collect_set("pos").alias("gone"))
    # the lines come through the join, so that the functions below read an array and don't split the text again for each line
    met = _documents(docs, text, key).join(gone, ["doc", "mark"], "left")
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n"))
    return met.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"), kept.alias("kept"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
