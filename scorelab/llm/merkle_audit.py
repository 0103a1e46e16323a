"""Merkle fixity audit of WARC replicas (operator 5).

Records lie one after the other in an archive, at offsets that its index knows.
A leaf is the hash of a record. A node of level 0 is a range of the left
archive's offsets, ``RANGE`` bytes wide, and hashes, in order, the records that
begin in it with their places in the range; a node of each further level covers
``FAN`` nodes of the one below. Replicas are compared from the root: only
children of nodes that differ are looked at on the next level, down to the
records of the differing ranges.

A record that a replica lost moves all that follow. So the replica's records
are dealt to ranges by the records at which the left archive's ranges begin, and
places count from a range's own first record: a lost or extra record makes one
range differ, and one row of the audit.

Groups are bounded by RANGE over the least size of a record, and by FAN; a
replica's range that grew beyond RANGE differs anyway and is hashed in parts.

Defined results: records are ordered by id, then by length and hash; null url or html count
as empty; a null id comes first; equal rows are records of their own, and as
many as one side lacks are missing or extra; empty
replicas have no tree, and one against another differs in every record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

RANGE, FAN = 1 << 18, 16


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A response record: header lines, an empty line, the body, two line ends."""
    body = F.coalesce(html, F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def archive(pages: DataFrame, name: str = "archive") -> DataFrame:
    """page_id, offset, length, hash of every record, in ascending order of page_id; written to the shared folder.

    The records are dealt out by ranges of (page_id, length, hash), so that an id with
    many rows is split; a record's place in its part is counted on the way, and
    the parts' sizes (one number for each part) give the offsets.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), record.alias("record")).select("page_id", F.length("record").cast("long").alias("length"), F.sha2("record", 256).alias("hash"))
    ordered = rows.repartitionByRange("page_id", "length", "hash").sortWithinPartitions("page_id", "length", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = np.asarray(batch.column(1), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int64)), pa.array(before + np.cumsum(n) - n)], names=["page_id", "length", "hash", "part", "rel"])
            before += int(n.sum())

    placed = materialise(ordered.mapInArrow(run, "page_id long, length long, hash string, part long, rel long"), name)
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.sum("length").alias("n")).collect())
    bases = placed.sparkSession.createDataFrame(list(zip((p for p, _ in sizes), np.cumsum([0, *(n for _, n in sizes)]).tolist())), "part long, base long")
    return placed.join(F.broadcast(bases), "part").select("page_id", (F.col("base") + F.col("rel")).alias("offset"), "length", "hash")


def ranged(records: DataFrame) -> DataFrame:
    """Adds ``node``, the range of the record's own offset."""
    return records.withColumn("node", F.expr(f"offset div {RANGE}"))


_KEY = ["page_id", "length", "hash"]


def realigned(records: DataFrame, master: DataFrame) -> DataFrame:
    """Adds ``node``: the last range of ``master`` (with node) whose first record is not after the record (the first range, if none).

    Records and first records are brought into one order by ranges; a task carries
    the last node along, and one number for each part closes the gaps."""
    first = master.groupBy("node").agg(F.min(F.struct(*_KEY)).alias("k")).select(*(F.col(f"k.{c}").alias(c) for c in _KEY), F.lit(None).cast("long").alias("offset"), "node")
    ordered = records.select(*_KEY, "offset").withColumn("node", F.lit(None).cast("long")).unionByName(first).repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, F.col("node").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), -1
        for batch in batches:
            begins = batch.column(4).fill_null(-1).to_numpy(zero_copy_only=False)
            upto = np.maximum.accumulate(np.maximum(begins, last))
            last = int(upto[-1])
            rows = np.flatnonzero(begins < 0)
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns[:4], pa.array(np.where(upto[rows] < 0, None, upto[rows]), pa.int64()), pa.array([part] * len(rows), pa.int64()), pa.array([last] * len(rows), pa.int64())], names=[*_KEY, "offset", "node", "part", "upto"])
        if last >= 0:  # a row that only says how far this part's ranges go
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([last]), pa.array([part]), pa.array([last])], names=[*_KEY, "offset", "node", "part", "upto"])

    met = materialise(ordered.mapInArrow(run, "page_id long, length long, hash string, offset long, node long, part long, upto long"), "realigned")
    ends = sorted((r["part"], r["upto"]) for r in met.groupBy("part").agg(F.max("upto").alias("upto")).collect())
    carried, last = [], 0
    for part, upto in ends:
        carried.append((part, last))
        last = max(last, upto)
    before = met.sparkSession.createDataFrame(carried, "part long, before long")  # one row for each part
    return met.where("hash is not null").join(F.broadcast(before), "part").select("page_id", "offset", "length", "hash", F.coalesce("node", "before").alias("node"))


def tree(records: DataFrame) -> DataFrame:
    """level, node, hash of all nodes over records with a node; the root is the only node of the highest level."""

    def up(below: DataFrame, keys: list[str], place: str) -> DataFrame:
        children = F.array_sort(F.collect_list(F.struct(place, "hash")))
        return below.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(children, lambda c: F.concat(c[place].cast("string"), F.lit(":"), c["hash"])), "\n"), 256).alias("hash"))

    begins = records.groupBy("node").agg(F.min("offset").alias("begin"))
    placed = records.join(begins, "node").select("node", (F.col("offset") - F.col("begin")).alias("at"), "hash").withColumn("sub", F.expr(f"at div {RANGE}"))
    parts = up(placed, ["node", "sub"], "at")
    level = materialise(parts.groupBy("node").agg(F.when(F.max("sub") == 0, F.first("hash")).otherwise(F.sha2(F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.min("hash"), F.max("hash")), 256)).alias("hash")), "tree")
    out, k = level.withColumn("level", F.lit(0)), 0
    while level.select("node").where("node > 0").limit(1).count():  # the levels' number is the logarithm of the archive's size
        k += 1
        level = materialise(up(level.withColumn("over", F.expr(f"node div {FAN}")), ["over"], "node").withColumnRenamed("over", "node"), "tree")
        out = out.union(level.select("node", "hash").withColumn("level", F.lit(k)))
    return out.select("level", "node", "hash")


def differing_ranges(left: DataFrame, right: DataFrame) -> tuple[DataFrame, int]:
    """Ranges of level 0 whose hashes differ, found from the root down, and the number of nodes compared."""
    a, b = left.select("level", "node", F.col("hash").alias("a")), right.select("level", "node", F.col("hash").alias("b"))
    tops = [t.agg(F.max("level")).first()[0] for t in (left, right)]
    top = max((t for t in tops if t is not None), default=-1)
    open_nodes, compared = None, 0
    for level in range(top, -1, -1):
        here = a.where(F.col("level") == level).drop("level").join(b.where(F.col("level") == level).drop("level"), "node", "full")
        if open_nodes is not None:
            here = here.withColumn("parent", F.expr(f"node div {FAN}")).join(open_nodes.select(F.col("node").alias("parent")), "parent", "left_semi").drop("parent")
        here = materialise(here.select("node", (~F.col("a").eqNullSafe(F.col("b"))).alias("differs")), "compared")
        compared += here.count()
        open_nodes = here.where("differs").select("node")
    if open_nodes is None:
        open_nodes = left.select("node").limit(0)
    return open_nodes, compared


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records of differing ranges that differ: offset (of the left archive where it has the record), page_id, length, status (changed, missing or extra in the right replica).

    Equal records cancel out, as many as both sides have; of what is left, records of one id are paired in order."""
    a = ranged(left)
    b = realigned(right, a)
    ranges, _ = differing_ranges(tree(a), tree(b))
    inside = lambda r: r.join(ranges, "node", "left_semi")
    numbered = lambda r, *by: r.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy("offset")))

    def side(r: DataFrame, n: str) -> DataFrame:
        return r.select(F.struct("page_id").alias("key"), "nth", *(F.col(c).alias(f"{n}_{c}") for c in ("page_id", "offset", "length", "hash")))

    both = materialise(inside(a).withColumn("d", F.lit(1)).unionByName(inside(b).withColumn("d", F.lit(-1))), "inside")
    # only records that one side has more often are numbered
    odd = both.groupBy(*_KEY).agg(F.sum("d").alias("d")).where("d != 0").drop("d")
    rows = both.alias("x").join(odd.alias("y"), [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in _KEY], "left_semi")
    l, r = (numbered(rows.where(f"d = {d}").drop("d"), *_KEY) for d in (1, -1))  # noqa: E741
    same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in (*_KEY, "nth")]
    unmatched = [side(numbered(x.alias("x").join(y.alias("y"), same, "left_anti").drop("nth"), "page_id"), n) for x, y, n in ((l, r, "l"), (r, l, "r"))]
    met = unmatched[0].join(unmatched[1], ["key", "nth"], "full")
    return met.select(
        F.coalesce("l_offset", "r_offset").alias("offset"), F.coalesce("l_page_id", "r_page_id").alias("page_id"), F.coalesce("l_length", "r_length").alias("length"),
        F.when(F.col("r_hash").isNull(), "missing").when(F.col("l_hash").isNull(), "extra").otherwise("changed").alias("status"),
    )


def damaged_copy(pages: DataFrame) -> DataFrame:
    """The pages of a replica with rot: the first letter of the body is another one where md5(page_id) begins with 00."""
    hit = F.md5(F.col("page_id").cast("string").cast("binary")).startswith("00") & F.coalesce(F.octet_length(F.substring("html", 1, 1)) == 1, F.lit(False))
    flipped = F.concat(F.when(F.substring("html", 1, 1) == "#", "%").otherwise("#"), F.expr("substring(html, 2)"))
    return pages.select("page_id", "url", F.when(hit, flipped).otherwise(F.col("html")).alias("html"))
