"""Exact top-k inner-product search over an impact-ordered index (operator 9).

Components become integers, ``floor(256 * x)``. Rows are indexed in blocks. In
a block, the postings of a dimension are grouped into segments of equal
quantised impact (``STEP`` wide) and sign, and segments lie in order of
descending impact. A search adds whole segments to the scores of all rows they
hold, highest impacts first. What is missing from a row's score is at most the
query's norm times the norm of the row's missing part, which the index knows
for every level; it stops when few rows can still be among a query's best and
computes those rows' scores exactly. No row is left out without that proof.

Defined results: vectors that are null or hold a null, NaN or infinity take no
part; missing components of shorter vectors count as 0; every row is a
candidate, also rows that repeat a vec_id, but none with the query's own
vec_id; a query vec_id that occurs more than once is asked once, with its
smallest vector; a null vec_id takes no part; scores beyond 64 bits are cut to
their range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BLOCK_ROWS, STEP, QUERY_ROWS, PASS_QUERIES = 4096, 8, 512, 1 << 14
#: Components of this size or more are multiplied as Python integers.
HUGE = 1 << 24
#: Share of (row, query) pairs that may be left for exact scores before the search stops.
ENOUGH = 0.01


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("v"))


def _matrix(lists: pa.Array) -> np.ndarray:
    sizes = np.diff(np.asarray(lists.offsets, np.int64))
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def build_index(vectors: DataFrame) -> DataFrame:
    """One row for each block: ids, vectors, and the segments (level, dimension, sign, rows) in order of descending impact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(a, BLOCK_ROWS)
                v = _matrix(batch.column(1))
                row, dim = (x.ravel() for x in np.indices(v.shape))
                flat = v.ravel()
                level = np.minimum(np.abs(flat) // STEP, HUGE)
                order = np.lexsort((row, flat < 0, dim, -level))
                key = np.stack([level, dim, flat < 0])[:, order]
                edge = np.flatnonzero(np.concatenate([[True], (np.diff(key, axis=1) != 0).any(0)])) if len(flat) else np.zeros(0, np.int64)
                cells = {"n": batch.num_rows, "dims": v.shape[1], "ids": np.asarray(batch.column(0), np.int64).tobytes(), "vectors": v.tobytes(), "segments": np.ascontiguousarray(key[:, edge]).astype(np.int64).tobytes(), "starts": edge.astype(np.int64).tobytes(), "rows": row[order].astype(np.uint16).tobytes()}
                yield pa.RecordBatch.from_pylist([cells], schema=pa.schema([("n", pa.int64()), ("dims", pa.int64()), *((k, pa.binary()) for k in ("ids", "vectors", "segments", "starts", "rows"))]))

    return vectors.select("vec_id", "v").mapInArrow(run, "n long, dims long, ids binary, vectors binary, segments binary, starts binary, rows binary")


class Block:
    def __init__(self, r: dict) -> None:
        self.ids = np.frombuffer(r["ids"], np.int64)
        self.v = np.frombuffer(r["vectors"], np.int64).reshape(r["n"], r["dims"])
        self.segments = np.frombuffer(r["segments"], np.int64).reshape(3, -1)
        self.starts = np.append(np.frombuffer(r["starts"], np.int64), r["n"] * r["dims"])
        self.rows = np.frombuffer(r["rows"], np.uint16)

    def missing(self, low: int) -> np.ndarray:
        """Norm of what is missing from each row when all levels from ``low`` on have been added."""
        size = np.abs(self.v)
        level = np.minimum(size // STEP, HUGE)
        return np.sqrt(np.where(level >= low, size - (level * STEP + STEP // 2), size).astype(np.float64) ** 2 @ np.ones(size.shape[1]))

    def possible(self, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, query) pairs that may be among the k best, given that scores under ``floor`` are not."""
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
        scores = np.zeros((len(self.ids), len(q)), np.float64)
        pairs = (np.zeros(0, np.int64),) * 2
        levels = self.segments[0]
        at = 0
        while at < len(levels):
            low = levels[at]
            stop = int(np.searchsorted(-levels, -low, "right"))
            for s in range(at, stop):
                dim, minus = self.segments[1, s], self.segments[2, s]
                rows = self.rows[self.starts[s] : self.starts[s + 1]]
                value = float((low * STEP + STEP // 2) * (-1 if minus else 1))
                scores[rows] += value * q[:, dim].astype(np.float64)
            at = stop
            if at < len(levels) and low > 3:
                continue
            gap = self.missing(int(low))[:, None] * norm + 1e-6 * np.abs(scores) + 1e-3
            least = floor
            if len(self.ids) > k:
                sure = scores - gap
                least = np.maximum(floor, np.partition(sure, len(self.ids) - k, axis=0)[len(self.ids) - k])
            # one row more than k is asked for: a query's own row does not count
            pairs = np.nonzero(scores + gap >= least)
            if len(pairs[0]) <= ENOUGH * scores.size:
                break
        return pairs

    def exact(self, q: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int64)
        huge = max(np.abs(self.v).max(initial=0), np.abs(q).max(initial=0)) >= HUGE
        for a in range(0, len(rows), 1 << 16):
            x, y = self.v[rows[a : a + (1 << 16)]], q[queries[a : a + (1 << 16)]]
            if huge:
                made = (x.astype(object) * y.astype(object)).sum(1)
                out[a : a + len(x)] = [max(-(2**63), min(2**63 - 1, int(s))) for s in made]
            else:
                out[a : a + len(x)] = np.einsum("ij,ij->i", x, y)
        return out


def _fit(q: np.ndarray, dims: int) -> np.ndarray:
    return q[:, :dims] if q.shape[1] >= dims else np.pad(q, ((0, 0), (0, dims - q.shape[1])))


def search(index: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each task's blocks for each query of one pass (at most PASS_QUERIES)."""
    held = index.sparkSession.sparkContext.broadcast((query_ids.tobytes(), queries.tobytes(), queries.shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_raw, raw, shape = held.value
        own, every = np.frombuffer(ids_raw, np.int64), np.frombuffer(raw, np.int64).reshape(shape)
        best = {a: (np.zeros(0, np.int64),) * 3 for a in range(0, len(own), QUERY_ROWS)}
        floors = np.full(len(own), -np.inf)
        for batch in batches:
            for r in batch.to_pylist():
                block = Block(r)
                for a in best:
                    q = _fit(every[a : a + QUERY_ROWS], r["dims"])
                    rows, cols = block.possible(q, floors[a : a + QUERY_ROWS], k + int(np.unique(block.ids, return_counts=True)[1].max(initial=1)))
                    other = block.ids[rows] != own[a + cols]
                    rows, cols = rows[other], cols[other]
                    c, s, i = (np.concatenate(x) for x in zip(best[a], (cols, block.exact(q, rows, cols), block.ids[rows])))
                    order = np.lexsort((i, ~s, c))
                    c, s, i = c[order], s[order], i[order]
                    first = np.searchsorted(c, np.arange(len(q)))
                    keep = np.arange(len(c)) - first[c] < k
                    best[a] = c, s, i = c[keep], s[keep], i[keep]
                    full = np.bincount(c, minlength=len(q)) >= k
                    last = np.searchsorted(c, np.arange(len(q)), "right") - 1
                    floors[a : a + QUERY_ROWS][full] = s[last[full]]
        for a, (c, s, i) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(own[a + c]), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``every``; all rows are candidates."""
    ints = integer_vectors(vectors)
    index = materialise(build_index(ints), "impact_index")
    asked = materialise(ints.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    passes = max(1, -(-asked.count() * 5 // (4 * PASS_QUERIES)))  # a pass's queries go to all tasks; their number is bounded
    found = None
    for p in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p).orderBy("vec_id").collect()
        ids = np.array([r["vec_id"] for r in rows], np.int64)
        q = _matrix(pa.array([r["v"] for r in rows], pa.list_(pa.int64())))
        part = search(index, ids, q, k)
        found = part if found is None else found.union(part)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
