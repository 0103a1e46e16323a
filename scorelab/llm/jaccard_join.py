"""Exact n-gram Jaccard join by token-combination prefixes (operator 10).

A document's set has its distinct 4-word shingles (64-bit hashes); documents
link when ``100 * intersection >= 85 * union``. The result is every document's
component.

1. *Classes.* Equal sets are one class; from here on a class counts once.
2. *Screen.* In hash order, a pair that links shares at least ``l`` tokens of
   the two prefixes of ``e + l`` tokens (``e``: tokens that may be missing). A
   class without so many shared prefix tokens has no link. About a quarter of
   all tokens is shuffled, and most classes end here.
3. *Prefixes.* The others' tokens are ordered by frequency, rarest first; a
   class with more than ``e`` tokens of its own has no link. The prefix is
   extended until, whichever ``e`` tokens are missing, a rare token (in at most
   ``RARE`` sets) or two frequent tokens of one subclass are left: rare tokens
   are indexed singly, frequent ones in pairs within their subclass.
4. *Stars.* In each bucket all members are compared with one pivot, the one
   with the fewest tokens of its own, so that a large group of copies costs one
   comparison for each member.
5. *Rest.* Members outside the pivot's component are compared with the
   bucket's members in other components, where the positional bound (tokens
   left after the bucket's key) still allows a link.

No link between classes is lost: every pair that links shares a bucket, and
there it is compared unless both are already in one component.

Defined results: null or empty texts, or texts without words, have empty sets,
no links and their own doc_id as component; one to three words are one shingle;
repeated rows are one class; rows that share a doc_id count as one document for
components; a null doc_id is larger than any other; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Hasher, cut, nonspace_table, pieces, shingles, text_buffers
from .common import kept_by_worker, materialise
from .components import components

NGRAM, PERCENT, RARE = 4, 85, 64
LAST_ID = 2**63 - 1
#: Bits of the filter by which representatives' rows are found again; its size is fixed, and it only saves work.
FILTER_BITS = 26


def least_shared(n, percent: int):
    """Tokens that a set of ``n`` must share with any set it links to."""
    return -(-n * percent // 100)


def screen_extra(n):
    """Tokens beyond the shortest prefix that the screen reads: a tenth of the set, at least one."""
    return np.maximum(1, n // 10)


def _document_sets(data: np.ndarray, offs: np.ndarray, ngram: int):
    hasher = kept_by_worker(("hasher",), Hasher)
    starts, ends, first = cut(data, offs, nonspace_table())
    made, text = shingles(hasher.spans(data, starts, ends), first, ngram)
    at = np.searchsorted(text, np.arange(len(offs)))
    return [np.unique(made[a:b]) for a, b in zip(at, at[1:])]


def _signature(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def _longs(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)))


def _bit(signature: bytes, doc: int) -> int:
    return int.from_bytes(hashlib.blake2b(signature + doc.to_bytes(8, "little", signed=True), digest_size=8).digest(), "little") & ((1 << FILTER_BITS) - 1)


def _sets(docs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """doc, n, signature and the screen's prefix of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j, part, at in pieces(data, offs):
                sets = _document_sets(part, at, ngram)
                heads = [x[: len(x) - least_shared(len(x), percent) + int(screen_extra(len(x)))] for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(x) for x in sets], pa.int64()), pa.array([_signature(x) for x in sets], pa.binary()), _longs(heads)], names=["doc", "n", "sig", "head"])

    return docs.mapInArrow(run, "doc long, n long, sig binary, head array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """node, label, n and all tokens of the ``wanted`` classes (node, sig, label, n), from their first documents' texts."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [_bit(s, d) for s, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x >> 6 for x in at], pa.int64()), pa.array(np.array([1 << (x & 63) for x in at], np.uint64).view(np.int64))], names=["word", "bits"])

    words = wanted.select("sig", "label").mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()  # at most 2**(FILTER_BITS - 6) rows
    mask = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words:
        mask[r["word"]] = r["bits"]
    held = docs.sparkSession.sparkContext.broadcast(mask.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.frombuffer(held.value, np.uint64)
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j, part, at in pieces(data, offs):
                sets = _document_sets(part, at, ngram)
                found = [(d, s, x) for d, x in zip(batch.column(0).slice(i, j - i).to_pylist(), sets) if len(x) for s in [_signature(x)] for b in [_bit(s, d)] if int(mask[b >> 6]) >> (b & 63) & 1]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in found], pa.int64()), pa.array([s for _, s, _ in found], pa.binary()), _longs([x for _, _, x in found])], names=["label", "sig", "tokens"])

    return docs.mapInArrow(run, "label long, sig binary, tokens array<long>").join(wanted, ["sig", "label"]).dropDuplicates(["node"]).select("node", "label", "n", "tokens")


def subclasses(n: int, percent: int) -> int:
    """Subclasses of the frequent tokens for sets of ``n``: about four prefix tokens each."""
    return 2 ** max(0, int(math.log2((n - least_shared(n, percent) + 1) / 4))) if n - least_shared(n, percent) >= 3 else 1


def prefix_keys(tokens: list[int], freqs: list[int], n: int, percent: int, rare: int) -> list[tuple[int, int]]:
    """(key, position) of a set's prefix.

    ``tokens`` are those in two sets or more, rarest first. Position is a number
    of the set's tokens that a pair found by this key, and by no earlier one,
    can't share.
    """
    out = []
    own = n - len(tokens)
    need = n - least_shared(n, percent) + 1
    have, k = own, 0
    while k < len(tokens) and freqs[k] <= rare and have < need:
        out.append((tokens[k], own + k))
        have += 1
        k += 1
    if have >= need:
        return out
    for m in sorted({subclasses(least_shared(n, percent), percent), subclasses(n, percent)}):
        groups: dict[int, list[int]] = {}
        left = need - have
        for at in range(k, len(tokens)):
            t = tokens[at]
            group = groups.get((t >> 7) % m)
            if group is None:
                groups[(t >> 7) % m] = [t]
                continue
            for u in group:
                out.append((int.from_bytes(hashlib.blake2b(f"{u},{t},{m}".encode(), digest_size=8).digest(), "little", signed=True), own + at - len(groups)))
            group.append(t)
            left -= 1
            if left <= 0:
                break
    return out


def _keys(sets: DataFrame, percent: int, rare: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, at = lists.flatten(), np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
            token, df = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("token", "df"))
            for i, (node, n, own) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)))):
                mine = slice(at[i], at[i + 1])  # a row's tokens alone become Python objects
                keys = prefix_keys(token[mine].tolist(), df[mine].tolist(), n, percent, rare)
                m = len(keys)
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int64()), pa.array([node] * m, pa.int64()), pa.array([n] * m, pa.int64()), pa.array([p for _, p in keys], pa.int64()), pa.array([own / n] * m, pa.float64())], names=["key", "node", "n", "pos", "own"])

    return sets.select("node", "n", "own", "tokens").mapInArrow(run, "key long, node long, n long, pos long, own double")


def _may_link(percent: int, n_a, pos_a, n_b, pos_b):
    """Whether the tokens left at both positions are enough for the sizes."""
    enough = F.lit(percent) * (n_a + n_b)
    return (F.lit(100 + percent) * (n_a - pos_a) >= enough) & (F.lit(100 + percent) * (n_b - pos_b) >= enough)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    own = sets.select("node", "n", F.col("tokens.token").alias("tokens"))
    left = own.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = own.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            keep = []
            for i in range(batch.num_rows):
                shared = len(np.intersect1d(c["t_a"][i].values.to_numpy(), c["t_b"][i].values.to_numpy(), assume_unique=True))
                if 100 * shared >= percent * (c["n_a"][i].as_py() + c["n_b"][i].as_py() - shared):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "t_a", "t_b").mapInArrow(run, "a long, b long")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT, rare: int = RARE) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_ID)).alias("doc"), F.col(text).alias("text"))
    sets = materialise(_sets(rows, ngram, percent), "sets")
    classes = materialise(sets.where("n > 0").groupBy("sig").agg(F.min("doc").alias("label"), F.first("n").alias("n"), F.first("head").alias("head")).withColumn("node", F.monotonically_increasing_id()), "classes")

    # screen
    heads = classes.select("node", F.explode("head").alias("token"))
    often = materialise(heads.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token"), "tokens")
    counts = heads.join(often, "token").groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    least = -F.floor(-F.col("n") * percent / 100)
    open_classes = materialise(classes.select("node", "sig", "label", "n").join(counts, "node").where(F.col("shared") >= F.greatest(F.lit(1), F.floor(least / 10))), "open")

    # tokens by frequency, and classes whose own tokens leave room for a link
    full = materialise(_full_sets(rows, open_classes, ngram), "full")
    tokens = full.select("node", F.explode("tokens").alias("token"))
    freqs = materialise(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "freqs")
    shared = tokens.join(freqs, "token").groupBy("node").agg(F.collect_list(F.struct("df", "token")).alias("tokens"))
    able = materialise(
        shared.join(full.select("node", "label", "n"), "node")
        .withColumn("own", F.col("n") - F.size("tokens")).where(F.col("own") <= F.col("n") - least)
        .withColumn("tokens", F.array_sort("tokens")), "able")

    # stars
    keys = materialise(_keys(able, percent, rare), "keys")
    pivots = materialise(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("own", "node", "n", "pos")).alias("p"))
        .where("members > 1").select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("p_n"), F.col("p.pos").alias("p_pos")), "pivots")
    stars = keys.join(pivots, "key").where(F.col("node") != F.col("pivot")).where(_may_link(percent, F.col("n"), F.col("pos"), F.col("p_n"), F.col("p_pos"))).select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    links = materialise(_verify(stars, able, percent), "links")
    roots = materialise(components(links), "roots")

    # members outside the pivot's component against the bucket's members in others
    placed = keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    pivot_roots = pivots.join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("p_root")), "pivot", "left").select("key", "pivot", F.coalesce("p_root", "pivot").alias("p_root"))
    inside = materialise(placed.join(pivot_roots, "key"), "placed")
    outside = inside.where("root != p_root").select("key", *(F.col(c).alias(f"o_{c}") for c in ("node", "n", "pos", "root")))
    rest = (
        outside.join(inside, "key").where("root != o_root and (root = p_root or node < o_node)").where("node != pivot")
        .where(_may_link(percent, F.col("n"), F.col("pos"), F.col("o_n"), F.col("o_pos")))
        .select(F.col("o_node").alias("a"), F.col("node").alias("b")).distinct()
    )
    more = _verify(rest, able, percent)
    roots = materialise(components(links.union(more)), "roots")

    # back to documents
    named = roots.join(classes.select("node", "sig", "label"), "node")
    joined = named.join(named.groupBy("root").agg(F.min("label").alias("component")), "root").select("sig", "component")
    # written, so that the join below is between two shuffles and a class with many documents can be split
    of_class = materialise(classes.select("sig", "label").join(joined, "sig", "left").select("sig", F.coalesce("component", "label").alias("component")), "placed_classes")
    back = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return sets.select("doc", "n", "sig").join(of_class, "sig", "left").select(back("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce(back("component"), back("doc")).alias("component_id"))
