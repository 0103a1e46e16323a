"""Benchmark decontamination with a generalised suffix automaton (operator 6).

Words are the matches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
lower-casing A-Z. A window is ``window`` consecutive words of an item; an item
of fewer words, but not none, is one window. One automaton holds all items of
a block; the training words stream through it, and wherever the longest match
reaches a window, the window's words are hit. Stretches in which no window's
rolling hash occurs are passed over first; the hash test has no misses, and
what it lets through is decided by the automaton on the words themselves.

The items are a stated test set. They are read in blocks of about
``BLOCK_WORDS`` words, one pass over the documents each, so that what a task
and the driver hold has a bound (one longer item is a block of its own). Where
there are several blocks, the passes run one after the other: each writes its
runs of hit words, for the documents that have any, and gives up its automaton;
the documents are written once and read by every pass.

Defined results: null and empty texts have no words and no hits; items without
words have no windows; equal items each count under their own id, equal
(item_id, text) rows once; items with a null id hit like others and are together
one item, a null in ``items`` and nothing in the joined ids; an empty benchmark hits nothing; repeated documents
are judged each for itself; other columns pass through, but ``find`` replaces
columns with the names of the added ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import Hasher, alnum_table, cut, lower_table, mix, pieces, powers, text_buffers
from .common import kept_by_worker, materialise

WINDOW, BLOCK_WORDS = 13, 100_000
_BASE = 0xC2B2AE3D27D4EB4F | 1
_RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first_word", "end_word", "first_byte", "end_byte")]))


class Automaton:
    """Generalised suffix automaton of word sequences; knows the items of every window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items]
        for _, seq in sequences:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        # the state of the last `window` words of what a state spells
        self.whole = [-1] * len(order)
        for v in order:
            if self.length[v] >= window:
                up = self.link[v]
                self.whole[v] = v if self.length[up] < window else self.whole[up]
        self.items: dict[int, set[str | None]] = {}
        own: dict[int, list[tuple[int, str | None]]] = {}
        for name, seq in sequences:
            v = 0
            for i, c in enumerate(seq):
                v = self.next[v][c]
                if i + 1 >= window:
                    self.items.setdefault(self.whole[v], set()).add(name)
            if 0 < len(seq) < window:
                own.setdefault(v, []).append((len(seq), name))
        # short items that end where a state ends: its own, then its suffixes'
        self.short: list[list[tuple[int, str | None]]] = [[]] * len(order)
        for v in order[1:]:
            self.short[v] = own.get(v, []) + self.short[self.link[v]]

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        cur = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str | None]]]:
        """(end, length, items) of every window that occurs; ``end`` is past its last word."""
        v = have = 0
        get, nxt, link, length = self.ids.get, self.next, self.link, self.length
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                v = have = 0
                continue
            while v and c not in nxt[v]:
                v = link[v]
                have = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                have += 1
            if have >= self.window:
                yield i + 1, self.window, self.items[self.whole[v]]
            for n, name in self.short[v]:
                if n <= have:
                    yield i + 1, n, {name}


class Scanner:
    """A block's automaton and the rolling hashes of its windows."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.hasher, self.table, self.low = Hasher(), alnum_table(), lower_table()
        self.up = self.down = powers(1, 1)
        data, offs = text_buffers(pa.array([t for _, t in items], pa.string()))
        starts, ends, first = cut(data, offs, self.table)
        low = self.low[data].tobytes()
        words = [low[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        self.automaton = Automaton([(name, words[a:b]) for (name, _), (a, b) in zip(items, pairwise(first.tolist()))], window)
        hashes = self.hasher.spans(data, starts, ends)
        found: dict[int, list[np.ndarray]] = {}
        for a, b in pairwise(first.tolist()):
            if b > a:
                found.setdefault(min(window, b - a), []).append(self._rolling(hashes[a:b], min(window, b - a)))
        self.grams = []
        for n, parts in found.items():
            known = np.unique(np.concatenate(parts))
            seen = np.zeros(1 << 20, bool)
            seen[(known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.grams.append((n, known, seen))

    def _rolling(self, hashes: np.ndarray, n: int) -> np.ndarray:
        m = len(hashes)
        if len(self.up) <= m:
            self.up, self.down = powers(_BASE, 2 * m + 1), powers(pow(_BASE, -1, 2**64), 2 * m + 1)
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(hashes * self.up[:m], out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * self.down[: m - n + 1])

    def scan(self, data: np.ndarray, offs: np.ndarray):
        """Word bounds, each text's first word, hit flags of words, and the items of each text that has any."""
        starts, ends, first = cut(data, offs, self.table)
        hit, found = np.zeros(len(starts), bool), {}
        hashes = self.hasher.spans(data, starts, ends)
        limit = np.repeat(first[1:], np.diff(first))
        cover = np.zeros(len(starts) + 1, np.int64)
        for n, known, seen in self.grams:
            if len(hashes) < n:
                continue
            h = self._rolling(hashes, n)
            at = np.flatnonzero(seen[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = at[(at + n <= limit[at])]
            at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
        maybe = np.cumsum(cover[:-1]) > 0
        if maybe.any():
            edge = maybe.copy()
            edge[1:] &= ~maybe[:-1]
            edge[first[:-1][first[:-1] < len(maybe)]] |= maybe[first[:-1][first[:-1] < len(maybe)]]
            begins = np.flatnonzero(edge)
            stops = np.flatnonzero(maybe & np.append(~maybe[1:] | edge[1:], True)) + 1
            texts = np.searchsorted(first, begins, "right") - 1
            for a, b, text in zip(begins.tolist(), stops.tolist(), texts.tolist()):
                low = [self.low[data[s:e]].tobytes() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
                for end, n, names in self.automaton.stream(low):
                    hit[a + end - n : a + end] = True
                    found.setdefault(text, set()).update(names)
        return starts, ends, first, hit, found


def _runs(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: int, b: int, byte: int) -> list[dict]:
    h = hit[a:b].astype(np.int8)
    begins, stops = np.flatnonzero(np.diff(h, prepend=0) == 1), np.flatnonzero(np.diff(h, append=0) == -1)
    return [{"first_word": int(i), "end_word": int(j) + 1, "first_byte": int(starts[a + i]) - byte, "end_byte": int(ends[a + j]) - byte} for i, j in zip(begins, stops)]


def _scanner(key: tuple, make) -> Scanner:
    """The worker's scanner; one of another block is given up."""
    held = kept_by_worker(("decontam",), dict)
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def _pass(df: DataFrame, items: list[tuple[str | None, str]], text: str, window: int, made: list[str], later: bool) -> DataFrame:
    """One block's pass; ``made`` names the added columns, which a later pass adds to."""
    n_words, n_hit, spans_name, items_name = made
    held = df.sparkSession.sparkContext.broadcast(items)
    key = (held._jbroadcast.id() if held._jbroadcast else id(held), df.sparkSession.sparkContext.applicationId)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, lambda: Scanner(held.value, window))
        for batch in batches:
            names = batch.schema.names
            data, offs = text_buffers(batch.column(names.index(text)))
            for i, j, part, at in pieces(data, offs):
                starts, ends, first, hit, found = scanner.scan(part, at)
                rest = batch.slice(i, j - i)
                if later:
                    for k, (spans, have) in enumerate(zip(rest.column(names.index(spans_name)).to_pylist(), rest.column(names.index(items_name)).to_pylist())):
                        for s in spans:
                            hit[first[k] + s["first_word"] : first[k] + s["end_word"]] = True
                        if have:
                            found.setdefault(k, set()).update(have)
                sums = np.concatenate([[0], np.cumsum(hit)])
                spans = [_runs(hit, starts, ends, first[k], first[k + 1], int(at[k])) if sums[first[k + 1]] > sums[first[k]] else [] for k in range(j - i)]
                added = [
                    pa.array(np.diff(first)), pa.array(np.diff(sums[first])),
                    pa.array(spans, pa.list_(pa.struct([(f.name, pa.int64()) for f in _RUNS.elementType.fields]))),
                    pa.array([sorted(found.get(k, ()), key=lambda n: (n is None, n)) for k in range(j - i)], pa.list_(pa.string())),
                ]
                keep = [k for k, n in enumerate(names) if n not in made]
                yield pa.RecordBatch.from_arrays([*(rest.column(k) for k in keep), *added], names=[*(names[k] for k in keep), *made])

    kinds = [T.LongType(), T.LongType(), _RUNS, T.ArrayType(T.StringType())]
    return df.mapInArrow(run, T.StructType([*(f for f in df.schema.fields if f.name not in made), *(T.StructField(n, k) for n, k in zip(made, kinds))]))


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, prefix: str = "", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Adds n_words, n_hit, spans (runs of hit words, with byte places) and items (ids of items with occurring windows), named with ``prefix``."""
    tests = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("body")).where("body is not null").distinct()
    size = tests.agg(F.sum(F.length("body")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // (6 * block_words)))
    made = [prefix + n for n in ("n_words", "n_hit", "spans", "items")]
    out = docs.drop(*made)
    listed = lambda block: sorted(((r["item"], r["body"]) for r in block.collect()), key=lambda r: (r[0] is None, r))
    if blocks == 1:
        return _pass(out, listed(tests), text, window, made, False)
    row = apart(out, "row")
    numbered = materialise(out.withColumn(row, F.monotonically_increasing_id()), "decontam")
    flags = None
    for k in range(blocks):
        block = listed(tests.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k))
        hits = _pass(numbered.select(row, text), block, text, window, made, False).where(F.col(made[1]) > 0)
        written = materialise(hits.select(row, *made[2:]), "decontam_hits")
        flags = written if flags is None else flags.unionByName(written)
    together = flags.groupBy(row).agg(*(F.flatten(F.collect_list(c)).alias(c) for c in made[2:]))
    met = numbered.join(together, row, "left").withColumns({c: F.coalesce(c, F.array().cast(together.schema[c].dataType)) for c in made[2:]}).drop(row)
    return _pass(met, [], text, window, made, True).select(*out.columns, *made)


def apart(docs: DataFrame, name: str) -> str:
    """A column name that no column of ``docs`` has."""
    return name + "_" * (1 + max((len(c) for c in docs.columns), default=0))


def contaminated(n_hit, n_words):
    """The coverage limit: a twentieth of the words, at least one."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Drops documents over the coverage limit; cuts the hit spans out of the others' texts."""
    prefix = apart(docs, "decontam")
    found = find(docs, benchmark, text, window, prefix).where(~contaminated(F.col(f"{prefix}n_hit"), F.col(f"{prefix}n_words")))
    raw, spans = F.col(text).cast("binary"), F.col(f"{prefix}spans")
    # the bytes between spans: from the last one's end to the next one's begin, then the rest
    kept = F.aggregate(
        spans, F.struct(F.lit(b"").alias("made"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(F.concat(acc["made"], F.substring(raw, (acc["end"] + 1).cast("int"), (s["first_byte"] - acc["end"]).cast("int"))).alias("made"), s["end_byte"].alias("end")),
        lambda acc: F.concat(acc["made"], F.substring(raw, (acc["end"] + 1).cast("int"), F.octet_length(raw))))
    return found.withColumn(text, F.when(F.size(spans) > 0, kept.cast("string")).otherwise(F.col(text))).select(*docs.columns)


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract columns per document."""
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )
