"""Byte-level BPE encoding and decoding (operator 8).

Texts are cut by :mod:`pretokens` (class arrays and an associative scan, no
expressions); each slice is looked up in a bounded cache of merged slices, and
new slices are merged together, many at a time, by array operations. Every
token keeps its byte offset; decoding scatters token bytes to the offsets.

Defined results: a null text counts as empty; an empty text has no tokens;
repeated rows are encoded each for itself; other columns pass through
unchanged, but a column with the name of an added one is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import mix, pieces, text_buffers
from .common import kept_by_worker
from .pretokens import PreTokens, classes_of_ranks

#: A worker's table has 2**CACHE_BITS slots (23 bytes each); it starts anew when its slices have more ids than POOL_IDS.
CACHE_BITS, POOL_IDS = 20, 4_000_000
_MASKS = np.array([2 ** (8 * i) - 1 for i in range(9)], dtype=np.uint64)
#: Slices up to this many bytes are merged side by side, longer ones with a heap.
SIDE_BY_SIDE = 48
NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merger:
    """Merges slices by the ranks of their parts, lowest rank first, leftmost among equals."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        pairs = {(ranks[t[:i]] << 20 | ranks[t[i:]]): r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.rank = np.append(np.fromiter(pairs.values(), np.int32, len(pairs))[order], NONE)

    def pair(self, a: int, b: int) -> int | None:
        at = int(np.searchsorted(self.keys, a << 20 | b))
        return int(self.rank[at]) if self.keys[at] == a << 20 | b else None

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.rank[at], NONE)

    def merge(self, slices: list[bytes]) -> list[bytes]:
        """Ids of each slice, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(slices)
        groups: dict[int, list[int]] = {}
        for i, s in enumerate(slices):
            if (r := self.ranks.get(s)) is not None:
                out[i] = r.to_bytes(4, "little")
            elif len(s) > SIDE_BY_SIDE:
                out[i] = self._heap(s)
            else:
                groups.setdefault((len(s) + 7) // 8 * 8, []).append(i)
        for width, members in groups.items():
            for a in range(0, len(members), 20_000):
                self._side_by_side(slices, members[a : a + 20_000], width, out)
        return out

    def _side_by_side(self, slices: list[bytes], members: list[int], width: int, out: list[bytes]) -> None:
        lens = np.array([len(slices[i]) for i in members])
        raw = np.frombuffer(b"".join(slices[i].ljust(width, b"\0") for i in members), np.uint8).reshape(-1, width)
        cols = np.arange(width)
        tok = np.where(cols < lens[:, None], self.single[raw], -1).astype(np.int32)
        rank = np.full(tok.shape, NONE, np.int32)
        rank[:, :-1] = self.rank_of(tok[:, :-1], tok[:, 1:])
        who = np.arange(len(members))
        done = tok.copy()
        while len(who):
            at = rank.argmin(axis=1)
            rows = np.arange(len(who))
            best = rank[rows, at]
            live = best < NONE
            if not live.all():
                done[who[~live]] = tok[~live]
                who, tok, rank, at, best = who[live], tok[live], rank[live], at[live], best[live]
                rows = rows[: len(who)]
                if not len(who):
                    break
            tok[rows, at] = best
            shift = np.minimum(cols + (cols > at[:, None]), width - 1)
            tok = np.take_along_axis(tok, shift, 1)
            tok[:, -1] = -1
            rank = np.take_along_axis(rank, np.minimum(cols + (cols >= at[:, None]), width - 1), 1)
            rank[:, -1] = NONE
            right = np.minimum(at + 1, width - 1)
            rank[rows, at] = np.where(at + 1 < width, self.rank_of(tok[rows, at], tok[rows, right]), NONE)
            left = np.maximum(at - 1, 0)
            rank[rows, left] = np.where(at > 0, self.rank_of(tok[rows, left], tok[rows, at]), rank[rows, left])
        for i, row in zip(members, done, strict=True):
            out[i] = row[row >= 0].astype("<u4").tobytes()

    def _heap(self, s: bytes) -> bytes:
        n, tok = len(s), [int(self.single[c]) for c in s]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.rank_of(np.array(tok[:-1]), np.array(tok[1:])).tolist()
        heap = [(r, i, tok[i], tok[i + 1]) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := self.pair(r, tok[after[j]])) is not None:
                    heapq.heappush(heap, (x, i, r, tok[after[j]]))
            if (k := before[i]) >= 0 and (x := self.pair(tok[k], r)) is not None:
                heapq.heappush(heap, (x, k, tok[k], r))
        return np.array([t for t in tok if t >= 0], dtype="<u4").tobytes()


class SliceEncoder:
    """Encodes texts slice by slice; ``merge`` turns new slices into packed ids, or into the ids of all and their counts.

    Slices of up to 16 bytes are kept in a two-way table of fixed size, looked
    up for whole batches by their exact bytes; longer ones are merged anew,
    once a batch.
    """

    def __init__(self, classes: bytes, merge, slots: int = 1 << CACHE_BITS, most: int = POOL_IDS) -> None:
        self.pre, self.merge, self.slots, self.most = PreTokens(classes), merge, slots, most
        self.low, self.high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.size, self.count = np.zeros(slots, np.uint8), np.zeros(slots, np.uint8)
        self.place = np.zeros(slots, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _keep(self, made: list[bytes] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Puts ids into the pool; their places and counts."""
        if isinstance(made, tuple):
            got, count = made
        else:
            got = np.frombuffer(b"".join(made), dtype="<u4")
            count = np.fromiter(map(len, made), np.int64, len(made)) // 4
        while self.used + len(got) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(got)] = got
        place = self.used + np.cumsum(count) - count
        self.used += len(got)
        return place, count

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's first id (one more at the end)."""
        at, first = self.pre.cut(data, offs)
        begin, n = at[:-1], np.diff(at)
        if not len(n):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        if self.used > self.most:
            self.size[:] = 0
            self.used = 0
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        low = words[begin] & _MASKS[np.minimum(n, 8)]
        high = np.zeros_like(low)
        two = np.flatnonzero(n > 8)
        high[two] = words[begin[two] + 8] & _MASKS[np.minimum(n[two] - 8, 8)]
        code = mix(low + mix(high + n.astype(np.uint64)))
        top = np.uint64(self.slots - 1)
        slot = (code & top).astype(np.int64)

        def held(i, s):
            return (self.low[s] == low[i]) & (self.high[s] == high[i]) & (self.size[s] == n[i])

        every = slice(None)
        hit = held(every, slot) & (n <= 16)
        place, count = self.place[slot].astype(np.int64), self.count[slot].astype(np.int64)
        left = np.flatnonzero(~hit & (n <= 16))
        if len(left):
            other = ((code[left] >> np.uint64(32)) & top).astype(np.int64)
            again = held(left, other)
            place[left[again]], count[left[again]] = self.place[other[again]], self.count[other[again]]
            left = left[~again]
        long = np.flatnonzero(n > 16)
        buf = data.tobytes() if len(left) or len(long) else b""
        if len(left):
            _, rep, inv = np.unique(code[left], return_index=True, return_inverse=True)
            rep = left[rep]
            same = (low[left] == low[rep[inv]]) & (high[left] == high[rep[inv]]) & (n[left] == n[rep[inv]])
            if not same.all():
                long = np.concatenate([long, left[~same]])
                left, inv = left[same], inv[same]
            p, c = self._keep(self.merge([buf[a : a + k] for a, k in zip(begin[rep].tolist(), n[rep].tolist())]))
            place[left], count[left] = p[inv], c[inv]
            a, b = (code[rep] & top).astype(np.int64), ((code[rep] >> np.uint64(32)) & top).astype(np.int64)
            to = np.where(self.size[a] == 0, a, b)
            self.low[to], self.high[to], self.size[to], self.place[to], self.count[to] = low[rep], high[rep], n[rep], p, c
            # two new slices may have gone to one slot, each field from the same (last) of them
        if len(long):
            found: dict[bytes, int] = {}
            where = np.array([found.setdefault(buf[a : a + k], len(found)) for a, k in zip(begin[long].tolist(), n[long].tolist())])
            p, c = self._keep(self.merge(list(found)))
            place[long], count[long] = p[where], c[where]
        ends = np.zeros(len(n) + 1, np.int64)
        np.cumsum(count, out=ends[1:])
        ids = self.pool[np.repeat(place - ends[:-1], count) + np.arange(ends[-1])]
        return ids, ends[first]


def encoder_for(path: str, classes: bytes) -> SliceEncoder:
    return kept_by_worker(("ranks", path), lambda: SliceEncoder(classes, Merger(load_ranks(path)).merge))


def _lengths(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def make():
        ranks = load_ranks(path)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        n = np.array([len(t) for t in tokens], dtype=np.int64)
        return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(n)[:-1]]), n

    return kept_by_worker(("token bytes", path), make)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(df: DataFrame, path: str, text: str = "text", ids_col: str = "ids", offsets_col: str = "offsets") -> DataFrame:
    """Adds the ids of ``text`` and the byte offset of each id's token, as arrays of int."""
    df, classes = df.drop(ids_col, offsets_col), classes_of_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(path, classes)
        size = _lengths(path)[2]
        for batch in batches:
            data, offs = text_buffers(batch.column(batch.schema.get_field_index(text)))
            for i, j, part, at in pieces(data, offs, 1 << 19):
                ids, first = enc.encode(part, at)
                ends = np.cumsum(size[ids])
                begin = ends - size[ids] - np.repeat(at[:-1], np.diff(first))
                cols = [*batch.slice(i, j - i).columns, _lists(ids, first), _lists(begin, first)]
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, ids_col, offsets_col])

    schema = T.StructType([*df.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), T.StructField(offsets_col, T.ArrayType(T.IntegerType(), False))])
    return df.mapInArrow(run, schema)


def _decoded(ids: np.ndarray, begins: np.ndarray, at: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and their bounds, from ids, the tokens' offsets in their texts and each text's first id."""
    blob, where, size = _lengths(path)
    n = size[ids]
    base = np.concatenate([[0], np.cumsum(n)])[at]
    to = begins + np.repeat(base[:-1], np.diff(at))
    return blob[np.repeat(where[ids] - to, n) + np.arange(base[-1])], base


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def decode(df: DataFrame, path: str, ids_col: str = "ids", offsets_col: str = "offsets", out_col: str = "decoded") -> DataFrame:
    """Replaces ids and offsets by the bytes that they stand for."""
    rest = [f for f in df.schema.fields if f.name not in (ids_col, offsets_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            ids_all, begins = batch.column(names.index(ids_col)), batch.column(names.index(offsets_col))
            bounds = np.asarray(ids_all.offsets, dtype=np.int64) - ids_all.offsets[0].as_py()
            ids_flat, begin_flat = np.asarray(ids_all.flatten()), np.asarray(begins.flatten())
            cols = [batch.column(names.index(f.name)) for f in rest]
            for i, j, _, at in pieces(ids_flat, bounds, 1 << 18):
                own = slice(bounds[i], bounds[j])
                made = _binary(*_decoded(ids_flat[own], begin_flat[own], at, path))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in cols), made], names=[*(f.name for f in rest), out_col])

    return df.mapInArrow(run, T.StructType([*rest, T.StructField(out_col, T.BinaryType())]))


def round_trip(df: DataFrame, path: str, text: str = "text", ids_col: str = "ids", offsets_col: str = "offsets", out_col: str = "decoded") -> DataFrame:
    """Encodes and decodes in one task: adds ids, offsets and the bytes decoded from them.

    The ids of a batch are several times its text; kept in one task, they never
    stand in a batch of the default ten thousand rows."""
    df, classes = df.drop(ids_col, offsets_col, out_col), classes_of_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, size = encoder_for(path, classes), _lengths(path)[2]
        for batch in batches:
            data, offs = text_buffers(batch.column(batch.schema.names.index(text)))
            for i, j, part, at in pieces(data, offs, 1 << 19):
                ids, first = enc.encode(part, at)
                begin = np.cumsum(size[ids]) - size[ids] - np.repeat(at[:-1], np.diff(first))
                made = [_lists(ids, first), _lists(begin, first), _binary(*_decoded(ids, begin, first, path))]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, *made], names=[*batch.schema.names, ids_col, offsets_col, out_col])

    kinds = [T.ArrayType(T.IntegerType(), False), T.ArrayType(T.IntegerType(), False), T.BinaryType()]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *(T.StructField(n, k) for n, k in zip((ids_col, offsets_col, out_col), kinds))]))


def digests(df: DataFrame, path: str) -> DataFrame:
    """Contract columns: number of tokens, digest of the ids, digest of the decoded bytes."""
    return round_trip(df.select("doc_id", "text"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
