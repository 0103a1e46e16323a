"""Token-id files with canonical length-limited Huffman codes (operator 4).

A file set is a folder with three Parquet tables:

``header``  id, length: the code length of every id that occurs. The codes
            follow from the lengths (canonical: by length, then id).
``blocks``  in folders ``part=0, 1, ...`` of ascending document order; each row
            is a run of whole documents that can be decoded by itself: ``first``
            (position of its first id among all ids), ``n_ids``, the documents'
            ``doc_ids`` and ``sizes`` (ids with the end id), ``payload`` (bits,
            most significant first) and ``checkpoints`` (bit offset of every
            ``CHECKPOINT``-th id).
``parts``   part, base: ids before each part.

Counts are global: lengths are optimal for the whole corpus among codes of at
most ``MAX_BITS`` bits. A block has about ``BLOCK_IDS`` ids, or one longer
document.

Ids are those of the tokenizer file asked as it is: the literal text of an added
token stands for that token's id, and only the stretches between are cut and
merged.

Defined results: a null text counts as empty and gives the end id alone; rows
with equal doc_id (nulls first of all) follow each other in order of the text's
hash; equal rows are all kept; an empty table gives an empty set of files;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import SliceEncoder
from .bytewords import pieces, text_buffers
from .common import kept_by_worker, shared_path
from .pretokens import classes_of_ranks

MAX_BITS, CHECKPOINT, BLOCK_IDS = 18, 256, 1 << 16
#: Ids of known slices that a worker keeps (4 bytes each) before it starts anew.
KEPT_IDS = 12_000_000


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 where the count is 0."""
    ids = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(ids) < 2:
        out[ids] = 1
        return out
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids do not fit codes of {limit} bits")
    order = ids[np.argsort(counts[ids], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, items = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weights, items])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(weights))  # which of the merged items are single ids
        merged = both[rank]
        items = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(ids) - 2
    for single in reversed(levels):
        own = int(single[:take].sum())
        out[order[:own]] += 1
        take = 2 * (take - own)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    ids = np.flatnonzero(lengths)
    order = ids[np.lexsort((ids, lengths[ids]))]
    n = lengths[order]
    codes = np.zeros(len(lengths), np.uint32)
    if len(order):
        span = np.left_shift(np.uint64(1), (MAX_BITS - n).astype(np.uint64))
        left = np.concatenate([[0], np.cumsum(span)[:-1]]).astype(np.uint64)
        codes[order] = left >> (MAX_BITS - n).astype(np.uint64)
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after the other, and the bit offset of every CHECKPOINT-th id."""
    n = lengths[ids]
    ends = np.cumsum(n)
    at = ends - n
    wide = codes[ids].astype(np.uint64) << (64 - n - (at & 31)).astype(np.uint64)
    word = at >> 5
    out = np.zeros(int(ends[-1] >> 5) + 2, np.uint32)
    lead = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[lead]] |= np.bitwise_or.reduceat(wide >> np.uint64(32), lead).astype(np.uint32)
    out[word[lead] + 1] |= np.bitwise_or.reduceat(wide & np.uint64(0xFFFFFFFF), lead).astype(np.uint32)
    return out.astype(">u4").tobytes()[: int(ends[-1] + 7) >> 3], at[::CHECKPOINT]


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every value of the next MAX_BITS bits."""
    ids = np.flatnonzero(lengths)
    order = ids[np.lexsort((ids, lengths[ids]))]
    n = lengths[order]
    span = np.left_shift(1, MAX_BITS - n)
    size = np.zeros(1 << MAX_BITS, np.uint8)
    symbol = np.zeros(1 << MAX_BITS, np.uint32)
    used = int(span.sum())
    symbol[:used] = np.repeat(order, span)
    size[:used] = np.repeat(n, span)
    return symbol, size


def unpack_bits(payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int], tables: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Ids of each block; all stretches between checkpoints of all blocks advance together."""
    symbol, size = tables
    data = np.frombuffer(b"".join(payloads) + b"\0" * 8, np.uint8).astype(np.uint32)
    peek = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    base = np.cumsum([0, *map(len, payloads)])
    at = np.concatenate([c + 8 * b for c, b in zip(checkpoints, base)]) if payloads else np.zeros(0, np.int64)
    todo = np.concatenate([np.minimum(CHECKPOINT, n - CHECKPOINT * np.arange(len(c))) for c, n in zip(checkpoints, counts)]) if payloads else at
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)  # a step of all stretches is one row
    for k in range(CHECKPOINT):
        if k and not k % 32 and not (todo > k).any():
            break
        at = np.minimum(at, (len(peek) - 1) * 8)
        v = (peek[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        out[k] = symbol[v]
        at = at + size[v]
    rows = np.cumsum([0, *map(len, checkpoints)])
    return [out[:, a:b].T.ravel()[:n] for a, b, n in zip(rows, rows[1:], counts)]


class AddedEncoder:
    """Encodes texts whose added tokens (literal bytes to id) stand for themselves, the stretches between by ``plain``."""

    def __init__(self, plain: SliceEncoder, added: dict[bytes, int]) -> None:
        self.plain, self.added = plain, added
        # leftmost first, of those the longest
        self.find = re.compile(b"|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        buf = data.tobytes()
        if not any(t in buf for t in self.added):
            return self.plain.encode(data, offs)
        edges, own, first = [int(offs[0])], [], [0]
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
            for m in self.find.finditer(buf, a, b):
                edges += m.span()
                own += [-1, self.added[m[0]]]
            edges.append(b)
            own.append(-1)
            first.append(len(own))
        ids, at = self.plain.encode(data, np.array(edges, np.int64))
        parts = [ids[i:j] if k < 0 else np.array([k], ids.dtype) for i, j, k in zip(at, at[1:], own)]
        ends = np.cumsum([0, *map(len, parts)])
        return np.concatenate(parts), ends[first]


def slice_merger(lib):
    """Ids of slices by the library, each as one piece of ordinary text, and their counts.

    A byte-level model's ids stand for as many bytes as their tokens have characters, so the slices of a call can go
    through the library as the words of one text and be told apart by their bytes; otherwise each is a text of its own."""
    from tokenizers.pre_tokenizers import ByteLevel

    lib.encode_special_tokens = True  # a slice is ordinary text
    by_bytes = lib.normalizer is None and isinstance(lib.pre_tokenizer, ByteLevel) and not lib.pre_tokenizer.add_prefix_space
    if by_bytes:
        lib.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)  # slices are cut already
        vocabulary = lib.get_vocab()
        size = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            size[i] = len(token)

    def merge(slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = [s.decode("utf-8") for s in slices]
        if by_bytes and words:
            ids = np.array(lib.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
            ends, upto = np.cumsum(np.fromiter(map(len, slices), np.int64, len(slices))), np.cumsum(size[ids])
            last = np.searchsorted(upto, ends)
            if len(ids) and last[-1] == len(ids) - 1 and (upto[last] == ends).all():
                return ids, np.diff(last, prepend=-1)
        each = [np.array(e.ids, np.uint32) for e in lib.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(e) for e in each], np.int64)

    return merge


def _encoder(path: str, classes: bytes) -> AddedEncoder | SliceEncoder:
    def make():
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        added = {t.content.encode(): i for i, t in lib.get_added_tokens_decoder().items()}
        if added and (lib.normalizer is not None or any(t.single_word or t.lstrip or t.rstrip for t in lib.get_added_tokens_decoder().values())):
            raise ValueError(f"added tokens that are not found by their literal text alone: {path}")
        plain = SliceEncoder(classes, slice_merger(lib), most=KEPT_IDS)
        return AddedEncoder(plain, added) if added else plain

    return kept_by_worker(("json", path), make)


def id_type(path: str, end_id: int) -> str:
    """The unsigned integers, little-endian, that hold every id of a tokenizer file: 2 bytes where they do, else 4."""
    from tokenizers import Tokenizer

    return "<u2" if max([end_id, *Tokenizer.from_file(path).get_vocab().values()]) < 1 << 16 else "<u4"


ORDERED = "part int, rel long, doc_id long, n long, ids binary, tally array<struct<id: int, n: long>>"
_TALLY = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))


def encode_ordered(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids (``id_type``) in ascending doc_id order: part, rel (ids before it in the part), doc_id, n, ids.

    A part's last row is no document: its n is null, rel has all the part's ids, and tally how often each occurs."""
    classes, kind = classes_of_ranks(), id_type(path, end_id)
    width = int(kind[-1])
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ranged = keyed.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, part, rel = _encoder(path, classes), TaskContext.get().partitionId(), 0
        counts, names = np.zeros(0, np.int64), ["part", "rel", "doc_id", "n", "ids", "tally"]
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j, some, at in pieces(data, offs, 1 << 19):
                ids, first = enc.encode(some, at)
                both = np.insert(ids.astype(kind), first[1:], end_id)  # the end id after each document
                got = np.bincount(both, minlength=len(counts))
                got[: len(counts)] += counts
                counts = got
                bounds = (first + np.arange(j - i + 1)) * width
                n = np.diff(bounds) // width
                packed = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(both)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, part, np.int32)), pa.array(rel + np.cumsum(n) - n), batch.column(0).slice(i, j - i), pa.array(n), packed, pa.nulls(j - i, _TALLY)],
                    names=names,
                )
                rel += int(n.sum())
        if rel:
            at = np.flatnonzero(counts)
            pairs = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], fields=list(_TALLY.value_type))
            tally = pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([rel]), *(pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary())), tally], names=names)

    return ranged.mapInArrow(run, ORDERED)


def write_files(docs: DataFrame, path: str, end_id: int, folder: str) -> None:
    """Encode ``docs`` and write a file set to ``folder`` (must be new)."""
    spark = docs.sparkSession
    work = f"{folder}/ids"
    encode_ordered(docs, path, end_id).write.option("compression", "zstd").parquet(work)
    ids, kind = spark.read.schema(ORDERED).parquet(work), id_type(path, end_id)
    # one row for each id of the vocabulary and one for each part: bounded by vocabulary and task numbers
    ends = ids.where("n is null")
    totals = ends.select(F.inline("tally")).groupBy("id").agg(F.sum("n").alias("n")).collect()
    sizes = sorted((r["part"], r["rel"]) for r in ends.select("part", "rel").collect())
    counts = np.zeros(max((r["id"] for r in totals), default=-1) + 1, np.int64)
    for r in totals:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, length int").coalesce(1).write.parquet(f"{folder}/header")
    bases = dict(zip((p for p, _ in sizes), itertools.accumulate([0, *(n for _, n in sizes)])))
    spark.createDataFrame(list(bases.items()), "part int, base long").coalesce(1).write.parquet(f"{folder}/parts")
    codes = canonical(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, rel, n = (np.asarray(batch.column(k)) for k in (0, 1, 3))
            doc, (data, offs) = batch.column(2), text_buffers(batch.column(4))
            # a block ends before a document that does not follow on, or that would make it too long
            begin, held, rows = 0, 0, []
            for k in range(len(n)):
                if k > begin and (held + n[k] > BLOCK_IDS or part[k] != part[k - 1] or rel[k] != rel[k - 1] + n[k - 1]):
                    rows.append((begin, k))
                    begin, held = k, 0
                held += int(n[k])
            if len(n):
                rows.append((begin, len(n)))
            for a, b in rows:
                block = data[offs[a] : offs[b]].view(kind)
                payload, marks = pack_bits(block, codes, lengths)
                yield pa.RecordBatch.from_pylist(
                    [{"part": int(part[a]), "first": bases[int(part[a])] + int(rel[a]), "n_ids": len(block), "doc_ids": doc.slice(a, b - a).to_pylist(), "sizes": n[a:b].tolist(), "payload": payload, "checkpoints": marks.tolist()}],
                    schema=pa.schema([("part", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary()), ("checkpoints", pa.list_(pa.int64()))]),
                )

    blocks = ids.where("n is not null").drop("tally").mapInArrow(run, BLOCKS)
    blocks.write.partitionBy("part").option("compression", "snappy").parquet(f"{folder}/blocks")
    # the plain ids were a working copy
    _delete(spark, work)


BLOCKS = "part int, first long, n_ids long, doc_ids array<long>, sizes array<long>, payload binary, checkpoints array<long>"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a file set: doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit integers)."""
    header = spark.read.schema("id int, length int").parquet(f"{folder}/header").collect()  # at most one row for each id
    lengths = np.zeros(max((r["id"] for r in header), default=-1) + 1, np.int64)
    for r in header:
        lengths[r["id"]] = r["length"]
    out = "doc_id long, start long, n_tokens long, ids binary"
    if not header:
        return spark.createDataFrame([], out)
    packed = lengths.astype(np.uint8).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = decode_table(np.frombuffer(packed, np.uint8).astype(np.int64))
        for batch in batches:
            cols = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            counts = cols["n_ids"].to_pylist()
            cuts = np.cumsum([0, *counts])
            for i, j, _, _ in pieces(cuts, cuts, 1 << 20):
                marks = [np.array(x, np.int64) for x in cols["checkpoints"].slice(i, j - i).to_pylist()]
                made = unpack_bits(cols["payload"].slice(i, j - i).to_pylist(), marks, counts[i:j], tables)
                for k, ids in zip(range(i, j), made):
                    n = np.array(cols["sizes"][k].as_py(), np.int64)
                    bounds = np.concatenate([[0], np.cumsum(n)])
                    packed_ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                    yield pa.RecordBatch.from_arrays([pa.array(cols["doc_ids"][k].as_py(), pa.int64()), pa.array(cols["first"][k].as_py() + bounds[:-1]), pa.array(n), packed_ids], names=["doc_id", "start", "n_tokens", "ids"])

    blocks = spark.read.schema("first long, n_ids long, doc_ids array<long>, sizes array<long>, payload binary, checkpoints array<long>").parquet(f"{folder}/blocks")
    return blocks.mapInArrow(run, out)


def digests(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write, read back, and digest: doc_id, start, n_tokens, ids_crc32."""
    folder = shared_path(docs.sparkSession, "huffman")
    write_files(docs, path, end_id, folder)
    return read_files(docs.sparkSession, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
