"""Fill-in-middle transformation with a sparse exception index (operator 12).

Two hashed cuts, counted in code points, part every text into prefix, middle
and suffix, which are put together again in one of three forms. Cuts in code
points become cuts in bytes through an index of the exceptions only: for each
multibyte character its place and the excess bytes up to it. A batch of texts
is one run of bytes, so one ``searchsorted`` converts all its cuts; where a
batch is pure ASCII the index is empty and a cut is its own byte offset.

Defined results: a null text counts as empty; an empty text, and one that
holds a sentinel, is kept plain; a null key is hashed as an empty string;
repeated rows give repeated results; an empty table gives no rows; texts of
any length are read whole; columns other than the key and the text are not
read, so their names can't clash. Texts are valid UTF-8, as Spark's strings
are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import pieces, text_buffers

#: The marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FROM, SPM_BELOW = 90, 20


class Exceptions:
    """Where the multibyte characters of a run of texts are, and the excess bytes up to each."""

    def __init__(self, data: np.ndarray) -> None:
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0))])
        self.at_char = self.at_byte - self.excess[:-1]

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte offset."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)] if len(self.at_byte) else cuts

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)] if len(self.at_char) else cuts


def draws(keys: list[str], seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers for each key."""
    raw = b"".join(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:16] for k in keys)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def frames(keys: list[str], data: np.ndarray, offs: np.ndarray, seed: int, marks: tuple[bytes, ...]) -> Iterator[tuple[int, str, int | None, int | None, list[bytes]]]:
    """n, form, prefix and middle length in code points, and the parts of the output of each text in turn."""
    index, h = Exceptions(data), draws(keys, seed)
    first = index.chars(offs)
    n = np.diff(first)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    cut_low, cut_high = index.bytes(first[:-1] + low), index.bytes(first[:-1] + high)
    raw = data.tobytes()
    for i, chars in enumerate(n.tolist()):
        start, end = int(offs[i]), int(offs[i + 1])
        text = raw[start:end]
        if not chars or h[i, 2] % 100 >= PLAIN_FROM or any(m in text for m in marks):
            yield chars, "plain", None, None, [text]
            continue
        x, y = int(cut_low[i]) - start, int(cut_high[i]) - start
        prefix, suffix = [marks[0], text[:x]], [marks[1], text[y:]]
        spm = h[i, 3] % 100 < SPM_BELOW
        yield chars, "spm" if spm else "psm", int(low[i]), int(high[i] - low[i]), [*(suffix + prefix if spm else prefix + suffix), marks[2], text[x:y]]


def restore(output: bytes, form: str, marks: tuple[bytes, ...]) -> list[bytes]:
    """The parts of the text, in order, from an output and its form alone.

    A text in a framed form holds no mark, and no mark begins inside another
    one, so the first match of each is the one that was put there."""
    if form == "plain":
        return [output]
    one, two = (marks[0], marks[1]) if form == "psm" else (marks[1], marks[0])
    if not output.startswith(one):
        raise ValueError(f"a {form} output begins with {one!r}")
    at = output.index(two, len(one))
    last = output.index(marks[2], at + len(two))
    left, right, middle = output[len(one) : at], output[at + len(two) : last], output[last + len(marks[2]) :]
    return [left, middle, right] if form == "psm" else [right, middle, left]


def _rows(docs: DataFrame, text: str, key: str, tail: str, ending, seed: int, sentinels: tuple[str, ...]) -> DataFrame:
    """Key, n, form and lengths of every row, then the columns that ``ending`` makes of the output's parts and the form."""
    if len(set(sentinels)) != 3 or any(a[k:] and b.startswith(a[k:]) for a in sentinels for b in sentinels for k in range(1, len(a))):
        raise ValueError("sentinels must differ, and none may begin inside another")
    marks = tuple(s.encode() for s in sentinels)
    kept = F.col(key)
    source = docs.select(kept.alias("key"), F.coalesce(kept.cast("string"), F.lit("")).alias("name"), F.col(text).cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    names = ["key", "n", "form", "prefix_chars", "middle_chars", *(c.split()[0] for c in tail.split(", "))]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * (len(names) - 5)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(2))
            for i, j, part, at in pieces(data, offs):
                made = [(*head, *ending(parts, head[1], marks)) for *head, parts in frames(batch.column(1).slice(i, j - i).to_pylist(), part, at, seed, marks)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(c, t) for c, t in zip(zip(*made), types))], names=names)

    schema = f"key {kind}, n long, form string, prefix_chars long, middle_chars long, {tail}"
    return source.mapInArrow(run, schema).withColumnRenamed("key", key)


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 1, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """key, n, form, prefix_chars, middle_chars, output: every whole text in its fill-in-middle form."""
    return _rows(docs, text, key, "output string", lambda parts, form, marks: (b"".join(parts).decode(),), seed, sentinels)


def restored(made: DataFrame, output: str = "output", form: str = "form", key: str = "doc_id", sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """key, text: the texts rebuilt from output and form."""
    marks = tuple(s.encode() for s in sentinels)
    source = made.select(F.col(key).alias("key"), F.col(output).alias("output"), F.col(form).alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [b"".join(restore(o.as_py().encode(), f.as_py(), marks)).decode() for o, f in zip(part.column(1), part.column(2))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", key)


def _digest(parts: list[bytes]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p)
    return h.hexdigest()


def digests(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 1, sentinels: tuple[str, ...] = SENTINELS) -> DataFrame:
    """The columns of the contract: hashes of every output and of the text rebuilt from it."""
    return _rows(docs, text, key, "output_sha256 string, restored_sha256 string", lambda parts, form, marks: (_digest(parts), _digest(restore(b"".join(parts), form, marks))), seed, sentinels)
