"""Document quality by attention-based multiple-instance learning (operator 3).

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is
encoded from its bytes and words alone (shares of byte groups, word shapes,
repetition, hashed words); a hidden layer turns that into a representation, a
gated attention (tanh times sigmoid, softmax over the document's passages)
weighs the passages, and a logistic unit scores the weighted sum. Only document
labels are learned from.

The weights are fitted on the driver from a bounded sample: ``SAMPLE_DOCS``
labelled rows, those with the smallest hash of doc_id, with all their passages.
Scoring reads every passage of every document.

Defined results: null and empty texts are bags of one all-zero passage and are
scored like any other; a doc_id labelled more than once counts with its
smallest label, null labels not at all; without labels of both classes the
score is the share of label 1 (a half without any label); repeated documents
are scored each for itself; label, lang, source and doc_id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytewords import Hasher, cut, nonspace_table, pieces, text_buffers
from .common import kept_by_worker

PASSAGE_WORDS, HASHED, HIDDEN, ATTENTION = 64, 32, 24, 12
SAMPLE_DOCS, EPOCHS, THRESHOLD = 4000, 60, 0.3
HELD_OUT_OF = 5


def byte_groups() -> np.ndarray:
    """Group of every byte: letters, digits, spaces, line ends, beyond ASCII, controls, then each punctuation mark."""
    g = np.full(256, 5, np.int64)
    g[97:123], g[65:91], g[48:58], g[32], g[128:] = 0, 1, 2, 3, 4
    g[10] = 6
    marks = [c for c in range(33, 127) if not chr(c).isalnum()]
    g[marks] = 7 + np.arange(len(marks))
    return g


GROUPS = 7 + 32
INPUTS = GROUPS + 4 + HASHED


def encode_passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of every passage and each text's first passage (one more at the end)."""
    hasher = kept_by_worker(("hasher",), Hasher)
    starts, ends, first = cut(data, offs, nonspace_table())
    words = np.diff(first)
    per = np.maximum(1, -(-words // PASSAGE_WORDS))
    begin = np.concatenate([[0], np.cumsum(per)])
    m = int(begin[-1])
    x = np.zeros((m, INPUTS), np.float32)
    if not len(starts):
        return x, begin
    of_text = np.repeat(np.arange(len(words)), words)
    passage = begin[of_text] + (np.arange(len(starts)) - first[of_text]) // PASSAGE_WORDS
    # bytes from a passage's first word to the next passage's
    edge = np.flatnonzero(np.diff(passage, prepend=-1))
    at, who = starts[edge], passage[edge]
    stop = np.append(at[1:], len(data))
    last = np.append(of_text[edge][1:] != of_text[edge][:-1], True)
    stop[last] = offs[of_text[edge][last] + 1]
    owner = np.repeat(who, stop - at)
    keep = np.repeat(at - np.concatenate([[0], np.cumsum(stop - at)[:-1]]), stop - at) + np.arange(len(owner))
    counts = np.bincount(owner * GROUPS + kept_by_worker(("groups",), byte_groups)[data[keep]], minlength=m * GROUPS).reshape(m, GROUPS)
    total = np.maximum(1, counts.sum(1))
    x[:, :GROUPS] = np.sqrt(counts / total[:, None])
    n = np.maximum(1, np.bincount(passage, minlength=m))
    length = ends - starts
    hashes = hasher.spans(data, starts, ends)
    upper = (data >= 65) & (data <= 90)
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    sums_u, sums_l = (np.concatenate([[0], np.cumsum(v)]) for v in (upper, letters))
    all_upper = (sums_u[ends] - sums_u[starts] == sums_l[ends] - sums_l[starts]) & (sums_l[ends] > sums_l[starts])
    x[:, GROUPS] = np.bincount(passage, length, m) / n / 8
    x[:, GROUPS + 1] = np.bincount(passage, all_upper, m) / n
    x[:, GROUPS + 2] = np.bincount(passage, sums_l[ends] == sums_l[starts], m) / n
    both = _distinct(passage, hashes)
    x[:, GROUPS + 3] = np.bincount(both, minlength=m) / n
    bag = np.bincount(passage * HASHED + (hashes >> np.uint64(59)).astype(np.int64), minlength=m * HASHED).reshape(m, HASHED)
    x[:, GROUPS + 4 :] = np.sqrt(bag / n[:, None])
    return x, begin


def _distinct(passage: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The passage of every distinct (passage, word)."""
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    return p[np.concatenate([[True], (p[1:] != p[:-1]) | (h[1:] != h[:-1])])]


@dataclass
class Model:
    """Weights by name; ``prior`` alone where there was nothing to learn."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    prior: float = 0.5

    def forward(self, x: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh((x - w["mean"]) @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        logit = (v * u) @ w["a"]
        top = np.maximum.reduceat(logit, begin[:-1])
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        weight = np.exp(logit - top[owner])
        weight /= np.add.reduceat(weight, begin[:-1])[owner]
        bag = np.add.reduceat(weight[:, None] * h, begin[:-1], axis=0)
        z = bag @ w["c"] + w["b"]
        return {"h": h, "v": v, "u": u, "weight": weight, "bag": bag, "owner": owner, "score": 1 / (1 + np.exp(-z))}

    def gradient(self, x: np.ndarray, begin: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the bags' mean log loss in every weight but the inputs' mean."""
        w, f = self.weights, self.forward(x, begin)
        dz = ((f["score"] - labels) / len(labels)).astype(f["score"].dtype)
        g = {"c": f["bag"].T @ dz, "b": dz.sum()}
        per = (dz[:, None] * w["c"])[f["owner"]]
        dh = f["weight"][:, None] * per
        gain = (per * f["h"]).sum(1)
        dl = f["weight"] * (gain - np.add.reduceat(f["weight"] * gain, begin[:-1])[f["owner"]])
        g["a"] = (f["v"] * f["u"]).T @ dl
        dvu = dl[:, None] * w["a"]
        dv, du = dvu * f["u"] * (1 - f["v"] ** 2), dvu * f["v"] * f["u"] * (1 - f["u"])
        g["V"], g["U"] = f["h"].T @ dv, f["h"].T @ du
        dh += dv @ w["V"].T + du @ w["U"].T
        de = dh * (1 - f["h"] ** 2)
        g["E"], g["e"] = (x - w["mean"]).T @ de, de.sum(0)
        return g

    def score(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(begin) - 1, self.prior)
        return self.forward(x, begin)["score"].astype(np.float64)


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Full-gradient Adam over minibatches of bags, in a fixed order."""
    if not len(labels):
        return Model()
    prior = float(labels.mean())
    if prior in (0.0, 1.0):
        return Model(prior=prior)
    rng = np.random.default_rng(seed)
    draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
    every = np.concatenate(bags)
    w = {"mean": every.mean(0), "E": draw(INPUTS, HIDDEN) * 3, "e": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "b": np.float32(np.log(prior / (1 - prior)))}
    model, names = Model(w, prior), [k for k in w if k != "mean"]
    m1, m2, step = {k: 0 * w[k] for k in names}, {k: 0 * w[k] for k in names}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for a in range(0, len(order), 64):
            pick = order[a : a + 64]
            x, begin = np.concatenate([bags[i] for i in pick]), np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            g = model.gradient(x, begin, labels[pick])
            g["E"] = g["E"] + 1e-5 * w["E"]
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - epoch / epochs))
            for k in names:
                m1[k], m2[k] = 0.9 * m1[k] + 0.1 * g[k], 0.999 * m2[k] + 0.001 * g[k] ** 2
                w[k] = (w[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT_OF)) == 0


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE_DOCS) -> Model:
    """Learn from at most ``sample`` labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("body")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j, part, at in pieces(data, offs):
                x, begin = encode_passages(part, at)
                bags = [x[a:b] for a, b in zip(begin, begin[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([b.astype("<f4").tobytes() for b in bags], pa.binary())], names=["doc_id", "y", "bag"])

    rows = texts.select("doc_id", "body", "y").mapInArrow(run, "doc_id long, y int, bag binary").groupBy("doc_id").agg(F.min(F.struct("y", "bag")).alias("r")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["r"]["bag"], "<f4").reshape(-1, INPUTS) for r in rows]
    return train(bags, np.array([min(1, max(0, r["r"]["y"])) for r in rows], np.float32))


def score(docs: DataFrame, model: Model, text: str = "text", out_col: str = "score") -> DataFrame:
    """Adds the score of every row's whole text; a column of that name is replaced."""
    docs = docs.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_buffers(batch.column(batch.schema.names.index(text)))
            for i, j, part, at in pieces(data, offs):
                made = model.score(*encode_passages(part, at))
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(made, pa.float64())], names=[*batch.schema.names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier does not reject."""
    name = "mil_score_" + "_" * max(map(len, docs.columns), default=0)
    return score(docs, fit(docs, labels), out_col=name).where(F.col(name) >= threshold).drop(name)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns per document."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
