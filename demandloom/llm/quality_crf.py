"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of character kinds, word lengths, repetition within the line and against
earlier lines, and the same of the lines before and after it; a chain of two states ties neighbouring lines together.
Lines of a labelled document carry the document's label. Forward-backward gives each line's probability of being good;
their mean, weighted by line length, is the document's share of good text, which a logistic curve maps to a score.

Learning uses at most ``TRAIN_DOCS`` labelled documents, drawn by a hash of doc_id from all labelled rows that are not held
out, as whole texts. Scoring uses all texts; a document is scored from its text only, so batches and copies do not matter.

Contract: a null text is an empty one and has one empty line. Null labels are ignored. Without any usable label, or with
labels of one class only, the score of every document is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm import text as tx

TRAIN_DOCS = 5000
STEPS = 120
THRESHOLD = 0.7
BASE = 16
FEATURES = 3 * BASE + 3

_KINDS = np.zeros((256, 7), bool)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#$%&*@^~<>={}[]\\/_+", b".,;:'\"()-", b" \t")):
    _KINDS[list(_chars), _i] = True


def lines_of(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last byte offsets of all lines, and the first line of every text; an empty text has one empty line."""
    breaks = np.flatnonzero(texts.data == 10)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]))
    # A break at the very end of a text is followed by an empty line of this text, at the offset where the next begins.
    owner = np.sort(np.concatenate([np.arange(len(texts)), np.searchsorted(texts.offsets, breaks, "right") - 1]))
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = texts.offsets[1:]
    return starts, np.maximum(ends, starts), first


def line_features(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and the first line of every text."""
    starts, ends, first = lines_of(texts)
    size = (ends - starts).astype(np.float64)
    n = np.maximum(size, 1)
    x = np.zeros((len(starts), BASE), np.float32)
    sums = np.zeros(len(texts.data) + 1, np.int32)
    for j in range(7):
        np.cumsum(_KINDS[:, j][texts.data], out=sums[1:])
        x[:, j] = (sums[ends] - sums[starts]) / n
    np.cumsum(texts.data >= 0x80, out=sums[1:])
    x[:, 7] = (sums[ends] - sums[starts]) / n
    words = tx.words_of(texts)
    hashed = tx.hashes(texts, words, lower=True)
    line = np.searchsorted(starts, words.starts, "right") - 1
    count = np.bincount(line, minlength=len(starts))
    k = np.maximum(count, 1)
    same = np.zeros(len(hashed), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (line[1:] == line[:-1])
    x[:, 8] = np.bincount(line, same, len(starts)) / k
    x[:, 9] = np.log1p(size) / 8
    x[:, 10] = np.minimum((size - count + 1) / k, 40) / 20
    ending = texts.data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    x[:, 11] = np.bincount(line, _KINDS[ending][:, [2, 3, 4]].any(1), len(starts)) / k
    # words that were in the text before, and whole lines that were
    order = np.lexsort((hashed, words.text))
    again = np.zeros(len(hashed), bool)
    h, t = hashed[order], words.text[order]
    again[order[1:]] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
    x[:, 12] = np.bincount(line, again, len(starts)) / k
    sequence = np.zeros(len(hashed) + 1, np.uint64)
    np.cumsum(tx.mix(hashed + np.arange(len(hashed), dtype=np.uint64) - np.searchsorted(line, line).astype(np.uint64)), out=sequence[1:])
    bounds = np.searchsorted(line, np.arange(len(starts) + 1))
    whole = sequence[bounds[1:]] - sequence[bounds[:-1]]
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((whole, owner))
    twice = np.zeros(len(starts), bool)
    twice[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    x[:, 13] = twice & (count > 0)
    x[:, 14] = count == 0
    x[:, 15] = np.minimum(count, 4) / 4
    return x, size, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    full = np.zeros((len(x), FEATURES), np.float32)
    full[:, :BASE] = x
    full[1:, BASE:2 * BASE] = x[:-1]
    full[:-1, 2 * BASE:3 * BASE] = x[1:]
    starts, ends = first[:-1], first[1:] - 1
    full[starts, BASE:2 * BASE] = 0
    full[ends, 2 * BASE:3 * BASE] = 0
    full[starts, -3] = 1
    full[ends, -2] = 1
    full[:, -1] = 1
    return full


def forward_backward(emission: np.ndarray, first: np.ndarray, chain: np.ndarray):
    """Probability of the good state for every line, and the expected number of each transition. ``emission`` is the score of
    good against bad; texts advance together, the longest first."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, n = first[:-1][order], counts[order]
    steps = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(steps), "left")
    e = np.stack([np.zeros(len(emission)), np.clip(emission, -30, 30)], 1)
    e = np.exp(e - e.max(1, keepdims=True))
    t = np.exp(chain)
    a = np.zeros((len(emission), 2))
    for s in range(steps):
        at = begin[:active[s]] + s
        v = e[at] * (a[at - 1] @ t if s else 1.0)
        a[at] = v / v.sum(1, keepdims=True)
    b = np.ones((len(emission), 2))
    for s in range(steps - 2, -1, -1):
        at = begin[:active[s + 1]] + s
        v = (b[at + 1] * e[at + 1]) @ t.T
        b[at] = v / v.sum(1, keepdims=True)
    p = a * b
    p /= p.sum(1, keepdims=True)
    inner = np.ones(len(emission), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    pair = a[at - 1][:, :, None] * t[None] * (e[at] * b[at])[:, None, :]
    pair /= np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)
    return p[:, 1], pair.sum(0)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    chain: np.ndarray
    curve: tuple[float, float]
    constant: float | None = None

    def share(self, texts: tx.Texts) -> np.ndarray:
        """Share of good text in every text."""
        x, size, first = line_features(texts)
        good, _ = forward_backward(((with_neighbours(x, first) - self.mean) / self.scale) @ self.weights, first, self.chain)
        return _weighted(good, size, first)

    def score(self, texts: tx.Texts) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-(self.curve[0] * _logit(self.share(texts)) + self.curve[1])))


def _weighted(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    weight = size + 1
    return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]) if len(first) > 1 else np.zeros(0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(parts: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Fit on texts given as (line features, line lengths, label)."""
    labels = np.array([y for _, _, y in parts], float)
    if not len(labels) or labels.min() == labels.max():
        return Model(*[np.zeros(0)] * 4, (1.0, 0.0), float(labels.mean()) if len(labels) else 0.5)
    counts = np.array([len(x) for x, _, _ in parts])
    first = tx.offsets_of(counts)
    full = with_neighbours(np.concatenate([x for x, _, _ in parts]), first)
    mean, scale = full.mean(0), full.std(0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    full = (full - mean) / scale
    y = np.repeat(labels, counts)
    # A text counts once, however many lines it has, up to the square root of their number.
    own = np.repeat(1 / np.sqrt(counts), counts)
    own = own / own.mean()
    w, chain = np.zeros(FEATURES), np.zeros((2, 2))
    inner = np.ones(len(y), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, chain = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        p, pairs = forward_backward(full @ w, first, chain)
        grad = np.concatenate([full.T @ ((p - y) * own) / len(y) + 1e-4 * w, ((pairs - seen) / len(y) + 1e-2 * chain).ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    w, chain = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
    good, _ = forward_backward(full @ w, first, chain)
    z = _logit(_weighted(good, np.concatenate([s for _, s, _ in parts]), first))
    a, b = 1.0, 0.0
    for _ in range(30):  # Newton steps of a logistic curve
        q = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([((q - labels) * z).sum() + 1e-3 * (a - 1), (q - labels).sum()])
        d = q * (1 - q) + 1e-9
        h = np.array([[(d * z * z).sum() + 1e-3, (d * z).sum()], [(d * z).sum(), d.sum() + 1e-3]])
        change = np.linalg.solve(h, g)
        a, b = a - np.clip(change[0], -1, 1), b - np.clip(change[1], -1, 1)
    return Model(mean, scale, w, chain, (float(max(a, 0.0)), float(b)))


SAMPLE = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("features", pa.binary()), ("sizes", pa.binary())])


def _featured(batches):
    for batch, texts in tx.slices(batches):
        x, size, first = line_features(texts)
        yield tx.batch_of(SAMPLE, batch.column("doc_id"), batch.column("quality"), [x[i:j].tobytes() for i, j in zip(first[:-1], first[1:])],
                          [size[i:j].tobytes() for i, j in zip(first[:-1], first[1:])])


SCORED = pa.schema([("score", pa.float64())])


def remainder(column: str, modulus: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def fit(docs: DataFrame, labels: DataFrame, held_out=None, limit: int = TRAIN_DOCS) -> Model:
    """Model of a bounded sample of labelled documents; ``held_out`` is a condition on doc_id for rows not to learn from."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    if held_out is not None:
        usable = usable.where(~held_out)
    # one row per document (its largest label, should there be several), at most ``limit`` rows: small enough to broadcast
    chosen = usable.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(
        _featured, "doc_id long, quality int, features binary, sizes binary")
    parts, ids = [], set()
    for r in sorted(rows.collect(), key=lambda r: (r.doc_id, bytes(r.features))):
        if r.doc_id not in ids:  # of a repeated id one row
            ids.add(r.doc_id)
            parts.append((np.frombuffer(r.features, np.float32).reshape(-1, BASE), np.frombuffer(r.sizes, np.float64), r.quality))
    return train(parts)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of ``docs`` with a column ``name`` after them, replacing one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(name)
    kind = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches):
        for batch, texts in tx.slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(texts))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, kind)
