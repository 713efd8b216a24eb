"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased words and one end per text. A token's class is its band of training frequency, all classes having
about the same share of the training tokens, and P(token | context) = P(class | context) * (c + 0.1) / (sum of c + 0.1 over the
class), where tokens never seen share one further place in the rarest class. The class is predicted by a maximum-entropy
model on hashed features: the word before, the word two before (a skip), and both (an n-gram); words seen fewer than ``NAMED`` times
in the whole training count as their class, whatever the size of the input.

Counts cover all training texts. Texts are kept in chunks of tokens with a list of the chunk's distinct tokens; the lists are
dealt by hash to shards, summed there, and the totals go back to the chunks, so a token costs one entry a chunk, however
frequent it is, and no text is shuffled twice. Training goes through all texts in ``ROUNDS`` portions by a hash of doc_id; for each,
tasks sum gradients and curvatures of the weights they touch, Spark adds them up by blocks of weights, and the driver
makes a damped Newton step for every weight. The weight table has a fixed size. Scoring works on blocks of tokens in numpy.

Contract: a null text is an empty one, with its end as only token. A null doc_id is never held out. Rows that repeat a doc_id are
texts of their own. An empty table gives no rows; without training tokens all scores are those of the smoothing alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import text as tx
from demandloom.llm.graph import compact
from demandloom.session import cut

SMOOTH = 0.1
CLASSES = 32
BUCKETS = 1 << 14
BLOCK = 1024
ROUNDS = 4
CHUNK_TOKENS = 500_000
BATCH = 1 << 15
FINE = 8
BINS = 64 * FINE
NAMED = 16
END = np.uint64(0x9AE16A3B2F90404F)
TOTAL = "<u8"  # a token's total may pass 32 bits; its number in a chunk can't

CHUNK = pa.schema([
    ("chunk", pa.int64()), ("turn", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("size", pa.list_(pa.int32())), ("index", pa.binary()),
    ("hash", pa.binary()), ("n", pa.binary()),
])
CHUNK_DDL = "chunk long, turn int, doc_id array<long>, held_out array<boolean>, size array<int>, index binary, hash binary, n binary"


def planes(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Whole numbers byte by byte, all first bytes first: small values leave planes of zeros, which compress away."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, size).T).tobytes()


def values_of(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def tokens(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with the ends, and the number of each text."""
    words = tx.words_of(texts)
    counts = words.counts + 1
    out = np.full(int(counts.sum()), END, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(counts) - 1] = False
    out[is_word] = tx.hashes(texts, words, lower=True)
    return out, counts


def _chunks(batches):
    """Texts of one turn of the training in chunks of their own: which texts learn together does not depend on the input's partitions."""
    number = TaskContext.get().partitionId() << 32
    held: list[list] = [[] for _ in range(ROUNDS)]
    total = [0] * ROUNDS

    def made(turn):
        nonlocal number
        parts, held[turn], total[turn] = held[turn], [], 0
        hashed = np.concatenate([p[0] for p in parts])
        size = np.concatenate([p[1] for p in parts])
        out = [v for p in parts for v in p[3]]
        distinct, index = np.unique(hashed, return_inverse=True)
        learn = ~np.repeat(np.array(out, bool), size)
        n = np.bincount(index[learn], minlength=len(distinct))
        number += 1
        return tx.batch_of(CHUNK, [number], [turn], [[v for p in parts for v in p[2]]], [out], [size.tolist()], [planes(index)],
                           [distinct.tobytes()], [planes(n)])

    for batch, texts in tx.slices(batches):
        hashed, size = tokens(texts)
        turns = batch.column("turn").to_numpy()
        of_token = np.repeat(turns, size)
        for turn in np.unique(turns).tolist():
            rows = batch.filter(pa.array(turns == turn))
            held[turn].append((hashed[of_token == turn], size[turns == turn], rows.column("doc_id").to_pylist(), rows.column("held_out").to_pylist()))
            total[turn] += len(held[turn][-1][0])
            if total[turn] >= CHUNK_TOKENS:
                yield made(turn)
    for turn in range(ROUNDS):
        if held[turn]:
            yield made(turn)


DEALT = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("hash", pa.binary()), ("n", pa.binary())])


def _deal(bits: int):
    def run(batches):
        for batch in batches:
            for chunk, h, n in zip(*(batch.column(c).to_pylist() for c in ("chunk", "hash", "n"))):
                hashed, counts = np.frombuffer(h, np.uint64), values_of(n)
                shard = (hashed >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashed), np.int64)
                at = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, np.int64)
                ends = np.append(at, len(shard))
                rows = list(zip(ends[:-1], ends[1:]))
                yield tx.batch_of(DEALT, shard[at], np.full(len(at), chunk), [hashed[i:j].tobytes() for i, j in rows],
                                  [planes(counts[i:j]) for i, j in rows])
    return run


REPLY = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("c", pa.binary()), ("name", pa.binary()), ("bins", pa.list_(pa.int64()))])


def band(c: np.ndarray) -> np.ndarray:
    """Fine band of a count; 0 holds the count 0."""
    return np.where(c > 0, 1 + np.floor(FINE * np.log2(np.maximum(c, 1))), 0).astype(np.int64)


def _sum_shard(rows: pa.Table) -> pa.Table:
    """Totals of a shard's tokens, sent to every chunk in the order of its own list."""
    hashed = [np.frombuffer(b, np.uint64) for b in rows.column("hash").to_pylist()]
    counts = [values_of(b) for b in rows.column("n").to_pylist()]
    distinct, index = np.unique(np.concatenate(hashed), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, index, np.concatenate(counts).astype(np.int64))
    bins = band(total)
    mass = np.zeros(BINS, np.int64)
    np.add.at(mass, bins, total)
    sums = np.concatenate([np.bincount(bins, minlength=BINS), mass])
    name = np.where(total >= NAMED, distinct >> np.uint64(32), 0).astype(np.uint32)
    ends = tx.offsets_of(np.array(list(map(len, hashed)), np.int64))
    parts = [index[i:j] for i, j in zip(ends[:-1], ends[1:])]
    return pa.Table.from_batches([tx.batch_of(
        REPLY, rows.column("shard").combine_chunks(), rows.column("chunk").combine_chunks(), [planes(total[p], TOTAL) for p in parts],
        [planes(name[p]) for p in parts], [sums.tolist() if i == 0 else None for i in range(len(parts))])])


@dataclass
class Model:
    """Counts by band, the classes made of them, and the weights of P(class | context)."""

    words: np.ndarray
    mass: np.ndarray
    classes: np.ndarray = field(init=False)
    log_inside: np.ndarray = field(init=False)
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        self.n, self.v = int(self.mass.sum()), int(self.words[1:].sum())
        above = self.mass[::-1].cumsum()[::-1] - self.mass / 2
        self.classes = np.minimum((CLASSES * above / max(self.n, 1)).astype(np.int64), CLASSES - 1)
        used = np.flatnonzero(self.words[1:]) + 1
        lowest = int(self.classes[used[0]]) if len(used) else CLASSES - 1
        self.classes[0] = lowest
        inside = np.bincount(self.classes[1:], self.mass[1:] + SMOOTH * self.words[1:], CLASSES)
        inside[lowest] += SMOOTH
        self.log_inside = np.log(np.maximum(inside, 1e-300))
        self.empty = inside == 0
        self.weights = np.zeros((BUCKETS, CLASSES), np.float32)
        share = np.where(self.empty, 1.0, inside / max(inside.sum(), 1e-300))
        self.bias = np.where(self.empty, -1e9, np.log(share)).astype(np.float32)

    def context(self, index: np.ndarray, c: np.ndarray, name: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all tokens of a chunk and their features' buckets; texts begin with an empty context."""
        kind = self.classes[np.minimum(band(c), BINS - 1)]
        word = np.where(c >= NAMED, name.astype(np.uint64) + np.uint64(CLASSES + 1), kind.astype(np.uint64))
        word = tx.mix(word + np.uint64(1))[index]
        first = np.cumsum(size) - size
        one, two = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
        one[1:], two[2:] = word[:-1], word[:-2]
        one[first] = 7
        two[first] = 7
        two[(first + 1)[size > 1]] = 7
        features = np.stack([one, two * np.uint64(3), one * np.uint64(5) + two * np.uint64(9)])
        return kind[index], (tx.mix(features) & np.uint64(BUCKETS - 1)).astype(np.int64)

    def _logits(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[features[0]]
        z += self.weights[features[1]]
        z += self.weights[features[2]]
        z += self.bias
        z -= z.max(1, keepdims=True)
        return z

    def log_classes(self, features: np.ndarray) -> np.ndarray:
        z = self._logits(features)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z

    def gradient(self, kind: np.ndarray, features: np.ndarray, grad: np.ndarray, curve: np.ndarray) -> None:
        """Add observed minus expected class counts, and their variances, of a block of tokens."""
        p = self._logits(features)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        h = p * (1 - p)
        np.negative(p, out=p)
        p[np.arange(len(kind)), kind] += 1
        for f in features:
            order = np.argsort(f.astype(np.uint16), kind="stable")  # buckets fit 16 bits, which numpy sorts by radix
            own = f[order]
            at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            grad[own[at]] += np.add.reduceat(p[order], at)
            curve[own[at]] += np.add.reduceat(h[order], at)


def _columns(batch: pa.RecordBatch):
    for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "size", "index", "c", "name"))):
        doc, out, size, index, c, name = row
        yield (doc, np.array(out, bool), np.array(size, np.int64), values_of(index),
               np.concatenate([values_of(b, TOTAL) for b in c]).astype(np.int64), np.concatenate([values_of(b) for b in name]))


GRADIENT = pa.schema([("block", pa.int32()), ("grad", pa.binary()), ("curve", pa.binary())])


def _gradients(model):
    def run(batches):
        # in double precision, so that sums don't depend on the number of tasks
        grad, curve, used = np.zeros((BUCKETS, CLASSES)), np.zeros((BUCKETS, CLASSES)), False
        for batch in batches:
            for _, out, size, index, c, name in _columns(batch):
                kind, features = model.value.context(index, c, name, size)
                at = np.flatnonzero(~np.repeat(out, size))
                for i in range(0, len(at), BATCH):
                    model.value.gradient(kind[at[i:i + BATCH]], features[:, at[i:i + BATCH]], grad, curve)
                    used = True
        if used:
            for b in range(BUCKETS // BLOCK):
                part = slice(b * BLOCK, (b + 1) * BLOCK)
                yield tx.batch_of(GRADIENT, [b], [grad[part].astype(np.float32).tobytes()], [curve[part].astype(np.float32).tobytes()])
    return run


def _add_up(rows: pa.Table) -> pa.Table:
    total = [np.zeros(BLOCK * CLASSES), np.zeros(BLOCK * CLASSES)]
    for c in (0, 1):
        for b in rows.column(1 + c).to_pylist():
            total[c] += np.frombuffer(b, np.float32)
    return pa.Table.from_batches([tx.batch_of(GRADIENT, rows.column(0).combine_chunks()[:1], *[[t.astype(np.float32).tobytes()] for t in total])])


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                    ("score", pa.float64())])


def _scores(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for doc, out, size, index, c, name in _columns(batch):
                kind, features = m.context(index, c, name, size)
                inside = np.log(c + SMOOTH)
                base = (inside - np.log(m.n + SMOOTH * (m.v + 1)))[index]
                score = inside[index] - m.log_inside[kind]
                for i in range(0, len(index), BATCH):
                    part = slice(i, i + BATCH)
                    score[part] += m.log_classes(features[:, part])[np.arange(len(kind[part])), kind[part]]
                at = np.cumsum(size) - size
                yield tx.batch_of(SCORED, doc, out, size, np.add.reduceat((c > 0)[index].astype(np.int64), at),
                                  np.add.reduceat(base, at) / np.log(10), np.add.reduceat(score, at) / np.log(10))
    return run


def counted_chunks(docs: DataFrame) -> tuple[DataFrame, Model]:
    """Chunks of ``docs`` (doc_id, text, held_out) with the training counts of their tokens, and a model with these counts."""
    tx.small_batches(docs.sparkSession)
    turn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(ROUNDS)).cast("int")
    chunks = compact(docs.select("doc_id", "text", "held_out", turn.alias("turn")).mapInArrow(_chunks, CHUNK_DDL))
    bits = max(0, (max(chunks.count() // 4, 1) - 1).bit_length() + 2)
    dealt = chunks.select("chunk", "hash", "n").mapInArrow(_deal(bits), "shard long, chunk long, hash binary, n binary")
    reply = cut(dealt.groupBy("shard").applyInArrow(_sum_shard, "shard long, chunk long, c binary, name binary, bins array<long>"))
    sums = np.zeros(2 * BINS, np.int64)
    at = reply.where("bins IS NOT NULL").select(F.posexplode("bins").alias("i", "n")).where("n > 0")
    for i, n in at.groupBy("i").agg(F.sum("n")).collect():  # one row a band at most
        sums[i] = n
    back = reply.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "c", "name"))).alias("r"))  # no longer than a chunk
    counted = compact(chunks.drop("hash", "n").join(back.select("chunk", F.col("r.c").alias("c"), F.col("r.name").alias("name")), "chunk"))
    return counted, Model(sums[:BINS], sums[BINS:])


def train(counted: DataFrame, model: Model) -> Model:
    context = counted.sparkSession.sparkContext
    for turn in range(ROUNDS if model.n else 0):
        shared = context.broadcast(model)
        portion = counted.where(F.col("turn") == turn)
        sums = portion.mapInArrow(_gradients(shared), "block int, grad binary, curve binary").groupBy("block").applyInArrow(
            _add_up, "block int, grad binary, curve binary")
        for row in sums.toLocalIterator():
            part = slice(row.block * BLOCK, (row.block + 1) * BLOCK)
            grad = np.frombuffer(row.grad, np.float32).reshape(BLOCK, CLASSES)
            curve = np.frombuffer(row.curve, np.float32).reshape(BLOCK, CLASSES)
            # three features share a step; the constant keeps weights of rare contexts small
            step = (grad - 0.5 * model.weights[part]) / (curve + 1.0)
            model.weights[part] += np.clip(step / (1.5 if turn else 2.0), -1.5, 1.5)
    return model


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of docs (doc_id, text, held_out)."""
    counted, model = counted_chunks(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(counted, model))
    rows = counted.mapInArrow(
        _scores(shared), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score")
