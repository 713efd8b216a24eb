"""Exact substring dedup: words covered by windows that also start in an earlier document are removed.

A window is ``WINDOW`` consecutive words. Suffix automata of reference shards decide which windows repeat: a shard holds
passages of a bounded number of words, its automaton knows for every substring the smallest document it occurs in, and passages are streamed through it
for their matching statistics; where the match is at least a window long and the smallest document is an earlier one, the window goes.

A shard sees only passages that can match it. The smallest hash of the word sequences of ``GRAM`` words in a window is
its anchor, equal windows have equal anchors, and consecutive windows with one anchor form a passage of about 16 words. Anchors
found in one document only are dropped at once. The passages of the others are grouped by anchor, equal passages once with
their smallest document, and groups fill shards. Shipping every shard to every document would cost the square of
the corpus, so a shard gets its passages by the shuffle instead of a broadcast. Windows of an anchor that more than
``MANY`` documents share (a common line in ever new surroundings) are counted one by one with partial sums.

Contract: null and empty texts have no words and lose none. Rows with a null doc_id lose nothing and are no reason for a
loss. Rows with equal doc_id do not count as earlier for each other. Words are compared as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import text as tx
from demandloom.llm.graph import compact
from demandloom.session import cut

WINDOW = 13
GRAM = 6
MANY = 256
SHARD_WORDS = 40_000
BROADCAST_IDS = 500_000

PAIRED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])


def anchors(hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of every window and the number of windows of every text."""
    counts = np.maximum(np.diff(first) - WINDOW + 1, 0)
    n = len(hashed) - GRAM + 1
    if n <= 0 or not counts.any():
        return np.zeros(0, np.uint64), counts
    rolled = hashed[:n].copy()
    for j in range(1, GRAM):
        rolled *= np.uint64(0xD1342543DE82EF95)
        rolled += hashed[j:n + j]
    least, width = tx.mix(rolled), 1
    while width < WINDOW - GRAM + 1:
        step = min(width, WINDOW - GRAM + 1 - width)
        least = np.minimum(least[:len(least) - step], least[step:])
        width += step
    return least[tx.spans(first[:-1], counts)], counts


def _anchor_rows(batches):
    for batch, texts in tx.slices(batches):
        words = tx.words_of(texts)
        least, counts = anchors(tx.hashes(texts, words), words.first)
        owner = np.repeat(np.arange(len(counts)), counts)
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        least, owner = least[new], owner[new]
        order = np.lexsort((least, owner))
        least, owner = least[order], owner[order]
        new = np.ones(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        yield tx.batch_of(PAIRED, least[new].view(np.int64), batch.column("doc_id").take(pa.array(owner[new])))


def _shared(batches):
    """Of rows sorted by (key, doc_id), those whose key occurs in several documents. The last key is carried over: one row, and
    whether it has gone out."""
    key, doc, out = None, None, False
    for batch in batches:
        k, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if key is not None:
            k, d = np.concatenate([[key], k]), np.concatenate([[doc], d])
        if not len(k):
            continue
        keep = np.zeros(len(k), bool)
        pair = (k[1:] == k[:-1]) & (d[1:] != d[:-1])
        # a repeated row of one document goes with the first of them
        keep[1:] |= pair
        keep[:-1] |= pair
        gone = np.zeros(len(k), bool)
        if key is not None and out:
            gone[0] = True
        show = keep & ~gone
        yield tx.batch_of(PAIRED, k[show], d[show])
        out = bool(keep[-1]) or (len(k) == 1 and out) or (out and key is not None and k[-1] == key and d[-1] == doc)
        key, doc = k[-1], d[-1]


PASSAGE = pa.schema([
    ("key", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("doc_id", pa.int64()), ("same", pa.int64()), ("start", pa.int32()),
    ("words", pa.binary()),
])
PASSAGE_DDL = "key long, f1 long, f2 long, doc_id long, same long, start int, words binary"
LONGEST = WINDOW - GRAM + 1


def _passages(batches):
    """Passages of the shared anchors of each text; of an anchor with many documents, its single windows without words."""
    for batch, texts in tx.slices(batches):
        words = tx.words_of(texts)
        hashed = tx.hashes(texts, words)
        least, counts = anchors(hashed, words.first)
        owner = np.repeat(np.arange(len(counts)), counts)
        lists = batch.column("keys")
        sizes = np.diff(lists.offsets.to_numpy())
        salt = tx.mix(np.arange(1, len(counts) + 1, dtype=np.uint64))
        wanted = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.repeat(salt, sizes)
        many = batch.column("many").flatten().to_numpy(zero_copy_only=False).astype(bool)
        own = least ^ salt[owner]
        order = np.argsort(wanted)
        place = np.minimum(np.searchsorted(wanted[order], own), max(len(wanted) - 1, 0))
        keep = wanted[order][place] == own if len(wanted) else np.zeros(len(own), bool)
        single = np.zeros(len(own), bool)
        single[keep] = many[order][place[keep]]
        at = np.flatnonzero(keep)
        if not len(at):
            continue
        inside = at - (np.cumsum(counts) - counts)[owner[at]]  # window in its text
        joined = np.zeros(len(at), bool)
        joined[1:] = (at[1:] == at[:-1] + 1) & (own[at][1:] == own[at][:-1]) & ~single[at][1:]
        begin = np.flatnonzero(~joined)
        length = np.diff(np.append(begin, len(at)))
        # long runs of one anchor (repetitive text) are cut
        pieces = -(-length // LONGEST)
        number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(LONGEST, np.repeat(length, pieces) - number * LONGEST)
        row = np.repeat(begin, pieces) + number * LONGEST
        text = owner[at[row]]
        word = words.first[text] + inside[row]
        f1, f2 = _sequence(hashed, word, size + WINDOW - 1)
        raw, starts, ends = texts.data.tobytes(), words.starts[word], words.ends[word + size + WINDOW - 2]
        lone = single[at[row]]
        yield tx.batch_of(
            PASSAGE, np.where(lone, np.uint64(0), least[at[row]]).view(np.int64), f1, f2, batch.column("doc_id").take(pa.array(text)),
            batch.column("same").take(pa.array(text)), inside[row],
            tx.blobs([None if x else raw[i:j] for i, j, x in zip(starts.tolist(), ends.tolist(), lone.tolist())]),
        )


def _sequence(hashed: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of word sequences."""
    out = []
    for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        sums = np.zeros(len(hashed) + 1, np.uint64)
        np.cumsum(tx.mix(hashed ^ np.uint64(seed)) * tx.powers(tx._BASE, len(hashed)), out=sums[1:])
        out.append(tx.mix((sums[begin + size] - sums[begin]) * tx.powers(tx._INVERSE, len(hashed) + 1)[begin] + size.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


class SuffixAutomaton:
    """Automaton of all substrings of some word sequences, with the smallest label of the sequences each occurs in."""

    def __init__(self, sequences: list[list[int]], labels: list[int]):
        self.next: list[dict] = [{}]
        self.link, self.length, self.low = [-1], [0], [1 << 62]
        for words, label in zip(sequences, labels):
            state = 0
            for w in words:
                state = self._extend(state, w)
                if label < self.low[state]:
                    self.low[state] = label
        low, link = self.low, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist():
            up = link[state]
            if up >= 0 and low[state] < low[up]:
                low[up] = low[state]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(w, -1)
        if q >= 0:
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        self.low.append(1 << 62)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: int) -> int:
        nxt, link = self.next, self.link
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        self.length.append(self.length[p] + 1)
        self.low.append(1 << 62)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def matches(self, words: list[int], size: int) -> list[int]:
        """For every place where the longest match reaches ``size`` words, the smallest label of the last ``size`` words; 1 << 62 elsewhere."""
        nxt, link, length, low = self.next, self.link, self.length, self.low
        state, n, out = 0, 0, []
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            state = nxt[state].get(w, 0)
            n = n + 1 if state else 0
            if n > size:
                n = size
            while state and length[link[state]] >= n and link[state]:
                state = link[state]
            if i >= size - 1:
                out.append(low[state] if n >= size else 1 << 62)
        return out


JUDGED = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("low", pa.list_(pa.int64()))])


def _judge(batches):
    """Smallest document of every window of every passage. Rows come sorted by anchor; a shard is full at SHARD_WORDS words, at the end
    of an anchor's group."""
    def judged(rows):
        number: dict[bytes, int] = {}
        sequences = [[number.setdefault(w, len(number)) for w in r[3].split()] for r in rows]
        automaton = SuffixAutomaton(sequences, [r[4] for r in rows])
        low = [automaton.matches(s, WINDOW) for s in sequences]
        return tx.batch_of(JUDGED, [r[1] for r in rows], [r[2] for r in rows], low)

    held, total, last = [], 0, None
    for batch in batches:
        lone = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "f1", "f2", "words", "low"))):
            if row[3] is None:
                lone.append(row)
                continue
            if total >= SHARD_WORDS and row[0] != last:
                yield judged(held)
                held, total = [], 0
            held.append(row)
            total += WINDOW + 3
            last = row[0]
        if lone:
            yield tx.batch_of(JUDGED, [r[1] for r in lone], [r[2] for r in lone], [[r[4]] for r in lone])
    if held:
        yield judged(held)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remaining(batches):
    """Kept words of every text, by the (start, mask) marks of its repeated windows."""
    for batch, texts in tx.slices(batches):
        words = tx.words_of(texts)
        covered = np.zeros(len(words.starts) + 1, np.int64)
        for i, marks in enumerate(batch.column("marks").to_pylist()) if "marks" in batch.schema.names else ():
            for m in marks or ():
                for bit in range(LONGEST):
                    if m["mask"] >> bit & 1:
                        at = words.first[i] + m["start"] + bit
                        covered[at] += 1
                        covered[at + WINDOW] -= 1
        gone = np.cumsum(covered)[:-1] > 0
        raw, starts, ends = texts.data.tobytes(), words.starts.tolist(), words.ends.tolist()
        removed, digests = [], []
        for i, j in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            keep = np.flatnonzero(~gone[i:j]) + i
            removed.append(j - i - len(keep))
            digests.append(hashlib.sha256(b" ".join([raw[starts[w]:ends[w]] for w in keep.tolist()])).hexdigest())
        yield tx.batch_of(RESULT, batch.column("doc_id"), words.counts, removed, digests)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs`` (doc_id, text)."""
    tx.small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    known = docs.where("doc_id IS NOT NULL")
    rows = known.mapInArrow(_anchor_rows, "key long, doc_id long").repartition("key").sortWithinPartitions("key", "doc_id")
    shared = compact(rows.mapInArrow(_shared, "key long, doc_id long"))
    hot = shared.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("key", F.lit(True).alias("many"))
    lists = compact(
        shared.join(hot, "key", "left").groupBy("doc_id").agg(F.collect_list(F.struct("key", F.coalesce("many", F.lit(False)).alias("many"))).alias("k"))
        .select("doc_id", F.col("k.key").alias("keys"), F.col("k.many").alias("many"))
    )  # a document's own anchors
    marked = known.withColumn("same", F.xxhash64("text"))
    passages = compact(_matching(marked, lists).join(lists, "doc_id").select("doc_id", "text", "same", "keys", "many").mapInArrow(_passages, PASSAGE_DDL))
    # dealt by anchor before equal passages become one, so that their words travel once; single windows have no words and are dealt by themselves
    dealt = passages.withColumn("deal", F.when(F.col("words").isNull(), F.col("f1"))).repartition("key", "deal")
    distinct = dealt.groupBy("key", "deal", "f1", "f2").agg(F.min("doc_id").alias("low"), F.first("words").alias("words"))
    judged = distinct.drop("deal").sortWithinPartitions("key").mapInArrow(_judge, "f1 long, f2 long, low array<long>")
    mask = F.aggregate(F.transform("low", lambda low, i: F.when(low < F.col("doc_id"), F.call_function("shiftleft", F.lit(1), i)).otherwise(0)),
                       F.lit(0), lambda acc, b: acc + b)
    found = passages.select("f1", "f2", "doc_id", "same", "start").join(judged, ["f1", "f2"]).select(
        "doc_id", "same", F.struct("start", mask.alias("mask")).alias("mark")).where("mark.mask > 0")
    marks = cut(found.groupBy("doc_id", "same").agg(F.collect_set("mark").alias("marks")))  # a document's own windows
    ids = marks.select("doc_id").distinct()
    few = ids.count() <= BROADCAST_IDS
    docs = docs.withColumn("same", F.xxhash64("text"))
    if not few:
        return docs.join(marks, ["doc_id", "same"], "left").select("doc_id", "text", "marks").mapInArrow(_remaining, RESULT_DDL)
    touched = docs.join(F.broadcast(ids), "doc_id", "left_semi").join(marks, ["doc_id", "same"], "left")
    others = docs.join(F.broadcast(ids), "doc_id", "left_anti")
    return others.select("doc_id", "text").mapInArrow(_remaining, RESULT_DDL).union(
        touched.select("doc_id", "text", "marks").mapInArrow(_remaining, RESULT_DDL))


def _matching(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows of ``docs`` with an id in ``lists``, without a shuffle while the ids are few."""
    ids = lists.select("doc_id")
    return docs.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= BROADCAST_IDS else docs
