"""Benchmark decontamination: BM25 retrieval of test items with block-max WAND, and a check of question and answer.

Test items are indexed by word in shards of bounded size; a shard holds items of similar length, so its passages have one
length, twice its longest item, and start every half passage: each stretch as long as an item lies within one passage.
Every passage of every document is a query. Its distinct words, weighted by BM25, are matched against the items; an item
passes if its score is at least ``RATIO`` of the score of the item's own words. Scores are divided by that threshold, so
the threshold is 1 for all items. The sum of the words' largest possible scores bounds a passage's score and lets most
passages go unsearched; the others are searched by WAND with score bounds per block of postings. Nothing above the
threshold is missed.

A retrieved item counts as leaked if at least ``OVERLAP`` of the question's five-word sequences and ``ANSWER`` of the answer's words
are in the passage. The answer is the item's last sentence, or the last quarter of an item of one sentence.

Contract: items that are null or have no words are never found. Null or empty texts hold no item. Rows with a null doc_id are
reported under null. Letters A-Z count as lower case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import text as tx

RATIO = 0.6
OVERLAP = 0.8
ANSWER = 0.5
GRAM = 5
SHARD_ITEMS = 20_000
BLOCK = 64
BOUND_VALUES = 4_000_000
K1, B = 1.2, 0.75

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    words = _WORD.findall(text.translate(_LOWER))
    ends = [i for i, w in enumerate(words[:-1]) if w[-1] in ".?!:"]
    cut = ends[-1] + 1 if ends else len(words) - max(1, len(words) // 4)
    return (words[:cut], words[cut:]) if cut else (words, words)


def _sequences(words: list[str]) -> set[tuple]:
    size = min(GRAM, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


@dataclass
class Shard:
    """Inverted index of some items. Postings of a term: item positions ascending, scores, and the largest score of each block."""

    ids: list[int]
    texts: list[str]
    passage: int = 0
    terms: np.ndarray = field(default=None)
    best: np.ndarray = field(default=None)
    items: list[np.ndarray] = field(default_factory=list)
    scores: list[np.ndarray] = field(default_factory=list)
    blocks: list[np.ndarray] = field(default_factory=list)

    def build(self, seen_in: dict[int, int], total: int, mean: float) -> Shard:
        """``seen_in``: number of items of the whole benchmark that hold a term."""
        column = tx.texts_of(pa.array(self.texts, pa.large_string()))
        words = tx.words_of(column)
        hashed = tx.hashes(column, words, lower=True)
        lengths = words.counts
        self.passage = 2 * int(lengths.max(initial=1))
        item = words.text
        order = np.lexsort((item, hashed))
        h, d = hashed[order], item[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
        at = np.flatnonzero(new)
        tf = np.diff(np.concatenate([at, [len(h)]]))
        h, d = h[at], d[at]
        n = np.array([seen_in[int(x)] for x in h])
        score = np.log(1 + (total - n + 0.5) / (n + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[d] / mean))
        whole = np.bincount(d, score, len(self.ids))
        score = score / (RATIO * whole[d])
        self.terms, first = np.unique(h, return_index=True)
        ends = np.append(first, len(h))
        for i, j in zip(ends[:-1], ends[1:]):
            self.items.append(d[i:j])
            self.scores.append(score[i:j])
            self.blocks.append(np.maximum.reduceat(score[i:j], np.arange(0, j - i, BLOCK)))
        self.best = np.array([b.max() for b in self.blocks])
        # Items in blocks for all terms at once: a bound on the score of any item of a block, for whole passages.
        blocks = max(1, min(len(self.ids), 256, BOUND_VALUES // max(1, len(self.terms))))
        self.bound = np.zeros((len(self.terms), blocks), np.float32)
        term = np.repeat(np.arange(len(self.terms)), np.diff(ends))
        np.maximum.at(self.bound, (term, d * blocks // len(self.ids)), (score * (1 + 1e-6)).astype(np.float32))
        self.sides = [question_and_answer(t) for t in self.texts]
        mask = np.zeros(1 << 16, bool)
        mask[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.mask = mask
        return self

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """Position of every word among the terms, -1 if it is none."""
        out = np.full(len(hashed), -1, np.int64)
        maybe = np.flatnonzero(self.mask[(hashed & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.terms, hashed[maybe]), len(self.terms) - 1)
        good = self.terms[place] == hashed[maybe]
        out[maybe[good]] = place[good]
        return out

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Items whose score is at least 1 for a query of distinct terms."""
        lists = [[self.items[t], self.scores[t], self.blocks[t], 0, self.best[t]] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda c: c[0][c[3]])
            bound, pivot = 0.0, -1
            for i, c in enumerate(lists):
                bound += c[4]
                if bound >= 1 - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][3]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][3]] == item:
                pivot += 1
            if lists[0][0][lists[0][3]] == item:
                near = sum(c[2][c[3] // BLOCK] for c in lists[:pivot + 1])
                if near >= 1 - 1e-9:
                    score = sum(c[1][c[3]] for c in lists[:pivot + 1])
                    if score >= 1 - 1e-9:
                        found.append((int(item), float(score)))
                    goal = item + 1
                else:
                    # no item before the end of the shortest of these blocks, or before the next list's item, can pass
                    goal = min(c[0][min(len(c[0]), (c[3] // BLOCK + 1) * BLOCK) - 1] + 1 for c in lists[:pivot + 1])
                    if pivot + 1 < len(lists):
                        goal = min(goal, lists[pivot + 1][0][lists[pivot + 1][3]])
                    goal = max(goal, item + 1)
                moved = lists[:pivot + 1]
            else:
                goal, moved = item, [c for c in lists[:pivot] if c[0][c[3]] < item]
            for c in moved:
                c[3] += int(np.searchsorted(c[0][c[3]:], goal)) if len(c[0]) - c[3] > 8 else int((c[0][c[3]:] < goal).sum())
            lists = [c for c in lists if c[3] < len(c[0])]
        return found

    def overlap(self, item: int, words: list[str]) -> tuple[float, float]:
        question, answer = self.sides[item]
        grams = _sequences(question)
        have = {tuple(words[i:i + len(next(iter(grams)))]) for i in range(len(words))} if grams else set()
        own = set(words)
        return len(grams & have) / max(1, len(grams)), sum(w in own for w in set(answer)) / max(1, len(set(answer)))

    def leaks(self, texts: tx.Texts, words: tx.Words, hashed: np.ndarray):
        """(text, item, score, question overlap, first word of the passage) of every item found in a text, at its best passage."""
        place = self.find(hashed)
        worth = np.where(place >= 0, self.best[np.maximum(place, 0)], 0.0)
        half = self.passage // 2
        counts = words.counts
        parts = np.maximum(1, -(-counts // half))
        owner = np.repeat(np.arange(len(counts)), parts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = words.first[:-1][owner] + number * half
        end = np.minimum(begin + self.passage, words.first[1:][owner])
        sums = np.concatenate([[0.0], np.cumsum(worth)])
        likely = np.flatnonzero(sums[end] - sums[begin] >= 1 - 1e-6)
        best: dict[tuple[int, int], tuple] = {}
        for p in likely:
            terms = np.unique(place[begin[p]:end[p]])
            terms = terms[terms >= 0]
            if self.bound[terms].sum(0).max(initial=0) < 1 - 1e-4:
                continue
            found = self.search(terms)
            if not found:
                continue
            raw = texts.data[words.starts[begin[p]]:words.ends[end[p] - 1]].tobytes().decode("utf-8", "replace")
            own = _WORD.findall(raw.translate(_LOWER))
            for item, score in found:
                question, answer = self.overlap(item, own)
                if question >= OVERLAP and answer >= ANSWER:
                    key = (int(owner[p]), item)
                    best[key] = max(best.get(key, (-1.0,)), (question, score, int(number[p]) * half))
        return [(t, self.ids[i], s, q, w) for (t, i), (q, s, w) in best.items()]


def shards(benchmark: DataFrame, text: str = "text") -> list[list[tuple[int, str]]]:
    """Items in shards of at most SHARD_ITEMS and of similar length. The benchmark's distinct items come to the driver: test
    sets are small by nature, and ``build_shards`` refuses more than ``most`` of them."""
    rows = benchmark.where("item_id IS NOT NULL").select("item_id", F.coalesce(text, F.lit("")).alias("text")).distinct().collect()
    sized = sorted(((len(_WORD.findall(r.text)), r.item_id, r.text) for r in rows))
    out: list[list[tuple[int, str]]] = []
    longest = 0
    for n, item, t in sized:
        if not n:
            continue
        if not out or len(out[-1]) >= SHARD_ITEMS or n > 2 * longest and n > 64:
            out.append([])
            longest = max(n, 32)
        out[-1].append((item, t))
    return out


def build_shards(benchmark: DataFrame, most: int = 1_000_000) -> list[Shard]:
    count = benchmark.count()
    if count > most:
        raise ValueError(f"{count} test items; split the benchmark into tables of at most {most} and join the results")
    groups = shards(benchmark)
    seen_in: dict[int, int] = {}
    total, length = 0, 0
    for g in groups:
        column = tx.texts_of(pa.array([t for _, t in g], pa.large_string()))
        words = tx.words_of(column)
        hashed = tx.hashes(column, words, lower=True)
        length += len(hashed)
        total += len(g)
        for i in range(len(g)):
            for h in np.unique(hashed[words.first[i]:words.first[i + 1]]).tolist():
                seen_in[h] = seen_in.get(h, 0) + 1
    return [Shard([i for i, _ in g], [t for _, t in g]).build(seen_in, total, length / max(total, 1)) for g in groups]


LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("overlap", pa.float64()), ("word", pa.int64())])


def _all_leaks(index: list[Shard], texts: tx.Texts):
    words = tx.words_of(texts)
    hashed = tx.hashes(texts, words, lower=True)
    return [x for shard in index for x in shard.leaks(texts, words, hashed)]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap, word) for every document and item found in it; score is BM25 over the threshold, word the
    first word of the passage."""
    index = docs.sparkSession.sparkContext.broadcast(build_shards(benchmark))

    def run(batches):
        for batch, texts in tx.slices(batches):
            found = _all_leaks(index.value, texts)
            ids = batch.column("doc_id").to_pylist()
            yield tx.batch_of(LEAK, [ids[t] for t, *_ in found], *([x[j] for x in found] for j in (1, 2, 3, 4)))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, score double, overlap double, word long")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no item was found, with all their columns."""
    index = docs.sparkSession.sparkContext.broadcast(build_shards(benchmark))

    def run(batches):
        for batch, texts in tx.slices(batches):
            keep = np.ones(batch.num_rows, bool)
            keep[[t for t, *_ in _all_leaks(index.value, texts)]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
