"""Distinct sampled segmentations of texts into pieces: Gumbel top-k without replacement over the lattice.

The lattice of a part has its characters as nodes and pieces as edges; backward sums give every edge its probability given
its start. A text's segmentations form a tree of edges, from the first part to the last. Each text has a root value drawn
from Gumbel(0). A child's value is Gumbel-distributed around its log probability, on the condition that the largest child
has its parent's value; so following the largest children from the best open node leads to the next best segmentation, and
the k segmentations with the largest values are a sample without replacement. This is A* search with perturbed
values: the queue holds the siblings along the paths taken. Values of all nodes of a path are drawn together, for all texts of a slice.

Uniforms are hashes of (row key, path, part, step, edge), so a row gives the same sample wherever and however often it is
computed. The inclusion score of a segmentation with log probability p is log(1 - exp(-exp(p - kappa))), with the value kappa
of the best segmentation left out; weights exp(p - score) make sums over the sample unbiased.

Contract: null and empty texts have the one segmentation without pieces. A text with fewer than k segmentations gives all of
them, with inclusion score 0. Null row keys count as one key. Decoding gives the text back; U+2581 in a text becomes
a space, as in SentencePiece.
"""

from __future__ import annotations

import heapq
import itertools
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from demandloom.llm import text as tx
from demandloom.llm.pieces import Pieces, pieces

SLICE = 1 << 19
HEAD = 192
FAR = 32.0


@dataclass
class Tables:
    """Lattices of the distinct parts of a slice: nodes one after the other, and the edges of each node."""

    first: np.ndarray
    degree: np.ndarray
    begin: np.ndarray
    target: np.ndarray
    id: np.ndarray
    logp: np.ndarray
    ladder: np.ndarray  # node number plus the cumulative probability of its edges
    likely: np.ndarray  # probability of a node's first edge


class Lattice:
    """Lattices of distinct parts, built for all parts of a slice at once."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        # All beginnings of pieces, so that a search ends where no piece goes on; id -1 where a beginning is no piece itself.
        names = list(dict.fromkeys(name[:n] for name in vocabulary.id for n in range(1, len(name) + 1)))
        size = np.array(list(map(len, names)), np.int64)
        self.hash = self._hash(*self._sums("".join(names)), tx.offsets_of(size)[:-1], size)
        self.ids = np.array([vocabulary.id.get(n, -1) for n in names], np.int32)
        self.scores = np.array([vocabulary.score.get(n, 0.0) for n in names])
        # The last name of every slot of hashes, and before each name the one that shares its slot.
        slots = (self.hash >> np.uint64(44)).astype(np.int64)
        self.slot = np.full(1 << 20, -1, np.int32)
        self.slot[slots] = np.arange(len(names))
        self.before = np.full(len(names), -1, np.int32)
        order = np.lexsort((self.slot[slots] == np.arange(len(names)), slots))
        same = np.flatnonzero(slots[order][1:] == slots[order][:-1])
        self.before[order[same + 1]] = order[same]
        self.byte_id = np.array(vocabulary.byte_id, np.int32)

    @staticmethod
    def _sums(joined: str):
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(tx.mix(points.astype(np.uint64) + np.uint64(1)) * tx.powers(tx._BASE, len(points)), out=sums[1:])
        return points, sums

    @staticmethod
    def _hash(points: np.ndarray, sums: np.ndarray, begin: np.ndarray, size) -> np.ndarray:
        return tx.mix((sums[begin + size] - sums[begin]) * tx.powers(tx._INVERSE, len(points) + 1)[begin])

    def _places(self, hashed: np.ndarray) -> np.ndarray:
        """Numbers of the beginnings with given hashes, -1 where there is none."""
        place = self.slot[(hashed >> np.uint64(44)).astype(np.int64)]
        wrong = np.flatnonzero(place >= 0)
        wrong = wrong[self.hash[place[wrong]] != hashed[wrong]]
        while len(wrong):
            place[wrong] = self.before[place[wrong]]
            wrong = wrong[place[wrong] >= 0]
            wrong = wrong[self.hash[place[wrong]] != hashed[wrong]]
        return place

    def tables(self, parts: list[str]) -> Tables:
        points, sums = self._sums("".join(parts))
        size = np.array(list(map(len, parts)), np.int64)
        number = np.repeat(np.arange(len(parts)), size)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(points))  # characters to the end of the part
        found = []
        single = np.zeros(len(points), bool)
        at = np.arange(len(points))
        for n in range(1, min(self.vocabulary.longest, int(size.max())) + 1):
            if n > 1:
                at = at[left[at] >= n]
            place = self._places(self._hash(points, sums, at, n))
            at, place = at[place >= 0], place[place >= 0]
            whole = self.ids[place] >= 0
            own, place = at[whole], place[whole]
            if n == 1:
                single[own] = True
            found.append((n, own, self.ids[place], self.scores[place]))
        # a character that is no piece: its byte, or minus its code point for several bytes
        other = np.flatnonzero(~single)
        code = points[other].astype(np.int64)
        width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        found.append((1, other, np.where(width == 1, self.byte_id[np.minimum(code, 255)], -code).astype(np.int32), self.vocabulary.last * width))
        first = tx.offsets_of(size + 1)
        node = np.arange(len(points)) + number  # the parts' end nodes lie between
        degree = np.zeros(int(first[-1]), np.int64)
        for _, at, _, _ in found:
            degree[node[at]] += 1
        begin = np.cumsum(degree) - degree
        total = int(degree.sum())
        target, edge, score = np.zeros(total, np.int64), np.zeros(total, np.int32), np.zeros(total)
        free = begin.copy()
        for n, at, ids, scores in sorted(found, key=lambda f: -f[0]):  # the longest edge of a node first, it is the likeliest
            own = node[at]
            place = free[own]
            free[own] += 1
            target[place], edge[place], score[place] = own + n, ids, scores
        after = np.zeros(len(degree))
        logp = np.empty(total)
        by_distance = np.argsort(left.astype(np.uint16) if size.max() < 1 << 16 else left, kind="stable")
        ends = np.searchsorted(left[by_distance], np.arange(1, int(size.max()) + 2))
        for i, j in zip(ends[:-1], ends[1:]):
            own = node[by_distance[i:j]]
            k = degree[own]
            e = tx.spans(begin[own], k)
            value = score[e] + after[target[e]]
            at = np.cumsum(k) - k
            top = np.maximum.reduceat(value, at)
            after[own] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, k)), at))
            logp[e] = value - np.repeat(after[own], k)
        logp[begin[degree == 1]] = 0.0
        cumulative = np.cumsum(np.exp(logp))
        before = np.concatenate([[0.0], cumulative])[begin]
        ladder = cumulative - np.repeat(before, degree) + np.repeat(np.arange(len(degree)), degree)
        likely = np.exp(np.append(logp, 0.0))[np.minimum(begin, len(logp))]
        return Tables(first, degree, begin, target, edge, logp, ladder, likely)


def uniform(key: np.ndarray) -> np.ndarray:
    return ((tx.mix(key) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def gumbel(key: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(key)))


def truncated(values: np.ndarray, top: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Gumbel values below their maximum ``top``, moved so that the maximum becomes ``limit``."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        v = limit - values + np.log1p(-np.exp(np.minimum(values - top, 0)))
        moved = limit - np.maximum(v, 0) - np.log1p(np.exp(-np.abs(v)))
    return np.where(np.isfinite(values) & (values < top), moved, -np.inf)


class Walk:
    """Paths through given parts, from given nodes to the parts' ends. ``row`` numbers the steps part by part. With ``open_too`` the
    values of all edges at the steps are kept (edges, their values, their rows)."""

    def __init__(self, t: Tables, starts: np.ndarray, keys: np.ndarray, open_too: bool):
        node, part, step = starts, np.arange(len(starts)), 0
        alive = t.degree[node] > 0
        node, part = node[alive], part[alive]
        parts, edges, others = [], [], []
        while len(node):
            begin, degree = t.begin[node], t.degree[node]
            edge = begin.copy()
            free = np.flatnonzero(degree > 1)
            key = tx.mix(keys[part[free]] + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            if not open_too:
                u = (key >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
                late = np.flatnonzero(u >= t.likely[node[free]])
                free, u = free[late], u[late]
                found = np.searchsorted(t.ladder, node[free] + u, "right")
                edge[free] = np.clip(found, begin[free], begin[free] + degree[free] - 1)
            elif len(free):
                k = degree[free]
                all_edges = tx.spans(begin[free], k)
                number = all_edges - np.repeat(begin[free], k)
                value = t.logp[all_edges] + gumbel(np.repeat(key, k) + (number + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
                at = np.cumsum(k) - k
                top = np.maximum.reduceat(value, at)
                best = np.where(value == np.repeat(top, k), all_edges, np.iinfo(np.int64).max)
                edge[free] = np.minimum.reduceat(best, at)
                others.append((np.repeat(part[free], k), step, all_edges, value, np.repeat(top, k), np.repeat(edge[free], k)))
            parts.append(part)
            edges.append(edge)
            node = t.target[edge]
            alive = t.degree[node] > 0
            node, part = node[alive], part[alive]
            step += 1
        counts = np.zeros(len(starts), np.int64)
        for p in parts:
            counts[p] += 1
        self.first = tx.offsets_of(counts)
        self.edge = np.zeros(int(self.first[-1]), np.int64)
        for s, (p, e) in enumerate(zip(parts, edges)):
            self.edge[self.first[p] + s] = e
        if open_too:
            rows = [self.first[p] + s for p, s, *_ in others]
            row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            columns = [np.concatenate([o[j] for o in others]) if others else np.zeros(0) for j in (2, 3, 4, 5)]
            sibling = columns[0] != columns[3]
            order = np.flatnonzero(sibling)[np.argsort(row[sibling], kind="stable")]
            self.row, self.other, self.value, self.top = row[order], columns[0][order].astype(np.int64), columns[1][order], columns[2][order]


class Sampler:
    def __init__(self, vocabulary: Pieces, k: int, seed: int):
        self.lattice, self.k, self.seed = Lattice(vocabulary), k, seed

    def sample(self, texts: list[str], keys: np.ndarray):
        """For every text a list of (ids, log probability, value, inclusion score)."""
        split = [self.lattice.vocabulary.parts(t) for t in texts]
        number = dict.fromkeys(itertools.chain.from_iterable(split))
        for i, p in enumerate(number):
            number[p] = i
        t = self.lattice.tables(list(number)) if number else None
        part_of = [np.fromiter(map(number.__getitem__, parts), np.int64, len(parts)) for parts in split]
        root = tx.mix(keys + np.uint64(self.seed))
        out: list[list] = [[] for _ in texts]
        queue: list[list] = [[] for _ in texts]
        for i, value in enumerate(gumbel(root).tolist()):
            if part_of[i].size:
                # an open node: (-value, tie, part, node in it, log probability so far, ids so far)
                queue[i] = [(-value, 0, 0, int(t.first[part_of[i][0]]), 0.0, np.zeros(0, np.int32))]
            else:
                out[i] = [(np.zeros(0, np.int32), 0.0, value)]
        for turn in range(self.k):
            todo = [i for i in range(len(texts)) if queue[i]]
            if todo:
                heads = [heapq.heappop(queue[i]) for i in todo]
                self._turn(t, part_of, root, turn, todo, heads, queue, out)
        results = []
        for rows, left in zip(out, queue):
            kappa = -left[0][0] if left else -math.inf
            results.append([(ids, p, g, inclusion(p, kappa)) for ids, p, g in rows])
        return results

    def _turn(self, t: Tables, part_of, root, turn: int, todo: list[int], heads: list[tuple], queue, out) -> None:
        """Follow the largest children from one open node of each text to the end."""
        size = np.array([len(part_of[i]) - h[2] for i, h in zip(todo, heads)], np.int64)
        ends = tx.offsets_of(size)
        starts = t.first[np.concatenate([part_of[i][h[2]:] for i, h in zip(todo, heads)])]
        starts[ends[:-1]] = [h[3] for h in heads]
        at = np.concatenate([np.arange(h[2], len(part_of[i])) for i, h in zip(todo, heads)]).astype(np.uint64)
        keys = tx.mix(np.repeat(tx.mix(root[todo] + np.uint64(turn + 1)), size) + at)
        need = self.k - turn  # open nodes that later turns, or the value left out, may use
        # Siblings far down a path are hopeless: only the first parts are followed with values for all edges.
        taken: list[list] = [None] * len(todo)
        wanted, length = np.arange(len(todo)), HEAD
        while len(wanted):
            head = np.minimum(size[wanted], length)
            index = tx.spans(ends[wanted], head)
            walk = Walk(t, starts[index], keys[index], True)
            bounds, again = tx.offsets_of(head), []
            for j, w in enumerate(wanted):
                taken[w] = self._open(t, walk, bounds[j], bounds[j + 1], heads[w], need)
                if taken[w] is None or head[j] < size[w] and not (
                        len(taken[w][1]) >= need and taken[w][2] + FAR < min(s[0] for s in taken[w][1])):
                    again.append(w)
            wanted, length = np.array(again, np.int64), length * 4
        done = np.array([x[3] for x in taken], np.int64)
        index = tx.spans(ends[:-1] + done, size - done)
        rest = Walk(t, starts[index], keys[index], False)
        bounds = rest.first[tx.offsets_of(size - done)]
        for j, (i, h) in enumerate(zip(todo, heads)):
            edges, siblings, reached, _ = taken[j]
            more = rest.edge[bounds[j]:bounds[j + 1]]
            ids = np.concatenate([h[5], t.id[edges], t.id[more]])
            out[i].append((ids, float(reached + t.logp[more].sum()), -h[0]))
            for tie, (value, row, part, edge, logp) in enumerate(siblings):
                path = np.concatenate([h[5], t.id[edges[:row]], t.id[edge:edge + 1]])
                heapq.heappush(queue[i], (-value, (turn + 1) * 1000 + tie, h[2] + part, int(t.target[edge]), logp, path))
            while len(queue[i]) > need:
                queue[i].remove(max(queue[i], key=lambda q: q[:2]))
                heapq.heapify(queue[i])

    @staticmethod
    def _open(t: Tables, walk: Walk, begin: int, end: int, head: tuple, need: int):
        """Edges taken in the first parts of a path, its best open siblings, the log probability reached, and the parts followed."""
        lo, hi = walk.first[begin], walk.first[end]
        edges = walk.edge[lo:hi]
        reached = head[4] + np.concatenate([[0.0], np.cumsum(t.logp[edges])])
        i, j = np.searchsorted(walk.row, [lo, hi])
        base = reached[walk.row[i:j] - lo]
        value = truncated(base + walk.value[i:j], base + walk.top[i:j], np.float64(-head[0]))
        best = np.argpartition(-value, need - 1)[:need] if len(value) > need else np.arange(len(value))
        siblings = []
        for b in best:
            row, edge = int(walk.row[i + b] - lo), int(walk.other[i + b])
            part = int(np.searchsorted(walk.first[begin:end + 1], lo + row, "right")) - 1
            if np.isfinite(value[b]):
                siblings.append((float(value[b]), row, part, edge, float(reached[row] + t.logp[edge])))
        return edges, siblings, float(reached[-1]), end - begin


def inclusion(logp: float, kappa: float) -> float:
    """Logarithm of the probability that a value around ``logp`` exceeds ``kappa``."""
    if kappa == -math.inf:
        return 0.0
    x = logp - kappa
    return x if x < -700 else math.log(-math.expm1(-math.exp(min(x, 700))))


SAMPLED = pa.schema([
    ("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("value", pa.float64()),
    ("inclusion", pa.float64()), ("ids", pa.list_(pa.int32())),
])
SAMPLED_DDL = "doc_id long, sample int, n_pieces long, log_prob double, value double, inclusion double, ids array<int>"
_samplers: dict[tuple, Sampler] = {}


def encode_samples(docs: DataFrame, model: str, k: int = 2, seed: int = 0) -> DataFrame:
    """Up to k segmentations of every row: doc_id, sample (from 1, by falling value), n_pieces, log_prob, value, inclusion, ids."""
    def run(batches):
        sampler = _samplers.get((model, k, seed)) or _samplers.setdefault((model, k, seed), Sampler(pieces(model), k, seed))
        for batch, _ in tx.slices(batches, limit=SLICE):
            keys = np.array([0 if v is None else v for v in batch.column("doc_id").to_pylist()], np.int64).view(np.uint64)
            found = sampler.sample([t or "" for t in batch.column("text").to_pylist()], tx.mix(keys))
            rows = [(i, j + 1, *row) for i, rows in enumerate(found) for j, row in enumerate(rows)]
            ids = [_expanded(r[2], sampler.lattice.vocabulary.byte_id) for r in rows]
            yield tx.batch_of(
                SAMPLED, pa.array(batch.column("doc_id")).take(pa.array([r[0] for r in rows], pa.int64())), [r[1] for r in rows],
                [len(x) for x in ids], *([r[c] for r in rows] for c in (3, 4, 5)),
                tx.lists(np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array([len(x) for x in ids], np.int64), pa.int32()),
            )

    tx.small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SAMPLED_DDL)


def _expanded(ids: np.ndarray, byte_id: list[int]) -> np.ndarray:
    """Ids with each character of several bytes replaced by its bytes' ids."""
    at = np.flatnonzero(ids < 0)
    if not len(at):
        return ids.astype(np.int32)
    raw = [chr(-int(i)).encode() for i in ids[at]]
    counts = np.ones(len(ids), np.int64)
    counts[at] = list(map(len, raw))
    full = np.repeat(ids, counts)
    full[tx.spans((np.cumsum(counts) - counts)[at], counts[at])] = [byte_id[b] for b in b"".join(raw)]
    return full.astype(np.int32)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the text of column ids as column text, and ids_crc32 of the ids as little-endian 32-bit integers."""
    names = [c for c in encoded.columns if c not in ("text", "ids_crc32")]
    encoded = encoded.select(*names)

    def run(batches):
        vocabulary = pieces(model)
        size = np.array(list(map(len, vocabulary.raw)), np.int64)
        begin = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(vocabulary.raw), np.uint8)
        for batch in batches:
            ends = batch.column("ids").offsets.to_numpy()
            values = batch.column("ids").values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
            ends = ends - ends[0]
            flat = letters[tx.spans(begin[values], size[values])].tobytes()
            places = tx.offsets_of(size[values])[ends].tolist()
            texts = [flat[i + (flat[i:i + 1] == b" "):j] if j > i else b"" for i, j in zip(places[:-1], places[1:])]
            raw = values.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()),
                 pa.array([zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())],
                names=[*names, "text", "ids_crc32"])

    return encoded.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", text string, ids_crc32 long")
