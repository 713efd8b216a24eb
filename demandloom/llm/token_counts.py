"""Token counts by dynamic programming over a trie of distinct parts of texts.

Distinct parts are inserted in a trie. A node stands for a prefix and keeps the best unigram score of a segmentation of the
prefix and its number of tokens, computed from shorter prefixes when the node is made, once for all parts that share it.
The terminal node of a part then holds the part's count, and a document's count is the sum over its parts. Every
worker grows a trie of its own, so nothing is shuffled, and starts anew when the trie reaches ``NODES`` nodes.

Contract: null and empty texts have no parts and no tokens. Of segmentations with equal score that with fewer tokens counts.
Rows are counted one by one, whatever their doc_id.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from demandloom.llm import text as tx
from demandloom.llm.pieces import Pieces, pieces

NODES = 1_000_000


class Trie:
    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # score, minus tokens
        self.terminal: dict[str, tuple[int, float]] = {}

    def insert(self, part: str) -> tuple[int, float]:
        """Tokens and score of a part; makes the nodes that are missing."""
        score, longest, last = self.vocabulary.score, self.vocabulary.longest, self.vocabulary.last
        node, path, best = 0, [0], self.best
        for end in range(1, len(part) + 1):
            key = (node, part[end - 1])
            node = self.children.get(key, -1)
            if node < 0:
                node = self.children[key] = len(best)
                top = None
                for start in range(max(0, end - longest), end):
                    s = score.get(part[start:end])
                    if s is not None:
                        before = best[path[start]]
                        value = (before[0] + s, before[1] - 1)
                        if top is None or value > top:
                            top = value
                if part[end - 1] not in score:
                    width = len(part[end - 1].encode("utf-8", "replace"))
                    before = best[path[end - 1]]
                    value = (before[0] + last * width, before[1] - width)
                    if top is None or value > top:
                        top = value
                best.append(top)
            path.append(node)
        found = self.terminal[part] = (-best[node][1], best[node][0])
        return found

    def count(self, text: str) -> tuple[int, int, float]:
        """Parts, tokens and score of a text."""
        parts = self.vocabulary.parts(text)
        if len(self.best) > NODES:
            self.clear()
        known = self.terminal
        values = list(map(known.get, parts))
        if None in values:
            for p in set(parts):
                if p not in known:
                    self.insert(p)
            values = [known[p] for p in parts]
        return len(parts), sum([v[0] for v in values]), sum([v[1] for v in values])


_tries: dict[str, Trie] = {}
COUNTED = pa.schema([("doc_id", pa.int64()), ("n_parts", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_parts, n_tokens and score (natural log of the best segmentation) of every row, for the vocabulary at ``model``."""
    def run(batches):
        trie = _tries.get(model) or _tries.setdefault(model, Trie(pieces(model)))
        for batch, _ in tx.slices(batches):
            rows = [trie.count(t or "") for t in batch.column("text").to_pylist()]
            yield tx.batch_of(COUNTED, batch.column("doc_id"), *([r[j] for r in rows] for j in range(3)))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_parts long, n_tokens long, score double")
