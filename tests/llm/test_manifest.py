"""Merkle manifest against a plain recursive tree."""

import random
import zlib
from hashlib import sha256

import pytest

from demandloom.llm import manifest

KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def proofs(nodes):
    """(root, [(path)]) with a path of (siblings on the left, siblings on the right) per level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = nodes[at // 2 * 2:at // 2 * 2 + 2]
            paths[i].append((run[:at % 2], run[at % 2 + 1:]))
            places[i] = at // 2
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {g: proofs([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = proofs([inner[g][0] for g in order])
    out = []
    for g, above in zip(order, upper):
        for (_, _, own, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), inner[g][1]):
            path = path + above
            node = own
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                node = leaf((*row[:3], row[3] + 1, row[4]))
            for left, right in path:
                node = h(*left, node, *right)
            out.append((row[0], own, inner[g][0], root, h(*[s for level in path for side in level for s in side]), node, node == root))
    return out


def same(spark, rows, **settings):
    got = [tuple(r) for r in manifest.manifest(spark.createDataFrame(rows, KINDS), **settings).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    return got


@pytest.mark.parametrize("counts", [[1], [1, 1, 1], [2, 3, 1024], [1025, 5], [2049, 1]])
def test_tree_shapes(spark, counts):
    """Groups below, at and above a slot array, and lone nodes on the right edge."""
    rows = [(i * 3 + g * 7, "s", f"l{g}", i, f"text {i}") for g, c in enumerate(counts) for i in range(c)]
    got = same(spark, rows)
    assert 0 < sum(not r[6] for r in got) < len(got) or len(got) < 10


def test_three_rounds(spark):
    """Small arrays, so that trees, also that of the languages, have several rounds and different heights."""
    rows = [(i, "s", f"l{i % 7 if i % 5 else 0}", i, "t") for i in range(150)]
    same(spark, rows, height=2)
    rounds, _ = manifest.build(manifest.coordinates(manifest.leaves(spark.createDataFrame(rows, KINDS))), 2)
    assert len(rounds) == 3


def test_odd_rows(spark):
    """Nulls everywhere, repeated and equal rows, negative and far ids, empty texts, bytewise language order."""
    rng = random.Random(1)
    ids = [None, 0, 1, 5, 63, 64, -1, -64, -65, 10**12, -2**63, 2**63 - 1]
    rows = [
        (rng.choice(ids), rng.choice([None, "", "a:b", "é"]), rng.choice([None, "", "é", "z", "Z", "=", "-"]), rng.choice([None, 0, -1, 2**63 - 1]),
         rng.choice([None, "", "x", "long " * 50]))
        for _ in range(700)
    ]
    rows += rows[:40] * 3
    same(spark, rows)


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "s", "en", 3, "abc", "x", 9)], KINDS + ", tree string, n long")
    assert manifest.manifest(df).count() == 1
    assert manifest.manifest(df.limit(0)).count() == 0


def test_rank_places(spark):
    ids = random.Random(2).sample(range(-5000, 200000), 3000)
    rows = spark.createDataFrame([(i, "s", "ab"[i % 2], 1, "t") for i in ids], KINDS)
    got = manifest.coordinates(manifest.leaves(rows)).select("tree", "doc_id", "pos", "n").collect()
    for tree in {r.tree for r in got}:
        mine = sorted((r.doc_id, r.pos) for r in got if r.tree == tree)
        assert [p for _, p in mine] == list(range(len(mine))) and {r.n for r in got if r.tree == tree} == {len(mine)}
