"""Long parity sketches and the search inside a key of the n-gram join."""

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import ngram_join
from demandloom.llm import text as tx

RULE = ngram_join.Similarity(5, 4, 5)


def made(rng, n):
    return rng.integers(0, 1 << 63, n).astype(np.uint64)


def changed(rng, values, share):
    """A copy of a set with a share of its elements replaced."""
    k = int(len(values) * share)
    return np.concatenate([values[k:], made(rng, k)])


def batch(sets, comps):
    values, sizes = np.concatenate(sets), np.array([len(s) for s in sets], np.int64)
    short = ngram_join.short_sketch(values, sizes)
    bits = ngram_join.long_bits(sizes, RULE).tolist()
    wide = [ngram_join.long_sketch(s, b) if b > ngram_join.SHORT_BITS else b"" for s, b in zip(sets, bits)]
    names = ["key", "doc_id", "comp", "n", *ngram_join.SKETCH, "wide"]
    columns = [np.ones(len(sets), np.int64), np.arange(len(sets)), np.array(comps), sizes, *[np.ascontiguousarray(short[:, j]) for j in range(4)]]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(wide, pa.binary())], names=names)


def pairs_of(sets, rank=None):
    out = ngram_join._close_in_group(RULE, rank)(iter([batch(sets, range(len(sets)))]))
    return {(a, b) for part in out for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist())}


@pytest.mark.parametrize("n", [20, 150, 700, 5000, 40_000])
def test_distance_never_exceeds_the_differing_elements(n):
    rng = np.random.default_rng(n)
    base = made(rng, n)
    for share in (0.0, 0.05, 0.1, 0.5):
        other = changed(rng, base, share)[: n - n // 9]
        both = [base, other]
        sizes = np.array([len(s) for s in both])
        raw = [ngram_join.long_sketch(s, b) for s, b in zip(both, ngram_join.long_bits(sizes, RULE).tolist())]
        apart = ngram_join.Wide(raw).apart(np.array([0]), np.array([1]))[0]
        assert apart <= len(np.setxor1d(base, other))


def test_folding_gives_the_sketch_of_fewer_bits():
    values = made(np.random.default_rng(1), 3000)
    whole = np.frombuffer(ngram_join.long_sketch(values, 4096), np.uint64)
    half = np.frombuffer(ngram_join.long_sketch(values, 1024), np.uint64)
    assert (np.bitwise_xor.reduce(whole.reshape(-1, len(half)), axis=0) == half).all()


@pytest.mark.parametrize("n", [600, 2000, 6000])
def test_unrelated_long_sets_of_a_key_are_not_sent_on(n):
    rng = np.random.default_rng(n)
    common = made(rng, n // 10)
    sets = [np.concatenate([common, made(rng, n - len(common))]) for _ in range(40)]
    sets += [changed(rng, sets[3], 0.08), changed(rng, sets[7], 0.1)]
    assert pairs_of(sets) == {(40, 3), (41, 7)}
    assert pairs_of(sets, 0) == {(40, 3), (41, 7)}


def test_no_linked_pair_of_mixed_sizes_is_lost():
    rng = np.random.default_rng(5)
    base = made(rng, 900)
    sets = [base[:size] for size in (720, 760, 800, 860, 900)] + [changed(rng, base, s) for s in (0.02, 0.05, 0.09, 0.11)]
    wanted = set()
    for i in range(len(sets)):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if RULE.q * common >= RULE.p * (len(sets[i]) + len(sets[j]) - common):
                wanted.add((i, j))
    assert wanted and wanted <= pairs_of(sets)


def test_long_near_misses_and_links_give_exact_components(spark):
    """Long texts that share a common passage, near misses and true copies."""
    rng = np.random.default_rng(9)
    words = lambda k: [f"w{x}" for x in rng.integers(0, 1 << 40, k)]
    common, rows = words(300), []
    for i in range(12):
        base = common + words(900)
        rows.append((10 * i, " ".join(base)))
        for j, replaced in enumerate((10, 60, 200, 400), 1):  # words replaced at the end: similarity 0.98, 0.90, 0.71, 0.50
            rows.append((10 * i + j, " ".join(base[:-replaced] + words(replaced))))
    sets = {d: ngram_join.sets_of(tx.texts_of(pa.array([t], pa.large_string())), 5)[0] for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b:
                common_n = len(np.intersect1d(sets[a], sets[b]))
                if 5 * common_n >= 4 * (len(sets[a]) + len(sets[b]) - common_n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, RULE).collect()}
    assert got == {d: find(d) for d in sets}
