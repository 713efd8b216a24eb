"""Operators on documents against brute force, on awkward inputs: nulls, empty and very long texts, ties, repeated rows, empty
tables, and extra columns with clashing names."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandloom.llm import (
    binary_tokens, decontaminate, maxent_lm, ngram_join, quality_crf, rans, sampled_pieces, substring_dedup, token_counts,
)
from demandloom.llm import text as tx
from demandloom.llm.pieces import pieces
from demandloom.llm.queries import QUERIES
from demandloom.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def texts() -> list:
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß", "The", "the", "漢字", "x" * 300]
    base = [" ".join(rng.choice(vocabulary, n)) for n in (3, 4, 12, 13, 14, 60, 200, 400)]
    edited = [b.replace(" w1 ", " q1 ").replace(" w2 ", " Q2 ") for b in base]
    cut = [b[len(b) // 10:] for b in base]
    long = " ".join(rng.choice(vocabulary, 30_000))
    odd = [None, "", " ", "\n\n", "a", "A", "a  b \n c ", "\t\x0b\x0c\r", "no\x85break here", "<|endoftext|> z", "it's  it's", "same " * 500]
    shared = " ".join(base[5].split()[10:40])
    return [*base, *odd, *edited, *cut, long, long + " end", *base[:4], f"one two {shared} three", f"four {shared} five six", shared.upper()]


def documents(spark, rows=None):
    rows = list(enumerate(texts())) if rows is None else rows
    data = [(i, t, "n", 1.0, [1], "rep", 5) for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, n string, score double, keys array<int>, rep string, component_id int").repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(texts()))


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark).limit(0)


def words(text, lower=True):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def shingles(text, size):
    w = words(text)
    return set() if not w else {tuple(w)} if len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def linked(sets: dict, p: int, q: int) -> dict:
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and q * len(sets[x] & sets[y]) >= p * len(sets[x] | sets[y]):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {i: root(i) for i in ids}


def test_words_and_hashes(rows):
    column = tx.texts_of(pa.array([t for _, t in rows], pa.string()))
    found = tx.words_of(column)
    raw = column.data.tobytes()
    split = [raw[i:j].decode() for i, j in zip(found.starts, found.ends)]
    assert split == [w for _, t in rows for w in words(t, False)]
    assert found.counts.tolist() == [len(words(t, False)) for _, t in rows]
    hashed = tx.hashes(column, found, lower=True)
    low = [w.translate(LOWER) for w in split]
    assert len(set(zip(low, hashed.tolist()))) == len(set(low)) == len(set(hashed.tolist()))


@pytest.mark.parametrize(("size", "p", "q"), [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_ngram_join(docs, rows, size, p, q):
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs, ngram_join.Similarity(size, p, q)).collect()}
    sets = {i: shingles(t, size) for i, t in rows}
    want = linked(sets, p, q)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all((r.class_id is None) == (not sets[i]) for i, r in got.items())


def test_ngram_join_finds_chains_of_many_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 150, 4):
            w[j] = f"e{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join([f"u{i}_{j}" for j in range(100)] + base[:40])) for i in range(30)]
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(documents(spark, rows), ngram_join.Similarity(4, 85, 100)).collect()}
    assert got == linked({i: shingles(t, 4) for i, t in rows}, 85, 100)


@pytest.mark.parametrize("splits", [0, 2])
def test_ngram_join_of_large_groups(docs, rows, monkeypatch, splits):
    """Hubs only, and keys combined with those of further sketches."""
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 2)
    monkeypatch.setattr(ngram_join, "SPLITS", splits)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, ngram_join.Similarity(4, 85, 100)).collect()}
    assert got == linked({i: shingles(t, 4) for i, t in rows}, 85, 100)


def test_sketches_never_part_a_pair():
    """Sets at the threshold share a key, and short sketches stay below the number of differing elements."""
    rng = np.random.default_rng(8)
    rule = ngram_join.Similarity(4, 85, 100)
    for n in (6, 7, 13, 20, 40, 90, 300, 1000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        drop = next(d for d in range(n, -1, -1) if 100 * (n - d) >= 85 * n)
        half = next(d for d in range(n, -1, -1) if 100 * (n - d) >= 85 * (n + d))
        for b in (a[drop:], np.concatenate([a[half:], rng.integers(0, 1 << 63, half).astype(np.uint64)])):
            sizes = np.array([len(a), len(b)])
            keys, counts = ngram_join.block_keys(np.concatenate([a, b]), sizes, rule)
            differ = len(set(a.tolist()) ^ set(b.tolist()))
            assert not differ or set(keys[:counts[0]].tolist()) & set(keys[counts[0]:].tolist())
            s = ngram_join.short_sketch(np.concatenate([a, b]), sizes).view(np.uint64)
            assert int(np.bitwise_count(s[0] ^ s[1]).sum()) <= differ


def test_substring_dedup(docs, rows):
    first = {}
    for i, t in rows:
        w = words(t, False)
        for s in range(len(w) - 12):
            first.setdefault(tuple(w[s:s + 13]), i)
    got = {r.doc_id: r for r in substring_dedup.without_repeats(docs).collect()}
    assert len(got) == len(rows)
    removed = 0
    for i, t in rows:
        w = words(t, False)
        gone = [False] * len(w)
        for s in range(len(w) - 12):
            if first[tuple(w[s:s + 13])] < i:
                gone[s:s + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        removed += sum(gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (
            len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    assert removed > 1000


def test_substring_dedup_of_common_passages_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MANY", 3)
    line = " ".join(f"c{i}" for i in range(20))
    rows = [(i, f"a{i} b{i} {line} d{i}") for i in range(12)] + [(3, f"a3 b3 {line} d3"), (None, line)]
    got = substring_dedup.without_repeats(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got if r.doc_id is not None) == sorted([(0, 0), (3, 20), *((i, 20) for i in range(1, 12))])
    assert [r.n_removed for r in got if r.doc_id is None] == [0]


def test_suffix_automaton():
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 3, 30).tolist() for _ in range(12)]
    automaton = substring_dedup.SuffixAutomaton(sequences, list(range(12)))
    for s in sequences[::-1] + [[0, 1, 2, 9, 1, 1, 0, 2]]:
        want = []
        for i in range(len(s) - 4):
            owners = [k for k, t in enumerate(sequences) if any(t[j:j + 5] == s[i:i + 5] for j in range(26))]
            want.append(min(owners, default=1 << 62))
        assert automaton.matches(s, 5) == want


def test_token_files(spark, docs, rows):
    path = scratch_path(spark, "files")
    counts = binary_tokens.write(docs, path, BPE)
    got = {r.doc_id: r for r in binary_tokens.read(spark, path, counts).collect()}
    library = Tokenizer.from_file(BPE)
    start = 0
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, bytes(got[i].ids)) == (start, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
        start += len(ids)


def test_rans_blocks_fail_loudly():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.geometric(0.01, 9000), 499)
    table = rans.Table(np.bincount(ids, minlength=500))
    sizes = np.array([4096, 1, 2, 3, 4, 4096, 798])
    blocks = rans.encode(ids, sizes, table)
    assert np.array_equal(np.concatenate(rans.decode(blocks, table)), ids)
    assert np.array_equal(rans.decode(blocks[3:4], table)[0], ids[4099:4102])
    assert sum(map(len, blocks)) < 2 * len(ids)
    broken = bytearray(blocks[0])
    broken[100] ^= 1
    with pytest.raises(ValueError):
        rans.decode([bytes(broken)], table)
    with pytest.raises(ValueError):
        rans.decode([blocks[0][:-4]], table)


def test_token_counts(docs, rows):
    vocabulary = pieces(PIECES)
    got = {r.doc_id: r for r in token_counts.token_counts(docs, PIECES).collect()}
    for i, t in rows:
        if t and len(t) > 20_000:
            continue
        n, score, parts = 0, 0.0, vocabulary.parts(t or "")
        for part in parts:
            best = [(0.0, 0), *[(-math.inf, 0)] * len(part)]
            for at in range(len(part)):
                for size, ids, s in vocabulary.edges(part, at):
                    best[at + size] = max(best[at + size], (best[at][0] + s, best[at][1] - len(ids)))
            n -= best[-1][1]
            score += best[-1][0]
        assert (got[i].n_parts, got[i].n_tokens) == (len(parts), n)
        assert math.isclose(got[i].score, score, rel_tol=1e-12, abs_tol=1e-12)


def test_sampled_segmentations_decode_and_repeat(docs, rows):
    encoded = sampled_pieces.encode_samples(docs, PIECES, 3)
    got = sampled_pieces.decode(encoded, PIECES).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        own = sorted(by[i], key=lambda r: r.sample)
        assert [r.text for r in own] == [t or ""] * len(own)
        assert len({tuple(r.ids) for r in own}) == len(own) == (3 if t and len(words(t)) > 1 else len(own))
        assert all(x.value >= y.value for x, y in zip(own, own[1:]))
    again = sampled_pieces.encode_samples(docs.repartition(1), PIECES, 3).collect()
    assert Counter((r.doc_id, r.sample, tuple(r.ids)) for r in again) == Counter((r.doc_id, r.sample, tuple(r.ids)) for r in got)


def test_sampling_follows_the_lattice():
    """First samples have the lattice's probabilities, second ones those without the first, and weights add up to one."""
    vocabulary = pieces(PIECES)
    every = [((), 0.0)]
    for part in vocabulary.parts("the cat"):
        def rest(i, part=part):
            return [((), 0.0)] if i == len(part) else [
                (ids + tail, s + more) for n, ids, s in vocabulary.edges(part, i) for tail, more in rest(i + n)]
        every = [(a + b, x + y) for a, x in every for b, y in rest(0)]
    total = math.log(sum(math.exp(s) for _, s in every))
    exact = {ids: s - total for ids, s in every}
    sampler = sampled_pieces.Sampler(vocabulary, 2, 0)
    runs = 8000
    one, two, weight = Counter(), Counter(), Counter()
    for at in range(0, runs, 1000):
        for first, second in sampler.sample(["the cat"] * 1000, tx.mix(np.arange(at, at + 1000, dtype=np.uint64))):
            a, b = tuple(first[0].tolist()), tuple(second[0].tolist())
            one[a] += 1
            two[a, b] += 1
            for ids, row in ((a, first), (b, second)):
                assert math.isclose(row[1], exact[ids], abs_tol=1e-9)
                weight[ids] += math.exp(row[1] - row[3]) / runs
    for ids, n in one.most_common(3):
        assert abs(n / runs - math.exp(exact[ids])) < 0.03
        assert abs(weight[ids] - math.exp(exact[ids])) < 0.03
    for (a, b), n in two.most_common(3):
        assert abs(n / runs - math.exp(exact[a] + exact[b]) / (1 - math.exp(exact[a]))) < 0.03
    assert abs(sum(weight.values()) - 1) < 0.02


def test_lm_counts_and_gain(spark, folder):
    got = {r.doc_id: r for r in QUERIES["op8_lm_scoring"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in docs}
    seen = Counter(w for r in docs if not held[r.doc_id] for w in [*words(r.text), None])
    n, v = sum(seen.values()), len(seen)
    for r in docs:
        w = [*words(r.text), None]
        x = got[r.doc_id]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[r.doc_id], len(w), sum(seen[t] > 0 for t in w), n)
        assert math.isclose(x.base_score, sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w), rel_tol=1e-9)
        assert x.score < 0
    rows = [x for x in got.values() if not x.held_out]
    assert sum(x.score for x in rows) > sum(x.base_score for x in rows)


def test_lm_probabilities_add_up():
    """Over all classes, and over all seen tokens and the unseen one of a class."""
    c = np.array([1, 1, 2, 5, 9, 40, 100, 1000])
    bins = maxent_lm.band(c)
    model = maxent_lm.Model(np.bincount(bins, minlength=maxent_lm.BINS), np.bincount(bins, c, maxent_lm.BINS).astype(np.int64))
    model.weights = np.random.default_rng(0).normal(size=model.weights.shape).astype(np.float32)
    assert np.isclose(np.exp(model.log_classes(np.array([[3], [5], [7]]))).sum(), 1, atol=1e-5)
    kind = model.classes[np.append(bins, 0)]
    inside = np.log(np.append(c, 0) + maxent_lm.SMOOTH) - model.log_inside[kind]
    for k in set(kind.tolist()):
        assert np.isclose(np.exp(inside[kind == k]).sum(), 1)


def test_lm_on_awkward_rows(docs, rows):
    out = maxent_lm.lm_scores(docs.withColumn("held_out", F.lit(False))).collect()
    assert len(out) == len(rows) and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in out)


def test_quality_held_out_accuracy(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    got = {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, folder).collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    marked = [(got[r.doc_id].predicted, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in marked) / len(marked) > 0.95


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    first = np.array([0, 3, 4, 9])
    e, chain = rng.normal(size=9), rng.normal(size=(2, 2))
    p, pairs = quality_crf.forward_backward(e, first, chain)
    want, both = np.zeros(9), np.zeros((2, 2))
    for i, j in zip(first[:-1], first[1:]):
        states = [[s >> k & 1 for k in range(j - i)] for s in range(1 << (j - i))]
        weight = [math.exp(sum(e[i + k] for k in range(j - i) if s[k]) + sum(chain[a, b] for a, b in zip(s, s[1:]))) for s in states]
        for s, w in zip(states, weight):
            for k in range(j - i):
                want[i + k] += s[k] * w / sum(weight)
            for a, b in zip(s, s[1:]):
                both[a, b] += w / sum(weight)
    assert np.allclose(p, want) and np.allclose(pairs, both)


def test_quality_without_usable_labels(spark, docs, rows):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    assert {r.score for r in quality_crf.score(docs, quality_crf.fit(docs, none)).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(1, 1)], "doc_id long, quality int")
    out = quality_crf.score(docs, quality_crf.fit(docs, some))
    assert out.columns.count("score") == 1 and set(docs.columns) == set(out.columns)
    assert out.count() == len(rows) and out.where("score BETWEEN 0 AND 1").count() == len(rows)


def test_lines():
    column = tx.texts_of(pa.array(["", "a\nb", "a\n", "\n", None, "x"]))
    starts, ends, first = quality_crf.lines_of(column)
    assert np.diff(first).tolist() == [1, 2, 2, 2, 1, 1]
    assert [column.data[i:j].tobytes() for i, j in zip(starts, ends)] == [b"", b"a", b"b", b"a", b"", b"", b"", b"", b"x"]


def test_leaks(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = {r.item_id: shingles(r.text, 5) for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for s in [shingles(r.text, 5)] for i, g in items.items() if len(g & s) >= 0.8 * len(g)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == want and want
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_leaks_on_awkward_rows(spark, docs):
    item = "What is the name of the town by the river? It is called Entenhausen by all."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "w1"), (5, item), (None, "zz")], "item_id long, text string")
    hit = documents(spark, [(7, "so " * 400 + item + " so" * 90), (8, item.upper()), (9, "the name of the town"), (None, item), (7, "so " * 400 + item)])
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.find_leaks(hit, bench).collect())
    assert got == {(7, 1): 2, (7, 5): 2, (8, 1): 1, (8, 5): 1, (None, 1): 1, (None, 5): 1}
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_wand_equals_all_scores():
    rng = np.random.default_rng(6)
    items = [" ".join(rng.choice([f"v{i}" for i in range(60)], 12)) for _ in range(300)]
    seen = Counter(h for t in items for h in set(_hashes(t)))
    shard = decontaminate.Shard(list(range(300)), items).build(seen, 300, 12.0)
    for q in items[:40] + [" ".join(f"v{i}" for i in range(30))]:
        terms = np.unique(shard.find(np.array(_hashes(q), np.uint64)))
        terms = terms[terms >= 0]
        score = np.zeros(300)
        for t in terms:
            score[shard.items[t]] += shard.scores[t]
        assert {i for i, _ in shard.search(terms)} == set(np.flatnonzero(score >= 1 - 1e-9).tolist())


def _hashes(text):
    column = tx.texts_of(pa.array([text], pa.string()))
    return tx.hashes(column, tx.words_of(column), lower=True).tolist()


def test_empty_tables(spark, empty):
    assert ngram_join.near_duplicates(empty).count() == 0
    assert substring_dedup.without_repeats(empty).count() == 0
    assert token_counts.token_counts(empty, PIECES).count() == 0
    assert sampled_pieces.decode(sampled_pieces.encode_samples(empty, PIECES), PIECES).count() == 0
    assert maxent_lm.lm_scores(empty.withColumn("held_out", F.lit(False))).count() == 0
    assert quality_crf.score(empty, quality_crf.fit(empty, spark.createDataFrame([], "doc_id long, quality int"))).count() == 0
    path = scratch_path(spark, "none")
    counts = binary_tokens.write(empty, path, BPE)
    assert binary_tokens.read(spark, path, counts).count() == 0


def test_token_files_are_complete(spark, docs, empty, monkeypatch):
    """Another session reads the files without the counts; files of another format are refused."""
    path = scratch_path(spark, "token-test")
    counts = binary_tokens.write(docs, path, BPE)
    want = sorted(map(tuple, binary_tokens.read(spark, path, counts).collect()))
    assert want and sorted(map(tuple, binary_tokens.read(spark.newSession(), path).collect())) == want
    nothing = scratch_path(spark, "token-test")
    binary_tokens.write(empty, nothing, BPE)
    assert binary_tokens.read(spark, nothing).count() == 0
    monkeypatch.setattr(binary_tokens, "CONSTANTS", {**binary_tokens.CONSTANTS, "bits": 1})
    with pytest.raises(ValueError):
        binary_tokens.read(spark, path)
