"""Keys of few sets are searched completely the first time, and not again."""

import numpy as np

from demandloom.llm import ngram_join
from test_ngram_sketches import RULE, changed, made, pairs_of


def test_a_key_of_few_sets_names_all_its_pairs_at_once():
    rng = np.random.default_rng(3)
    base = made(rng, 900)
    near = [base, *[changed(rng, base, 0.02) for _ in range(4)], made(rng, 900)]
    assert pairs_of(near, 0) == pairs_of(near) == {(i, j) for i in range(5) for j in range(i)}
    many = near + [made(rng, 900) for _ in range(ngram_join.FEW)]
    assert len(pairs_of(many, 0)) < len(pairs_of(many)) == 10


def test_keys_of_few_sets_are_searched_once(spark, monkeypatch):
    """Near misses share keys and never link; no later search meets them."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(20):
        words = [f"w{x}" for x in rng.integers(0, 1 << 40, 60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-14], *[f"x{x}" for x in rng.integers(0, 1 << 40, 14)]]))]
    asked = []
    search = ngram_join._close_in_group
    monkeypatch.setattr(ngram_join, "_close_in_group", lambda rule, rank: asked.append(rank) or search(rule, rank))
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), RULE).collect()
    assert asked == [0] and all(r.component_id == r.doc_id for r in found) and len(found) == 40
