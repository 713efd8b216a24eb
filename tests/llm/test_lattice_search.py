"""The lattice is searched only as far as pieces go on, and holds the edges that the vocabulary has."""

import numpy as np
import public_tokenizers

from demandloom.llm.pieces import pieces
from demandloom.llm.sampled_pieces import Lattice

VOCABULARY = pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_edges_are_those_of_the_vocabulary():
    parts = ["▁internationalisation", "▁", "\n", "▁été日本", "▁" * 9, "qzxjqzxj", "a"]
    t = Lattice(VOCABULARY).tables(parts)
    for p, part in enumerate(parts):
        for start in range(len(part)):
            node = t.first[p] + start
            own = slice(t.begin[node], t.begin[node] + t.degree[node])
            found = sorted((int(x - node), int(i)) for x, i in zip(t.target[own], t.id[own]) if i >= 0)
            assert found == sorted((n, ids[0]) for n, ids, _ in VOCABULARY.edges(part, start) if len(ids) == 1)


def test_search_ends_where_no_piece_goes_on():
    lattice, asked = Lattice(VOCABULARY), []

    def counted(points, sums, begin, size, real=Lattice._hash):
        asked.append(len(begin))
        return real(points, sums, begin, size)

    lattice._hash = counted
    parts = ["ꙮ" * 400]
    t = lattice.tables(parts)
    assert sum(asked) == 400 and (t.degree == np.append(np.ones(400), 0)).all()
