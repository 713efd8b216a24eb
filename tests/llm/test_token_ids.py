"""Remembered pieces give the library's ids, also when the memory is emptied between texts."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from demandloom.llm import binary_tokens, token_ids

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a", "\n\nx", " été Straße", "it's we'LL I'm'x", "<|endoftext|> and <|endoftext|>", "a　b c d", "日本語 abc१२3 12ab",
    "ﬁx ſ 'S", "a\x00b\x1cc \x0bd", "tab\tand  two", "naïve—dash…x", "word" * 500, " \t \n mixed \r\n", "🙂🙂 x🙂y", "ÀÉ abcÉdef",
]


@pytest.mark.parametrize("memory", [600_000, 3])
def test_pieces_equal_the_library(monkeypatch, memory):
    monkeypatch.setattr(token_ids, "MEMORY_PIECES", memory)
    coder = token_ids.IdEncoder(BPE)
    for texts in (ODD, ODD[::-1], [], [""], [a + b for a in ODD for b in ODD[5:12]]):
        got = [np.frombuffer(b, coder.width).tolist() for b in coder.encode(texts)]
        assert got == [coder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts_come_with_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "doc_id long, text string").repartition(3)
    counts = binary_tokens.write(docs, str(tmp_path / "files"), BPE)
    read = binary_tokens.read(spark, str(tmp_path / "files"))
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in read.collect()])
    assert counts.tolist() == np.bincount(ids, minlength=len(counts)).tolist()
    assert read.agg(F.count("*")).first()[0] == len(ODD) + 1


def test_words_go_to_the_model_in_runs(monkeypatch):
    coder = token_ids.IdEncoder(BPE)
    words = ["w" + "abcdefgh"[i % 8] * (i // 8 + 1) for i in range(200)] + ["été", "Straße", "日本語"]
    text = " ".join(words) + " 7".join(words)
    calls = []

    class Model:
        @staticmethod
        def tokenize(run, real=coder.library.model.tokenize):
            calls.append(run)
            return real(run)

    class Library:
        model = Model
        encode_batch = coder.library.encode_batch

    expected = coder.library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(coder, "library", Library)
    assert np.frombuffer(coder.encode([text])[0], coder.width).tolist() == expected
    assert 0 < len(calls) <= 2 * len(words) // token_ids.RUN + 2
