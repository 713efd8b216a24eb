"""Totals of the language model's tokens beyond 32 bits."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from demandloom.llm import maxent_lm


def test_totals_pass_32_bits():
    hashed = np.array([3, 9], np.uint64)
    parts = [np.array([4_000_000_000, 1], np.uint32), np.array([4_000_000_000, 2], np.uint32)]
    rows = pa.Table.from_batches([pa.RecordBatch.from_arrays([
        pa.array([0, 0], pa.int64()), pa.array([1, 2], pa.int64()), pa.array([hashed.tobytes()] * 2, pa.binary()),
        pa.array([maxent_lm.planes(p) for p in parts], pa.binary())], schema=maxent_lm.DEALT)])
    reply = maxent_lm._sum_shard(rows)
    for raw in reply.column("c").to_pylist():
        assert maxent_lm.values_of(raw, maxent_lm.TOTAL).tolist() == [8_000_000_000, 3]
    sums = reply.column("bins").to_pylist()[0]
    assert sum(sums[maxent_lm.BINS:]) == 8_000_000_003 and sum(sums[:maxent_lm.BINS]) == 2


def test_planes_round_trip():
    values = np.array([0, 1, 255, 256, 2**32 - 1, 2**32, 2**53 + 1], np.uint64)
    assert maxent_lm.values_of(maxent_lm.planes(values, maxent_lm.TOTAL), maxent_lm.TOTAL).tolist() == values.tolist()
    assert maxent_lm.values_of(maxent_lm.planes(values[:5])).tolist() == values[:5].tolist()


def test_scores_do_not_depend_on_the_layout(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", "text", (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0).alias("held_out"))
    one, many = ({r.doc_id: r for r in maxent_lm.lm_scores(docs.repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys() and len(one) > 100
    for doc, r in one.items():
        assert r.base_score == many[doc].base_score and r.n_known == many[doc].n_known
        assert abs(r.score - many[doc].score) < 1e-5 * r.n_tokens


def test_words_are_named_alike_at_every_size():
    """A context word keeps its identity from a fixed number of occurrences, however many tokens there are."""
    index, size = np.array([0, 1]), np.array([2])
    for mass in (10_000, 10**12):
        words, totals = np.zeros(maxent_lm.BINS, np.int64), np.zeros(maxent_lm.BINS, np.int64)
        words[maxent_lm.band(np.array([20]))] = 2
        totals[maxent_lm.band(np.array([20]))] = 40
        words[-1], totals[-1] = 1, mass
        model = maxent_lm.Model(words, totals)
        apart = [model.context(index, np.array([c, c]), np.array([name, 9], np.uint32), size)[1][0, 1] for c, name in
                 ((20, 4), (20, 5), (maxent_lm.NAMED - 1, 4), (maxent_lm.NAMED - 1, 5))]
        assert apart[0] != apart[1] and apart[2] == apart[3]
