"""Token-id files: documents as rANS-coded id blocks, in ascending doc_id order, and their reader.

``write`` encodes with a library tokenizer, appends ``END`` to every document, counts all ids for one shared table of
frequencies, codes every document as independent blocks and lays them out in ranges of doc_id, one folder a range.
A row of a file is one document: its place in the range, id count, and blocks (each with count, checksum and states, so every
row is a checkpoint at which decoding can start). The counts and the constants of the format lie beside the ranges (``_table``), so that
the files can be read by any session. ``read`` decodes the files in parallel and checks all checksums.

Contract: a null text is an empty one, so that such a document has the end id only. Rows with a null doc_id are dropped. Rows
with equal doc_id follow each other in an order fixed by their contents. An empty table gives no ranges and no rows.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.llm import rans
from demandloom.llm import text as tx
from demandloom.llm.token_ids import encoder
from demandloom.session import scratch_path

END = 0
GROUP_BYTES = 4 << 20
CONSTANTS = {"version": 1, "bits": rans.BITS, "lanes": rans.LANES, "block": rans.BLOCK, "end": END}

IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("id", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
IDS_DDL = "doc_id long, ids binary, id array<int>, n array<long>"
CODED = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("blocks", pa.list_(pa.binary())), ("range", pa.int32()),
])
PLACED = pa.schema([*[f for f in CODED if f.name not in ("range", "ids_crc32")], ("start_in_range", pa.int64()), ("range", pa.int32())])
READ = pa.schema([("doc_id", pa.int64()), ("range", pa.int32()), ("start_in_range", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                  ("ids", pa.binary())])


def _to_ids(tokenizer: str):
    """Ids of every document; the last row of a task has no document but the counts of the task's ids."""
    def run(batches):
        coder = encoder(tokenizer)
        end = np.array([END], coder.width).tobytes()
        counts = np.zeros(max(coder.size, END + 1), np.int64)
        for batch, _ in tx.slices(batches):
            ids = [b + end for b in coder.encode(t or "" for t in batch.column("text").to_pylist())]
            counts += np.bincount(np.frombuffer(b"".join(ids), coder.width), minlength=len(counts))
            nothing = [None] * len(ids)
            yield tx.batch_of(IDS, batch.column("doc_id"), tx.blobs(ids), nothing, nothing)
        used = np.flatnonzero(counts)
        yield tx.batch_of(IDS, [None], [None], [used.tolist()], [counts[used].tolist()])
    return run


def _groups(batch: pa.RecordBatch, column: str):
    """Row ranges of a batch with a bounded number of bytes in ``column``."""
    sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)], np.int64)
    at, total = 0, np.cumsum(sizes)
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + GROUP_BYTES, "right")))
        yield batch.slice(at, end - at)
        at = end


def _code(width: str, table, bounds: list[int]):
    def run(batches):
        codes = rans.Table(table.value)
        for batch in batches:
            for part in _groups(batch, "ids"):
                raw = part.column("ids").to_pylist()
                ids = [np.frombuffer(b, width) for b in raw]
                sizes = np.array([len(x) for x in ids], np.int64)
                blocks = -(-sizes // rans.BLOCK)
                runs = np.full(int(blocks.sum()), rans.BLOCK, np.int64)
                runs[np.cumsum(blocks) - 1] = sizes - (blocks - 1) * rans.BLOCK
                coded = rans.encode(np.concatenate(ids).astype(np.int64), runs, codes)
                doc = part.column("doc_id").to_numpy()
                yield tx.batch_of(
                    CODED, doc, sizes, [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                    pa.ListArray.from_arrays(pa.array(tx.offsets_of(blocks), pa.int32()), tx.blobs(coded)),
                    np.searchsorted(np.array(bounds, np.int64), doc, "left"),
                )
    return run


def _place(batches):
    """Running start of each document within its range; rows come sorted by (range, doc_id)."""
    last, start = None, 0
    for batch in batches:
        ranges, sizes = batch.column("range").to_pylist(), batch.column("n_tokens").to_pylist()
        starts = []
        for r, n in zip(ranges, sizes):
            if r != last:
                last, start = r, 0
            starts.append(start)
            start += n
        yield tx.batch_of(PLACED, batch.column("doc_id"), batch.column("n_tokens"), batch.column("blocks"), starts, batch.column("range"))


def write(docs: DataFrame, path: str, tokenizer: str) -> np.ndarray:
    """Write the files of ``docs`` (doc_id, text) and their table under ``path``; returns the counts of all ids, the table's source."""
    spark = docs.sparkSession
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    coder = encoder(tokenizer)
    width, size = coder.width.str, max(coder.size, END + 1)
    # One range of ids a few times the square root of the documents: many enough to spread, few enough for folders.
    n = docs.count()
    ranges = max(1, math.ceil(math.sqrt(n) / 4))
    bounds = sorted({int(b) for b in docs.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))}) if n else []
    temporary = scratch_path(spark, "ids")
    docs.mapInArrow(_to_ids(tokenizer), IDS_DDL).write.option("compression", "zstd").parquet(temporary)
    rows = spark.read.schema(IDS_DDL).parquet(temporary)
    counts = np.zeros(size, np.int64)
    at = rows.where("doc_id IS NULL").select(F.explode(F.arrays_zip("id", "n")).alias("c")).select("c.id", "c.n")
    for i, k in at.groupBy("id").agg(F.sum("n")).collect():  # at most one row an id
        counts[i] = k
    ids = rows.where("doc_id IS NOT NULL").select("doc_id", "ids")
    table = spark.sparkContext.broadcast(counts)
    coded = ids.mapInArrow(_code(width, table, bounds), "doc_id long, n_tokens long, ids_crc32 long, blocks array<binary>, range int")
    laid = coded.repartition("range").sortWithinPartitions("range", "doc_id", "n_tokens", "ids_crc32").mapInArrow(
        _place, "doc_id long, n_tokens long, blocks array<binary>, start_in_range long, range int")
    laid.write.partitionBy("range").parquet(path)
    used = np.flatnonzero(counts)
    spark.createDataFrame(list(zip(used.tolist(), counts[used].tolist())), "id long, n long").coalesce(1).write.parquet(f"{path}/_table/counts")
    constants = [*CONSTANTS.items(), ("ids", size)]
    spark.createDataFrame(constants, "name string, value long").coalesce(1).write.parquet(f"{path}/_table/format")
    return counts


def stored_counts(spark: SparkSession, path: str) -> np.ndarray:
    """The counts written beside the ranges; files of another format are an error."""
    found = {r.name: r.value for r in spark.read.schema("name string, value long").parquet(f"{path}/_table/format").collect()}
    size = found.pop("ids", None)
    if size is None or found != CONSTANTS:
        raise ValueError(f"the files have another format: {found}")
    counts = np.zeros(size, np.int64)
    for i, n in spark.read.schema("id long, n long").parquet(f"{path}/_table/counts").collect():  # at most one row an id
        counts[i] = n
    return counts


def _decode(table, keep: bool):
    def run(batches):
        codes = rans.Table(table.value)
        for batch in batches:
            sizes = np.diff(batch.column("blocks").offsets.to_numpy())
            blocks = batch.column("blocks").flatten().to_pylist()
            at, rows = 0, 0
            while rows < batch.num_rows:
                end, done = rows, 0
                while end < batch.num_rows and (end == rows or done < GROUP_BYTES):
                    done += sum(map(len, blocks[at + sizes[rows:end].sum():at + sizes[rows:end + 1].sum()]))
                    end += 1
                own = blocks[at:at + sizes[rows:end].sum()]
                decoded = rans.decode(own, codes)
                ends = tx.offsets_of(sizes[rows:end])
                texts = [np.concatenate(decoded[i:j]).astype("<u4").tobytes() for i, j in zip(ends[:-1], ends[1:])]
                part = batch.slice(rows, end - rows)
                counts = [len(t) // 4 for t in texts]
                if counts != part.column("n_tokens").to_pylist():
                    raise ValueError("a document has lost ids")
                yield tx.batch_of(READ, part.column("doc_id"), part.column("range"), part.column("start_in_range"), counts,
                                  [zlib.crc32(t) for t in texts], tx.blobs(texts if keep else [None] * len(texts)))
                at, rows = at + len(own), end
    return run


def read(spark: SparkSession, path: str, counts: np.ndarray | None = None, keep_ids: bool = True) -> DataFrame:
    """Documents of the files, by their stored counts if none are given: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids (little-endian 32 bits)."""
    files = spark.read.schema(
        "doc_id long, n_tokens long, blocks array<binary>, start_in_range long, range int").parquet(path)
    totals = files.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("range", F.coalesce(
        F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    table = spark.sparkContext.broadcast(stored_counts(spark, path) if counts is None else counts)
    docs = files.select("doc_id", "range", "start_in_range", "n_tokens", "blocks").mapInArrow(
        _decode(table, keep_ids), "doc_id long, range int, start_in_range long, n_tokens long, ids_crc32 long, ids binary")
    return docs.join(before, "range").select(
        "doc_id", (F.col("start_in_range") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "ids")
