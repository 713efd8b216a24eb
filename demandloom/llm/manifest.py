"""Merkle manifest of a document table, with leaf coordinates from bitmap ranks.

A leaf is a hash of one row. The leaves of a language, in doc_id order, make a binary tree; the roots of the languages make
another. Coordinates come from bitmaps, not from sorting rows:

1. Per language the doc_ids become a bitmap, of which only the 64-bit words that are not empty are kept. A popcount directory of
   two levels holds the rows before each word inside its block of 1024 words, and the rows before each block.
2. A leaf's place is a rank query: rows before its word, and set bits below its own. Doc_ids that repeat (and null ones) leave
   the bitmap short of rows; only rows of such words are ordered, by doc_id and leaf, with running totals.
3. Leaves go by place into slot arrays of 1024, keyed by (tree, slot). A task reduces an array by ten levels to one node; the nodes
   of all arrays are the leaves of the next round, so a round divides the number of rows by 1024.
4. The way back carries, for each slot array, the siblings above it. At the leaves every row's proof is complete and folded.

Contract: rows with null doc_id stand first in their language, rows of equal doc_id by leaf; equal rows are interchangeable and
each has a place of its own. A null language is a language. Null and empty texts differ in their leaf. n_chars + 1 may exceed a
long. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.text import batch_of, small_batches
from demandloom.operators.ordering import running_total
from demandloom.session import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOT_LEVELS = 10
NO_ID = -(1 << 60)  # the word of null doc_ids, below all others
TAMPER_EVERY = 7

# How a sibling stands to a node on its way up.
NONE, RIGHT, LEFT = 0, 1, 2
ENTRY = 33


# ---- leaves ---------------------------------------------------------------------------------------------------------

def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(**changed: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_part(changed.get(c, F.col(c))) for c in FIELDS]), 256))


def leaves(documents: DataFrame, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """(tree, doc_id, node, tampered): the leaf of each row, and of its tampered copy where the row is chosen for one.

    ``tree`` sorts as the languages do, null first.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper_every == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    return documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        _leaf().alias("node"), F.when(chosen & F.col("n_chars").isNotNull(), _leaf(n_chars=more)).alias("tampered"),
    )


# ---- bitmap ranks ---------------------------------------------------------------------------------------------------

def _word() -> Column:
    return F.coalesce(F.shiftright("doc_id", 6), F.lit(NO_ID)).alias("word")


def bitmap_index(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, rows, first, n): the bitmap words of every tree, with the rows before each word and those of the tree."""
    words = cut(
        rows.select("tree", _word(), F.expr("shiftleft(1L, cast(doc_id & 63 as int))").alias("bit"))
        .groupBy("tree", "word").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("rows"))
        .withColumn("block", F.shiftright("word", 10))
    )
    blocks = words.groupBy("tree", "block").agg(F.sum("rows").alias("in_block"))
    directory = cut(running_total(blocks, ["tree"], ["block"], "in_block", "upto"))
    sizes = directory.groupBy("tree").agg(F.sum("in_block").alias("n"))
    inside = Window.partitionBy("tree", "block").orderBy("word")  # at most 1024 words
    return (
        words.withColumn("inner", F.sum("rows").over(inside) - F.col("rows"))
        .join(directory, ["tree", "block"]).join(sizes, "tree")
        .select("tree", "word", "bits", "rows", (F.col("upto") - F.col("in_block") + F.col("inner")).alias("first"), "n")
    )


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` with their place in the tree (``pos``) and its size (``n``)."""
    found = cut(rows.withColumn("word", _word()).join(bitmap_index(rows), ["tree", "word"]))
    whole = F.coalesce(F.bit_count("bits"), F.lit(0)) == F.col("rows")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 as int)))")
    keep = ["tree", "n", "doc_id", "node", "tampered"]
    plain = found.where(whole).select(*keep, (F.col("first") + below).alias("pos"))
    equal = found.where(~whole).groupBy("tree", "word", "first", "n", "doc_id", "node").agg(
        F.count("*").alias("copies"), F.first("tampered").alias("tampered"))
    ordered = running_total(equal, ["tree", "word"], ["doc_id", "node"], "copies", "upto")
    repeated = ordered.select(*keep, F.explode(F.sequence(
        F.col("first") + F.col("upto") - F.col("copies"), F.col("first") + F.col("upto") - 1)).alias("pos"))
    return plain.unionByName(repeated)


# ---- trees ----------------------------------------------------------------------------------------------------------

def _digest(*hexed: bytes) -> bytes:
    return sha256(b"".join(hexed)).hexdigest().encode()


def _levels(nodes: list[bytes], n: int, height: int) -> list[list[bytes]]:
    """The nodes of one slot array level by level, as hex, up to one node: the tree's root if it has one array only."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (n > 1 << height and len(levels) <= height):
        last = levels[-1]
        levels.append([_digest(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def _siblings(levels: list[list[bytes]], at: int) -> list[tuple[int, bytes]]:
    found = []
    for nodes in levels[:-1]:
        other = at ^ 1
        found.append((NONE, b"") if other >= len(nodes) else (RIGHT if other > at else LEFT, nodes[other]))
        at >>= 1
    return found


def _fold(node: bytes, path: list[tuple[int, bytes]]) -> bytes:
    for side, other in path:
        node = _digest(node) if side == NONE else _digest(node, other) if side == RIGHT else _digest(other, node)
    return node


def _packed(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side]) + bytes.fromhex(other.decode()).ljust(ENTRY - 1, b"\0") for side, other in path)


def _unpacked(path: bytes) -> list[tuple[int, bytes]]:
    entries = [path[i:i + ENTRY] for i in range(0, len(path), ENTRY)]
    return [(e[0], e[1:].hex().encode() if e[0] != NONE else b"") for e in entries]


def _arrays(batch: pa.RecordBatch):
    """(row number, tree, n, slot, nodes in place order) of every slot array of a batch."""
    nodes, ends = batch.column("nodes").flatten(), batch.column("nodes").offsets.to_pylist()
    base = ends[0] if ends else 0
    at, node = nodes.field("at").to_pylist(), nodes.field("node").to_pylist()
    for row, (tree, n, slot) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tree", "n", "slot")))):
        begin, end = ends[row] - base, ends[row + 1] - base
        placed: list[bytes] = [b""] * (end - begin)
        for i in range(begin, end):
            placed[at[i]] = node[i].hex().encode()
        yield row, tree, n, slot, placed, range(begin, end), nodes


def _slots(placed: DataFrame, height: int) -> DataFrame:
    """Nodes (tree, n, pos, doc_id, node, tampered) gathered to slot arrays of at most 2**height."""
    at = F.col("pos").bitwiseAND((1 << height) - 1).cast("int").alias("at")
    return placed.groupBy("tree", "n", F.shiftright("pos", height).alias("slot")).agg(
        F.collect_list(F.struct(at, "doc_id", "node", "tampered")).alias("nodes"))


NODE = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("node", pa.binary())])


def _reduce(height: int):
    def run(batches):
        for batch in batches:
            for _, tree, n, slot, placed, _, _ in _arrays(batch):
                root = _levels(placed, n, height)[-1][0]
                yield batch_of(NODE, [tree], [-(-n // (1 << height))], [slot], [bytes.fromhex(root.decode())])
    return run


def build(placed: DataFrame, height: int = SLOT_LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every round, and the root of every tree as (tree, node)."""
    rounds, tops, nodes = [], [], placed
    while True:
        slots = cut(_slots(nodes, height))
        rounds.append(slots)
        reduced = cut(slots.mapInArrow(_reduce(height), "tree string, n long, pos long, node binary"))
        tops.append(reduced.where("n = 1").select("tree", "node"))
        nodes = reduced.where("n > 1").select("*", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"))
        if nodes.isEmpty():
            break
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    return rounds, roots


ABOVE = pa.schema([("tree", pa.string()), ("slot", pa.int64()), ("subroot", pa.string()), ("root", pa.string()), ("path", pa.binary())])
ABOVE_DDL = "tree string, slot long, subroot string, root string, path binary"


def _down(height: int):
    """Every node of a slot array with its siblings up to the root: the arrays of the round below."""
    def run(batches):
        for batch in batches:
            subroots, roots, paths = (batch.column(c).to_pylist() for c in ("subroot", "root", "path"))
            for row, tree, n, slot, placed, _, _ in _arrays(batch):
                levels, above, k = _levels(placed, n, height), paths[row], len(placed)
                yield batch_of(ABOVE, [tree] * k, [(slot << height) + a for a in range(k)], [subroots[row]] * k, [roots[row]] * k,
                               [_packed(_siblings(levels, a)) + above for a in range(k)])
    return run


PROOF = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
    ("folded_root", pa.string()), ("verified", pa.bool_()),
])


def _proofs(height: int):
    def run(batches):
        for batch in batches:
            subroots, roots, paths = (batch.column(c).to_pylist() for c in ("subroot", "root", "path"))
            for row, _, n, _, placed, inside, nodes in _arrays(batch):
                levels, above, root = _levels(placed, n, height), _unpacked(paths[row]), roots[row]
                part = nodes.slice(inside.start, len(inside))
                leaf, proof, folded = [], [], []
                for at, tampered in zip(part.field("at").to_pylist(), part.field("tampered").to_pylist()):
                    path = _siblings(levels, at) + above
                    leaf.append(placed[at].decode())
                    proof.append(_digest(*[other for _, other in path]).decode())
                    folded.append(_fold(placed[at] if tampered is None else tampered.hex().encode(), path).decode())
                yield batch_of(PROOF, part.field("doc_id"), leaf, [subroots[row]] * len(leaf), [root] * len(leaf), proof, folded,
                               [f == root for f in folded])
    return run


def manifest(documents: DataFrame, tamper_every: int = TAMPER_EVERY, height: int = SLOT_LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    small_batches(documents.sparkSession)
    rounds, subroots = build(coordinates(cut(leaves(documents, tamper_every))), height)

    # The tree over the languages: their places are running counts, its leaves their roots.
    langs = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "node", F.lit(1).alias("one"))
    ranked = cut(running_total(langs, ["tree"], ["lang"], "one", "upto"))
    count = ranked.groupBy("tree").agg(F.count("*").alias("n"))
    places = ranked.join(count, "tree").select(
        "tree", "n", (F.col("upto") - 1).alias("pos"), F.lit(None).cast("long").alias("doc_id"), "node", F.lit(None).cast("binary").alias("tampered"))
    lang_rounds, root = build(places, height)
    above = root.select("tree", F.lit(0).cast("long").alias("slot"), F.lit("").alias("subroot"), F.lower(F.hex("node")).alias("root"),
                        F.lit(b"").alias("path"))
    for slots in reversed(lang_rounds):
        above = cut(slots.join(above, ["tree", "slot"]).mapInArrow(_down(height), ABOVE_DDL))
    top = cut(
        above.join(ranked.select(F.col("lang"), (F.col("upto") - 1).alias("slot"), F.lower(F.hex("node")).alias("own")), "slot")
        .select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("slot"), F.col("own").alias("subroot"), "root", "path")
    )

    # Down the trees of the languages: a tree whose nodes fit one array at a round meets the path of its language there.
    for i, slots in reversed(list(enumerate(rounds))):
        single = slots.where(F.col("n") <= 1 << height).join(top, ["tree", "slot"])
        if i == len(rounds) - 1:
            joined = single
        else:
            joined = single.unionByName(slots.where(F.col("n") > 1 << height).join(above, ["tree", "slot"]))
        if i:
            above = cut(joined.mapInArrow(_down(height), ABOVE_DDL))
    return joined.mapInArrow(_proofs(height), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
