"""Near-duplicate join on word n-gram sets by parity sketches.

Two sets A, B with Jaccard similarity of at least p/q differ in at most d = floor((q-p)(|A|+|B|)/(q+p)) elements. Every
element is hashed to one bit of one block of a sketch, and a block holds the XOR (parity) of its elements; an element in
only one of the sets changes one block at most. So among g > d blocks at least g - d are equal (pigeonhole). Sizes are
split into bands, each with its own d and g; a set is sketched for its band, and for the next band if it can have partners
there. Documents meet on equal (band, block, content).

Blocks with fewer than two elements say little and would make hot keys. Each band has more blocks than it needs, so that a
set with no more than ``spare`` light blocks still has an equal block that is not light; the few sets with more light blocks
use all of theirs. Bands with over ``MAX_BLOCKS`` blocks use the first ``MAX_BLOCKS`` of them: a pair at the threshold keeps
each block with probability over 0.37, so all 128 miss with probability below 2**-64, less than that of a hash collision.

Keys shared by several sets give candidates. A first turn tests every set against its smallest candidate, which joins most of
every group. Keys that still join different components are then searched for pairs of different components that
their parity sketches allow, as a Hamming distance never exceeds the number of differing elements; only such pairs are sent on and
compared as sets. A short sketch of 256 bits is compared first. As it fills up with large sets, a long one follows with at least
``BITS`` bits for every element that may differ (up to ``MOST_BITS``, beyond which a set sends on more pairs but loses none); sketches of different
lengths are compared at the shorter one, to which the longer folds. In the first ``NEAREST`` searches every set of a key names one partner only, its nearest by sketch, then
the next nearest, which joins what can be joined; the last search names all that are left. A key of up to ``FEW`` sets is searched
completely the first time, and is done. Sets of a key with more than ``SMALL_GROUP`` sets (a common line, say) must also agree in a
block of another, independent sketch: such keys are replaced by pairs of keys, which splits them into small groups. What does not
split is tested against a few hubs a turn, which leave the key when tested, until none is left. So no link that matters
for a component is lost.

Contract: null and empty texts and texts without words have an empty set and link with nothing. Texts with fewer words
than the n-gram size have one element, the whole sequence. Equal sets are one class whatever their number. Rows with a null
id are dropped; a repeated id with different texts is an error of the caller (results are per id and text). Additional
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import text as tx
from demandloom.llm.graph import components
from demandloom.session import cut, scratch_path, scratch_scope, shuffles_released

MAX_BLOCKS = 128
HUBS = 4
NEAREST = 2
SPLITS = 3
FEW = 16
SMALL_GROUP = 32_768
ROW_PAIRS = 1 << 20
SKETCH = ("s0", "s1", "s2", "s3")
BROADCAST_IDS = 500_000
BITS = 8
MOST_BITS = 1 << 15
SHORT_BITS = 256


@dataclass(frozen=True)
class Similarity:
    """n-gram size in words, and the least Jaccard similarity as a fraction."""

    size: int = 5
    p: int = 4
    q: int = 5

    def differ(self, total):
        return (self.q - self.p) * total // (self.q + self.p)

    def bands(self, largest: int) -> np.ndarray:
        """First sizes of the bands, until beyond ``largest`` and its partners."""
        edges = [1]
        while edges[-1] <= largest * 4:
            s = edges[-1]
            edges.append(max(s + 1, -(-s * self.q * self.q // (self.p * self.p))))
        return np.array(edges, np.int64)


def sets_of(texts: tx.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text, ascending, and their number. Letters A-Z count as lower case."""
    words = tx.words_of(texts)
    hashed = tx.hashes(texts, words, lower=True)
    values, counts = tx.grams(hashed, words.first, size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    ends, found = tx.offsets_of(counts), []
    whole = {int(i): int(_sequence(hashed[words.first[i]:words.first[i + 1]])) for i in short}
    for i in range(len(texts)):
        part = values[ends[i]:ends[i + 1]]
        if i in whole:
            part = np.array([whole[i]], np.uint64)
        elif len(part) > 1:
            part = np.sort(part)
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        found.append(part)
    sizes = np.array([len(p) for p in found], np.int64)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), sizes


def _sequence(hashed: np.ndarray) -> np.uint64:
    value = np.full(1, len(hashed), np.uint64)
    for h in hashed:
        value = tx.mix(value * np.uint64(0xD1342543DE82EF95) + h)
    return value[0]


def block_keys(values: np.ndarray, sizes: np.ndarray, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sketch blocks of every set, and their number."""
    edges = rule.bands(int(sizes.max(initial=1)))
    band = np.searchsorted(edges, sizes, "right") - 1
    made, owner = [], []
    for step in (0, 1):
        at = band + step
        differ = rule.differ(2 * (edges[at + 1] - 1))
        wanted = (sizes > 0) & (differ > 0)
        if step:
            wanted &= sizes * rule.q // rule.p >= edges[at]
        spare = (differ + 1) * 18 // 100 + 2
        blocks = differ + 1 + spare
        rows = np.flatnonzero(wanted)
        if not len(rows):
            continue
        n, g = sizes[rows], blocks[rows]
        used = np.minimum(g, MAX_BLOCKS)
        base = tx.offsets_of(used)
        index = tx.spans(tx.offsets_of(sizes)[rows], n)
        block = ((tx.mix(values[index]) >> np.uint64(32)) * np.repeat(g.astype(np.uint64), n)) >> np.uint64(32)
        block = block.astype(np.int64)
        keep = block < np.repeat(used, n)
        place = (block + np.repeat(base[:-1], n))[keep]
        parity = np.zeros(base[-1], np.uint64)
        np.bitwise_xor.at(parity, place, tx.mix(values[index][keep] + np.uint64(0x2545F4914F6CDD1D)))
        light = np.bincount(place, minlength=base[-1]) < 2
        many = np.add.reduceat(light, base[:-1]) > spare[rows]
        emit = ~light | np.repeat(many & (g <= MAX_BLOCKS), used)
        number = np.arange(base[-1]) - np.repeat(base[:-1], used)
        salt = tx.mix((np.repeat(at[rows], used) * 4096 + number + 1).astype(np.uint64))
        made.append(tx.mix(parity ^ salt)[emit])
        owner.append(np.repeat(rows, used)[emit])
    if not made:
        return np.zeros(0, np.uint64), np.zeros(len(sizes), np.int64)
    owner, made = np.concatenate(owner), np.concatenate(made)
    order = np.argsort(owner, kind="stable")
    return made[order], np.bincount(owner, minlength=len(sizes))


def short_sketch(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parity sketch of 256 bits of every set, as four integers."""
    place = (tx.mix(values ^ np.uint64(0x94D049BB133111EB)) >> np.uint64(56)).astype(np.int64)
    bits = np.bincount(place + np.repeat(np.arange(len(sizes)) * 256, sizes), minlength=256 * len(sizes)) & 1
    return np.packbits(bits.astype(bool).reshape(len(sizes), 256), axis=1, bitorder="little").view(np.int64)


def long_bits(sizes: np.ndarray, rule: Similarity) -> np.ndarray:
    """Bits of the long sketch of sets of given sizes, powers of two; those of the short one where that is long enough."""
    wanted = np.maximum(BITS * rule.differ(2 * sizes), SHORT_BITS)
    return np.minimum(1 << np.ceil(np.log2(wanted)).astype(np.int64), MOST_BITS)


def long_sketch(values: np.ndarray, bits: int) -> bytes:
    """Parity sketch of one set. Its upper half folded onto the lower one is the sketch of half the bits."""
    place = (tx.mix(values ^ np.uint64(0x6A09E667F3BCC909)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


SKETCHED = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("s0", pa.int64()), ("s1", pa.int64()),
    ("s2", pa.int64()), ("s3", pa.int64()), ("keys", pa.list_(pa.int64())),
])
SKETCHED_DDL = "doc_id long, n long, f1 long, f2 long, s0 long, s1 long, s2 long, s3 long, keys array<long>"


def _totals(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[ends[1:]] - sums[ends[:-1]]


def sketcher(rule: Similarity):
    def run(batches):
        seen: set = set()
        for batch, texts in tx.slices(batches):
            values, sizes = sets_of(texts, rule.size)
            ends = tx.offsets_of(sizes)
            f1 = _totals(tx.mix(values + np.uint64(11)), ends).view(np.int64)
            f2 = _totals(tx.mix(values * np.uint64(3) + np.uint64(77)), ends).view(np.int64)
            # A copy within the task needs no keys: its class is found by the set's fingerprint.
            fresh = np.zeros(len(sizes), bool)
            for i, key in enumerate(zip(sizes.tolist(), f1.tolist(), f2.tolist())):
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
            if len(seen) > 500_000:
                seen.clear()
            part = np.where(fresh, sizes, 0)
            keys, counts = block_keys(values[tx.spans(ends[:-1], part)], part, rule)
            sketch = short_sketch(values, sizes)
            yield tx.batch_of(
                SKETCHED, batch.column("doc_id"), sizes, f1, f2, *[np.ascontiguousarray(sketch[:, j]) for j in range(4)],
                tx.lists(keys.view(np.int64), counts, pa.int64()),
            )
    return run


PAIRED = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])


def _shared(batches):
    """Of rows sorted by key, those whose key has several rows. One row is carried over between batches."""
    key, doc, alone = np.zeros(0, np.int64), np.zeros(0, np.int64), True
    for batch in batches:
        k = np.concatenate([key, batch.column(0).to_numpy()])
        d = np.concatenate([doc, batch.column(1).to_numpy()])
        if not len(k):
            continue
        same = k[1:] == k[:-1]
        keep = np.zeros(len(k), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if len(key) and not alone:
            keep[0] = False  # went out with the batch before
        out = keep[:-1]
        last_out = bool(keep[-1])
        key, doc = k[-1:], d[-1:]
        if last_out:
            yield tx.batch_of(PAIRED, np.concatenate([k[:-1][out], key]), np.concatenate([d[:-1][out], doc]))
            alone = False
        else:
            alone = not (len(k) == 1 and not alone)
            yield tx.batch_of(PAIRED, k[:-1][out], d[:-1][out])


VERIFIED = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def verifier(rule: Similarity):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(rule.q * common >= rule.p * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)
    return run


SETS = pa.schema([("doc_id", pa.int64()), ("wide", pa.binary()), ("set", pa.binary())])
SETS_DDL = "doc_id long, wide binary, set binary"


def set_writer(rule: Similarity):
    def run(batches):
        for batch, texts in tx.slices(batches):
            values, sizes = sets_of(texts, rule.size)
            ends = tx.offsets_of(sizes)
            raw = values.tobytes()
            bits = long_bits(sizes, rule).tolist()
            wide = [long_sketch(values[i:j], b) if b > SHORT_BITS else b"" for i, j, b in zip(ends[:-1], ends[1:], bits)]
            yield tx.batch_of(SETS, batch.column("doc_id"), tx.blobs(wide), tx.blobs([raw[8 * i:8 * j] for i, j in zip(ends[:-1], ends[1:])]))
    return run


def near_duplicates(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked doc_id), class_id (smallest doc_id with the
    same set; null for an empty set).

    The result is a table in the shared folder; the tables and shuffle files of the way there are gone."""
    spark = docs.sparkSession
    path = scratch_path(spark, "near")
    with shuffles_released(spark), scratch_scope(spark):
        found = _near_duplicates(docs, rule)
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _near_duplicates(docs: DataFrame, rule: Similarity) -> DataFrame:
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    made = cut(docs.mapInArrow(sketcher(rule), SKETCHED_DDL))
    fingerprint = ["n", "f1", "f2"]
    classes = made.where("n > 0").groupBy(*fingerprint).agg(F.min("doc_id").alias("rep"))
    members = cut(
        made.drop("keys").join(classes, fingerprint, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    )
    keys = made.select(F.explode("keys").alias("key"), "doc_id").repartition("key").sortWithinPartitions("key", "doc_id")
    shared = cut(keys.mapInArrow(_shared, "key long, doc_id long"))
    reps = members.select("doc_id", "rep")
    groups = shared.join(reps, "doc_id").select("key", F.col("rep").alias("doc_id")).distinct()
    several = groups.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    live = cut(groups.join(several.select("key"), "key", "left_semi"))
    found = _joined(docs, members, live, rule)
    return (
        members.join(found.withColumnRenamed("doc_id", "rep"), "rep", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "rep").alias("component_id"),
                F.when(F.col("n") > 0, F.col("rep")).alias("class_id"))
    )


def _joined(docs: DataFrame, members: DataFrame, live: DataFrame, rule: Similarity) -> DataFrame:
    """(doc_id, comp) of all class representatives with candidates: the smallest one reachable by verified links."""
    ids = cut(live.select("doc_id").distinct())
    few = ids.count() <= BROADCAST_IDS
    wanted = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    sets = cut(wanted.mapInArrow(set_writer(rule), SETS_DDL).dropDuplicates(["doc_id"]))
    info = members.join(ids, "doc_id", "left_semi").select("doc_id", "n", *SKETCH).dropDuplicates(["doc_id"])
    info = cut(info.join(sets.select("doc_id", "wide"), "doc_id"))
    # First one hub per document, its smallest candidate, which joins most of every group.
    first = live.groupBy("key").agg(F.min("doc_id").alias("b"))
    pairs = live.join(first, "key").where("doc_id > b").groupBy(F.col("doc_id").alias("a")).agg(F.min("b").alias("b"))
    comp = _merged(ids.select("doc_id", F.col("doc_id").alias("comp")), _verified(pairs, info, sets, rule))
    turn = 0
    while True:
        labelled = live.join(comp, "doc_id")
        hubs = [F.min(F.struct(F.xxhash64("doc_id", F.lit(turn * HUBS + h)).alias("o"), "doc_id", "comp")).alias(f"h{h}") for h in range(HUBS)]
        mixed = labelled.groupBy("key").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("k"), *hubs).where("low < high")
        mixed = mixed.select("key", "k", F.array(*[f"h{h}" for h in range(HUBS)]).alias("hubs"))
        live = cut(labelled.join(mixed, "key"))
        large = live.where(F.col("k") > SMALL_GROUP)
        small = live.where(F.col("k") <= SMALL_GROUP).select("key", "doc_id", "comp").join(info, "doc_id")
        order = ["key", "comp", "doc_id"]
        found = small.select(*order, "n", *SKETCH, "wide").repartition("key").sortWithinPartitions(*order).mapInArrow(
            _close_in_group(rule, turn if turn < NEAREST else None), "a long, b long")
        star = large.select("doc_id", "comp", F.explode("hubs").alias("hub")).where("comp <> hub.comp")
        star = star.select(F.greatest("doc_id", "hub.doc_id").alias("a"), F.least("doc_id", "hub.doc_id").alias("b"))
        comp = _merged(comp, _verified(found.union(star).distinct(), info, sets, rule))
        none = large.isEmpty()
        if none and turn >= NEAREST:
            return comp
        more = live.where((F.col("k") > FEW) & (F.col("k") <= SMALL_GROUP)).select("key", "doc_id")
        if none and more.isEmpty():
            return comp
        rest = large.where(~F.array_contains(F.col("hubs.doc_id"), F.col("doc_id"))).select("key", "doc_id")
        if not none:
            rest = _split(rest, sets, rule, turn + 1) if turn < SPLITS else cut(rest)
        # keys that were searched completely are done; the others are searched on
        live = rest if turn >= NEAREST else more.union(rest) if not none else more
        turn += 1


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (doc_id, comp) after new links (a, b): only the components that the links join are worked on."""
    if links.isEmpty():
        return comp
    x, y = comp.select(F.col("doc_id").alias("a"), F.col("comp").alias("x")), comp.select(F.col("doc_id").alias("b"), F.col("comp").alias("y"))
    found = components(links.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
    return cut(comp.join(found.withColumnRenamed("node", "comp"), "comp", "left").select("doc_id", F.coalesce("component", "comp").alias("comp")))


def _split(live: DataFrame, sets: DataFrame, rule: Similarity, turn: int) -> DataFrame:
    """Keys of large groups combined with the keys of another sketch; keys of a single set go."""
    own = sets.join(live.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_other_keys(rule, turn), "key long, doc_id long")
    both = live.join(own.withColumnRenamed("key", "other"), "doc_id").select(F.xxhash64("key", "other").alias("key"), "doc_id").distinct()
    several = both.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    return cut(both.join(several, "key", "left_semi"))


def _other_keys(rule: Similarity, turn: int):
    def run(batches):
        for batch in batches:
            for doc, raw in zip(batch.column("doc_id"), batch.column("set")):
                values = tx.mix(np.frombuffer(raw.as_buffer(), np.uint64) + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                keys, _ = block_keys(values, np.array([len(values)]), rule)
                yield tx.batch_of(PAIRED, keys.view(np.int64), np.full(len(keys), doc.as_py()))
    return run


class Wide:
    """Long sketches of a key's sets at every length that pairs are compared at."""

    def __init__(self, raw: list[bytes]):
        self.bits = np.array([len(b) * 8 for b in raw], np.int64)
        self.raw, self.folded = raw, {}

    def at(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of all sets with at least ``bits`` bits, folded to that length, and the row of each set among them."""
        if bits not in self.folded:
            own = np.flatnonzero(self.bits >= bits)
            place = np.zeros(len(self.bits), np.int64)
            place[own] = np.arange(len(own))
            rows = np.zeros((len(own), bits // 64), np.uint64)
            for k, i in enumerate(own.tolist()):
                whole = np.frombuffer(self.raw[i], np.uint64)
                rows[k] = np.bitwise_xor.reduce(whole.reshape(-1, bits // 64), axis=0)
            self.folded[bits] = rows, place
        return self.folded[bits]

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Hamming distances of pairs at the shorter of their lengths; 0 where a set has no long sketch."""
        bits, out = np.minimum(self.bits[i], self.bits[j]), np.zeros(len(i), np.int64)
        for length in np.unique(bits[bits > 0]).tolist():
            rows, place = self.at(length)
            own = np.flatnonzero(bits == length)
            step = max(1, ROW_PAIRS * 4 // rows.shape[1])
            for k in range(0, len(own), step):
                part = own[k:k + step]
                out[part] = np.bitwise_count(rows[place[i[part]]] ^ rows[place[j[part]]]).sum(1, dtype=np.int64)
        return out


def _close_in_group(rule: Similarity, rank: int | None):
    """Pairs of one key and different components whose sizes and sketches allow a link: all of them, or in a key of more than ``FEW`` sets
    for each set the one of a rank by sketch distance. Rows come sorted by key."""
    def pairs(d, comp, n, raw, sketch):
        if comp[0] == comp[-1]:
            return
        wide, every = Wide(raw), rank is None or len(d) <= FEW
        step = max(1, ROW_PAIRS // len(d))
        for at in range(0, len(d), step):
            own = slice(at, at + step)
            after = at if every else 0
            total = n[own, None] + n[None, after:]
            apart = sum(np.bitwise_count(sketch[own, None, j] ^ sketch[None, after:, j]).astype(np.int64) for j in range(4))
            other = comp[own, None] < comp[None, after:] if every else comp[own, None] != comp[None, after:]
            low = np.minimum(n[own, None], n[None, after:])
            good = other & (apart * (rule.q + rule.p) <= (rule.q - rule.p) * total) & (low * rule.q >= (total - low) * rule.p)
            i, j = np.nonzero(good)
            exact = np.maximum(apart[i, j], wide.apart(at + i, after + j))
            close = exact * (rule.q + rule.p) <= (rule.q - rule.p) * (n[at + i] + n[after + j])
            if every:
                i, j = i[close], j[close]
            else:
                good[i, j], apart[i, j] = close, exact
                far = np.where(good, apart, 1 << 20)
                k = np.minimum(rank, good.sum(1) - 1)
                i = np.flatnonzero(k >= 0)
                far, k = far[i], k[i]
                j = far.argmin(1)
                for r in range(rank):  # the next nearest, where there is one
                    more = np.flatnonzero(k > r)
                    far[more, j[more]] = 1 << 21
                    j[more] = far[more].argmin(1)
            x, y = d[at + i], d[after + j]
            yield tx.batch_of(VERIFIED, np.maximum(x, y), np.minimum(x, y))

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc_id", "comp", "n", "wide", *SKETCH)]
            held = cols if held is None else [np.concatenate(c) for c in zip(held, cols)]
            if not len(held[0]):
                continue
            edges = np.flatnonzero(np.diff(held[0])) + 1
            for i, j in zip([0, *edges[:-1]], edges):
                yield from pairs(*[c[i:j] for c in held[1:5]], np.stack([c[i:j] for c in held[5:]], 1).view(np.uint64))
            if len(edges):
                held = [c[edges[-1]:] for c in held]
        if held is not None and len(held[0]):
            yield from pairs(*held[1:5], np.stack(held[5:], 1).view(np.uint64))
    return run


def _verified(pairs: DataFrame, info: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    x = info.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), *[F.col(f"s{i}").alias(f"a{i}") for i in range(4)])
    y = info.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), *[F.col(f"s{i}").alias(f"b{i}") for i in range(4)])
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(4)), F.lit(0))
    close = (
        (apart * (rule.q + rule.p) <= (rule.q - rule.p) * (F.col("na") + F.col("nb")))
        & (F.least("na", "nb") * rule.q >= F.greatest("na", "nb") * rule.p)
    )
    pairs = pairs.join(x, "a").join(y, "b").where(close).select("a", "b")
    full = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b"
    )
    return cut(full.mapInArrow(verifier(rule), "a long, b long"))
