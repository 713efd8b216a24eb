"""Static range asymmetric numeral system for token ids, in blocks of interleaved lanes.

Ids of a document are cut into blocks of at most ``BLOCK`` ids. Id i of a block belongs to lane i mod ``LANES``; all lanes of
a block write 32-bit words to one stream. A block holds its own states and a checksum of its ids, so blocks can be decoded
in any order and in parallel; here all blocks of a batch advance together, one id per lane and step.

Block: id count, word count, checksum (32 bits each), the lanes' states (64 bits each), words. Little endian throughout.
"""

from __future__ import annotations

import zlib

import numpy as np

LANES = 4
BLOCK = 4096
BITS = 20
_LOW = np.uint64(1 << 31)
_M = np.uint64(BITS)
_W = np.uint64(32)
_HEAD = 12 + 8 * LANES


class Table:
    """Shared frequencies scaled to 2**BITS; every id of the vocabulary has at least one slot."""

    def __init__(self, counts: np.ndarray):
        total = 1 << BITS
        if len(counts) * 2 > total:
            raise ValueError("the vocabulary is too large for the table")
        counts = counts.astype(np.float64)
        spare = total - len(counts)
        scaled = np.floor(counts / max(counts.sum(), 1) * spare).astype(np.int64) + 1
        scaled[int(np.argmax(scaled))] += total - scaled.sum()
        self.freq = scaled.astype(np.uint64)
        self.low = np.concatenate([[0], np.cumsum(scaled)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), scaled)


def encode(ids: np.ndarray, counts: np.ndarray, table: Table) -> list[bytes]:
    """Blocks of consecutive runs of ``counts[i]`` ids (each at most BLOCK)."""
    if not len(counts):
        return []
    order = np.argsort(-counts, kind="stable")
    n = counts[order]
    base = (np.cumsum(counts) - counts)[order]
    room = np.concatenate([[0], np.cumsum(n)])[:-1]
    words = np.zeros(int(n.sum()), np.uint32)
    used = np.zeros(len(n), np.int64)
    state = np.full((len(n), LANES), _LOW, np.uint64)
    lane = np.arange(LANES)
    for step in range((int(n[0]) + LANES - 1) // LANES - 1, -1, -1):
        k = int(np.searchsorted(-n, -step * LANES, "left"))
        at = step * LANES + lane
        valid = at[None, :] < n[:k, None]
        s = ids[np.where(valid, base[:k, None] + at, 0)]
        f, x = table.freq[s], state[:k]
        full = valid & (x >= f << np.uint64(63 - BITS))
        if full.any():
            after = np.cumsum(full[:, ::-1], axis=1)[:, ::-1] - full
            words[(room[:k, None] + used[:k, None] + after)[full]] = (x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            used[:k] += full.sum(1)
            x = np.where(full, x >> _W, x)
        q = x // f
        state[:k] = np.where(valid, (q << _M) + (x - q * f) + table.low[s], x)
    out: list[bytes] = [b""] * len(n)
    wide = ids.astype("<u4")
    for i in range(len(n)):
        own = wide[base[i]:base[i] + n[i]]
        head = np.array([n[i], used[i], zlib.crc32(own.tobytes())], "<u4").tobytes()
        out[order[i]] = head + state[i].astype("<u8").tobytes() + words[room[i]:room[i] + used[i]][::-1].astype("<u4").tobytes()
    return out


def decode(blocks: list[bytes], table: Table) -> list[np.ndarray]:
    """Ids of every block; a wrong checksum or length is an error."""
    if not blocks:
        return []
    heads = np.array([np.frombuffer(b, "<u4", 3) for b in blocks], np.int64)
    order = np.argsort(-heads[:, 0], kind="stable")
    n, size = heads[order, 0], heads[order, 1]
    state = np.stack([np.frombuffer(blocks[i], "<u8", LANES, 12) for i in order]).astype(np.uint64)
    stream = np.concatenate([*(np.frombuffer(blocks[i], "<u4", offset=_HEAD) for i in order), np.zeros(1, "<u4")]).astype(np.uint32)
    if len(stream) != size.sum() + 1:
        raise ValueError("a block is cut short")
    at = np.concatenate([[0], np.cumsum(size)])[:-1]
    last = at + size
    base = np.concatenate([[0], np.cumsum(n)])[:-1]
    ids = np.zeros(int(n.sum()), np.uint32)
    lane, mask = np.arange(LANES), np.uint64((1 << BITS) - 1)
    for step in range((int(n[0]) + LANES - 1) // LANES):
        k = int(np.searchsorted(-n, -step * LANES, "left"))
        valid = (step * LANES + lane)[None, :] < n[:k, None]
        x = state[:k]
        slot = x & mask
        s = table.symbol[slot]
        ids[(base[:k, None] + step * LANES + lane)[valid]] = s[valid]
        y = np.where(valid, table.freq[s] * (x >> _M) + slot - table.low[s], x)
        short = valid & (y < _LOW)
        if short.any():
            place = at[:k, None] + np.cumsum(short, axis=1) - short
            y = np.where(short, (y << _W) | stream[np.minimum(place, len(stream) - 1)].astype(np.uint64), y)
            at[:k] += short.sum(1)
        state[:k] = y
    if not (at == last).all() or not (state == _LOW).all():
        raise ValueError("a block does not end as it was begun")
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(n)
    for i in range(len(n)):
        own = ids[base[i]:base[i] + n[i]]
        if zlib.crc32(own.astype("<u4").tobytes()) != heads[order[i], 2]:
            raise ValueError("a block has a wrong checksum")
        out[order[i]] = own
    return out
