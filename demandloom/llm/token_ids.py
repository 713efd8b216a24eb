"""Token ids of a library tokenizer for whole texts, with a memory of text pieces.

A byte-level pre-tokenizer breaks a text at white space and between letters, digits and other signs. A text is cut where
such a break is certain: before a single ASCII white-space character between two other characters, and between ASCII letters,
digits and signs (not next to an apostrophe, which may begin a contraction, nor next to characters beyond ASCII that may be white
space). Pieces are encoded by the library and remembered by hash; the ids of a text are those of its pieces, and equal to those
the library gives for the whole text. Cuts left out only make pieces longer.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa

from demandloom.llm import text as tx

MEMORY_PIECES = 2_000_000
RUN = 32

_KIND = np.full(256, 3, np.uint8)  # 0 white space, 1 letter, 2 digit, 3 sign, 4 apostrophe, 5 beyond ASCII
_KIND[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = 0
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[ord("'")] = 4
_KIND[0x80:] = 5
# Lead bytes of all characters beyond ASCII that are white space.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def cuts(texts: tx.Texts) -> np.ndarray:
    """Byte offsets at which pieces begin, text by text; an empty text has none."""
    data = texts.data
    n = len(data)
    begins = np.zeros(n + 1, bool)
    if n:
        kind = _KIND[data]
        space = kind == 0
        # characters whose last byte may end beyond-ASCII white space: their lead byte is up to two bytes before
        lead = _LEADS[data]
        near = lead.copy()
        near[1:] |= lead[:-1]
        near[2:] |= lead[:-2]
        solid = ~space & ~near
        single = np.zeros(n, bool)
        single[1:-1] = space[1:-1] & solid[:-2] & solid[2:] & (data[1:-1] < 0x1C) | (data[1:-1] == 0x20) & solid[:-2] & solid[2:]
        begins[:n] |= single
        plain = (kind >= 1) & (kind <= 3)
        begins[1:n] |= plain[1:] & plain[:-1] & (kind[1:] != kind[:-1])
        begins[texts.offsets[:-1]] = True
    return np.flatnonzero(begins[:n])


def byte_letters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte: printable ones themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class IdEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.width = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        # A special token's own text must not be cut: with such a token around, only white space cuts.
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        letters = byte_letters()
        self.shown = np.array([ord(letters[b]) for b in range(256)], "<u4")
        # Words go to the library's model directly if its pre-tokenizer is the plain byte-level one.
        plain = Tokenizer(self.library.model)
        plain.pre_tokenizer = ByteLevel(add_prefix_space=False)
        probe = " Word's été 12 (x) "
        self.words = plain.encode(probe, add_special_tokens=False).ids == self.library.encode(probe, add_special_tokens=False).ids
        self.zero = letters[0]
        self.letters = np.zeros(self.size, np.int64)  # of every token, by which the ids of a run of words fall apart again
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.letters[i] = len(token)
        self._clear()

    def _clear(self) -> None:
        # Numbers of the remembered pieces at the slots of their hashes (the next free one where that is taken; -1: free), and their hashes.
        self.slots = np.full(1 << 16, -1, np.int32)
        self.known = np.zeros(0, np.uint64)
        self.ids = np.zeros(0, self.width)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        encode = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        return [e.ids for e in encode(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Remember the pieces ``data[starts:ends]``, whose hashes ``keys`` are distinct and new."""
        shown, raw = self.shown[data].tobytes().decode("utf-32-le"), data.tobytes()
        signs = np.concatenate([[0], np.cumsum(_KIND[data] != 1)])
        spaced = data[starts] == 0x20
        plain = (signs[ends] == signs[starts + spaced]) & (ends > starts + spaced) & self.words
        words, others = np.flatnonzero(plain).tolist(), []
        for k in np.flatnonzero(~plain).tolist():
            piece = raw[starts[k]:ends[k]].decode()
            if self.words and (piece[1:] if piece[0] == " " else piece).isalpha():
                words.append(k)
            else:
                others.append((k, piece))
        words = np.array(words, np.int64)
        found, counts = self._run(shown, starts[words], ends[words], spaced[words])
        rest = self._library([p for _, p in others])
        more = np.fromiter(map(len, rest), np.int64, len(rest))
        count = np.concatenate([counts, more])
        self.begin = np.append(self.begin, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.concatenate([self.ids, found, np.fromiter(chain.from_iterable(rest), self.width, int(more.sum()))])
        self.known = np.concatenate([self.known, keys[words], keys[np.array([k for k, _ in others], np.int64)]])
        self._enter(len(self.known) - len(keys))

    def _run(self, shown: str, starts: np.ndarray, ends: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``shown[starts:ends]``, and their numbers of ids. The library's model gets many words as one, with a zero byte before those
        that do not begin with a space. Tokens only grow, so where a token ends at a word's end nothing was merged across; a word
        with such a token at an end is encoded by itself."""
        tokenize, size, gap = self.library.model.tokenize, ends - starts, (~spaced).astype(np.int64)
        begin = np.cumsum(size + gap) - size  # of the words in the run
        parts = [shown[i:j] if s else self.zero + shown[i:j] for i, j, s in zip(starts.tolist(), ends.tolist(), spaced.tolist())]
        ids = []
        for i in range(0, len(parts), RUN):
            ids += [t.id for t in tokenize("".join(parts[i:i + RUN]))]
        ids = np.array(ids, np.int64)
        places = tx.offsets_of(self.letters[ids])
        first, last = np.searchsorted(places, begin), np.searchsorted(places, begin + size)
        alone = np.ones(len(parts), bool)
        if len(parts) and places[-1] == begin[-1] + size[-1]:
            alone = (places[first] != begin) | (places[last] != begin + size)
        counts = np.where(alone, 0, last - first)
        own = {k: [t.id for t in tokenize(shown[starts[k]:ends[k]])] for k in np.flatnonzero(alone).tolist()}
        counts[list(own)] = [len(x) for x in own.values()]
        out = np.zeros(int(counts.sum()), self.width)
        ends = np.cumsum(counts)
        from_run = np.flatnonzero(~alone)
        out[tx.spans((ends - counts)[from_run], counts[from_run])] = ids[tx.spans(first[from_run], counts[from_run])]
        for k, x in own.items():
            out[ends[k] - len(x):ends[k]] = x
        return out, counts

    def _enter(self, first: int) -> None:
        """Give the pieces from number ``first`` on their slots; a third of the slots are taken at most."""
        if len(self.known) * 3 > len(self.slots):
            self.slots = np.full(1 << (len(self.known) * 6).bit_length(), -1, np.int32)
            first = 0
        number = np.arange(first, len(self.known), dtype=np.int32)
        last = len(self.slots) - 1
        slot = (self.known[first:] & np.uint64(last)).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]
            left = self.slots[slot] != number
            number, slot = number[left], (slot[left] + 1) & last

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with the hashes ``keys``, -1 for new ones."""
        last = len(self.slots) - 1
        slot = (keys & np.uint64(last)).astype(np.int64)
        place = self.slots[slot].astype(np.int64)
        if not len(self.known):
            return place
        wrong = np.flatnonzero((self.known[place] != keys) & (place >= 0))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & last
            place[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(place[wrong] >= 0) & (self.known[place[wrong]] != keys[wrong])]
        return place

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as bytes of type ``width``."""
        texts = list(texts)
        out: list[bytes] = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = np.array(ids, self.width).tobytes()
        apart = set(whole)
        usual = [i for i in range(len(texts)) if i not in apart and texts[i]]
        if not usual:
            return out
        column = tx.texts_of(pa.array([texts[i] for i in usual], pa.large_string()))
        starts = cuts(column)
        ends = np.append(starts[1:], len(column.data))
        hashed = tx.hashes(column, tx.Words(starts, ends, starts))
        if len(self.known) > MEMORY_PIECES:
            self._clear()
        own = self._places(hashed)
        new = np.flatnonzero(own < 0)
        if len(new):
            keys, first = np.unique(hashed[new], return_index=True)
            at = new[first]
            self._learn(keys, column.data, starts[at], ends[at])
            own[new] = self._places(hashed[new])
        counts = self.count[own]
        flat = self.ids[tx.spans(self.begin[own], counts)]
        bounds = tx.offsets_of(counts)[np.append(np.searchsorted(starts, column.offsets[:-1]), len(starts))]
        for i, a, b in zip(usual, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = flat[a:b].tobytes()
        return out


_encoders: dict[str, IdEncoder] = {}


def encoder(path: str) -> IdEncoder:
    """One encoder per worker process, so that its memory serves later tasks."""
    if path not in _encoders:
        _encoders[path] = IdEncoder(path)
    return _encoders[path]
