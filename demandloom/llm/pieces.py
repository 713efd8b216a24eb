"""A SentencePiece vocabulary as a unigram model, and the cut of a text into parts that pieces never cross.

The file holds merge ranks, not probabilities; a piece of rank r has probability proportional to 1 / (r + 1) (Zipf's law).
Byte pieces and runs of spaces, which have no rank, count as the last rank. As in SentencePiece, a text that is not empty gets a space in front
and spaces become U+2581; a character that is no piece is written as its UTF-8 bytes. No piece has a space after another
character, so a text falls into parts that begin with spaces; a part that holds line breaks falls apart there too.
"""

from __future__ import annotations

import math
import re

SPACE = "▁"
_PARTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        ranks = {i: -model.get_score(i) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        total = math.log(sum(1 / (r + 1) for r in range(size)))
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * size
        self.last = -math.log(size) - total
        self.byte_id = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.raw[i] = bytes([value])
            elif i in ranks:
                if any(c == SPACE for c in piece[1:]) and piece.strip(SPACE) or "\n" in piece:
                    raise ValueError("the vocabulary has pieces across parts")
                self.id[piece] = i
                self.score[piece] = -math.log(min(ranks[i], size - 1) + 1) - total
                self.raw[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.id))

    def parts(self, text: str) -> list[str]:
        return _PARTS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def edges(self, part: str, start: int):
        """(length in characters, ids, score) of all pieces of ``part`` at ``start``."""
        found = []
        for n in range(1, min(self.longest, len(part) - start) + 1):
            piece = part[start:start + n]
            if piece in self.id:
                found.append((n, (self.id[piece],), self.score[piece]))
        if not found or found[0][0] > 1:
            raw = part[start].encode("utf-8", "replace")
            found.insert(0, (1, tuple(self.byte_id[b] for b in raw), self.last * len(raw)))
        return found

    def decode(self, ids) -> str:
        text = b"".join([self.raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary at ``path``, loaded once per worker process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]
