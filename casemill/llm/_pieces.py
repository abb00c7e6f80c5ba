"""Documents of an Arrow batch taken together, so that numpy works on many short texts at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ._shared import U, lists, sliding, texts, token_hashes, window_hashes

PIECE = 1 << 18


@dataclass
class Piece:
    """Some rows of a batch: their texts, the tokens of all of them, and where each row's tokens begin."""

    first_row: int
    texts: list[bytes]
    hashes: np.ndarray
    first: np.ndarray  # first token of each row, and behind the last one
    known: list[np.ndarray]  # per given list column, the values of all rows

    def rows(self) -> range:
        return range(self.first_row, self.first_row + len(self.texts))

    def row_of(self, token: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, token, side="right") - 1

    def windows(self, length: int) -> np.ndarray:
        """Starts of the windows of so many tokens that lie in one row."""
        last = np.repeat(self.first[1:], np.diff(self.first)) - length  # the last start in each token's row
        s = np.arange(len(last))
        return s[s <= last]


def pieces(batch: pa.RecordBatch, known: list[str], lines: bool = False, lower: bool = False) -> Iterator[Piece]:
    """Split a batch into pieces of about PIECE bytes; a longer text makes a piece of its own. lower: A to Z become a to z."""
    held, size, row = [], 0, 0
    columns = [list(lists(batch, k)) for k in known]

    def made() -> Piece:
        own = token_hashes(b"\n".join(held), lines)
        at = np.cumsum([0, *(len(t) + 1 for t in held)])
        rows = slice(row, row + len(held))
        return Piece(row, held, own[0], np.searchsorted(own[1], at), [np.concatenate([np.zeros(0, U), *c[rows]]) for c in columns])

    for text in texts(batch):
        if held and size + len(text) > PIECE:
            yield made()
            held, size, row = [], 0, row + len(held)
        held.append(text.lower() if lower else text)
        size += len(text)
    if held:
        yield made()


TOP = U(0xFFFFFFFFFFFFFFFF)


class Anchors:
    """Winnowing: each window of ``length`` tokens of one row is represented by its run of ``short`` tokens of least hash.

    ``places`` are the runs that represent a window; where equal runs tie, each of them.
    """

    def __init__(self, piece: Piece, length: int, short: int):
        self.width = length - short + 1
        self.starts = piece.windows(length)
        self.h = window_hashes(piece.hashes, short)
        self.least = sliding(np.minimum, self.h, self.width)
        valid = np.zeros(len(self.least) + 2 * (self.width - 1), dtype=U)
        valid[self.starts + self.width - 1] = self.least[self.starts]
        self.places = np.flatnonzero((sliding(np.maximum, valid, self.width) == self.h) & (self.h > 0)) if len(self.least) else self.starts

    def without(self, known: np.ndarray) -> np.ndarray:
        """Starts of the windows whose run of least hash is not among the known ones."""
        gone = np.full(len(self.h), TOP)
        found = self.places[np.isin(self.h[self.places], known)]
        gone[found] = self.h[found]
        s = self.starts
        return s[sliding(np.minimum, gone, self.width)[s] != self.least[s]] if len(s) else s

    def place(self, starts: np.ndarray) -> np.ndarray:
        """The first run of least hash in each of these windows."""
        out, least = np.full(len(starts), -1), self.least[starts]
        for j in range(self.width):
            found = (out < 0) & (self.h[starts + j] == least)
            out[found] = starts[found] + j
        return out
