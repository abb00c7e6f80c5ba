"""Removal of repeated substrings by level-wise doubling.

A window of ``length`` words repeats when the same words start anywhere else, in the same document or
another. Candidates grow in levels: short runs of ``start`` words first, then runs of twice that
length, and so on up to ``length``; only what repeats at one level is looked at on the next.

- The first level takes one run per window, its anchor: the run with the least hash. Equal windows
  have equal anchors, so a window whose anchor occurs once cannot repeat.
- The next levels take the runs of doubled length that begin or end at an anchor still alive.
- The last level takes the windows themselves that lie around anchors still alive.

Each level is one aggregation by hash. What goes back to the documents is the list of hashes that
occur once, which belongs to one document each; so no group of equal windows is ever brought together
and a passage that a third of all documents share costs one partial count per task.

Hashes have 64 bits and differ between levels; a window is taken for repeated only if its hash and
those of its runs on every level before are.

Rows with a null text have no words. Rows may share a doc_id or have none: they stay separate
documents, and a text given twice repeats all of its windows. Texts with fewer than ``length`` words
are kept whole. An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._pieces import Anchors, Piece, pieces
from ._shared import signed, small_batches, window_hashes

LENGTH = 35
START = 9


def ladder(length: int, start: int) -> list[int]:
    """The lengths of the levels: start, twice that, ..., length."""
    steps = [start]
    while steps[-1] * 2 < length:
        steps.append(steps[-1] * 2)
    return [*(s for s in steps if s < length), length]


def survivors(piece: Piece, steps: list[int]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The windows alive after the levels that the piece knows, and place and hash of the runs that the next level takes."""
    length, short = steps[-1], steps[0]
    marks = Anchors(piece, length, short)
    if not piece.known:
        return marks.starts, [(marks.places, marks.h[marks.places])]
    s = marks.without(piece.known[0])
    a = marks.place(s)
    for level, step in enumerate(steps[1:], 1):
        if step == length:
            runs = [(s, np.ones(len(s), dtype=bool))]
        else:  # from the anchor on, or up to the anchor's end, as far as the window holds them
            runs = [(a, a + step <= s + length), (a + short - step, a + short - step >= s)]
        taken = []
        for at, fits in runs:
            place, back = np.unique(at[fits], return_inverse=True)
            taken.append((place, window_hashes(piece.hashes, step, place), fits, back))
        if level == len(piece.known):
            return s, [t[:2] for t in taken]
        alive = np.ones(len(s), dtype=bool)
        for _, own, fits, back in taken:
            alive[fits] &= ~np.isin(own, piece.known[level])[back]
        s, a = s[alive], a[alive]
    return s, []


def _level(steps: list[int], known: list[str]):
    """(h, key) of the runs of the next level."""

    def run(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
            for piece in pieces(batch, known):
                for place, h in survivors(piece, steps)[1]:
                    owner = keys[piece.first_row + piece.row_of(place)] if len(place) else place
                    yield pa.record_batch([pa.array(signed(h)), pa.array(owner)], names=["h", "key"])

    return run


def _cut(steps: list[int], known: list[str]):
    """Each row with the words kept."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for piece in pieces(batch, known):
                starts = survivors(piece, steps)[0]
                change = np.zeros(len(piece.hashes) + 1, dtype=np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + steps[-1], -1)
                stays = np.cumsum(change[:-1]) == 0
                for k, text in enumerate(piece.texts):
                    own = stays[piece.first[k] : piece.first[k + 1]]
                    words = text.split()
                    n_words.append(len(words))
                    n_removed.append(len(words) - int(own.sum()))
                    kept.append(b" ".join(words if own.all() else compress(words, own)))
            yield pa.record_batch(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return run


def once(rows: DataFrame, name: str) -> DataFrame:
    """(key, name): the hashes that occur once, listed for the key of the row that has them."""
    alone = rows.groupBy("h").agg(F.count("*").alias("n"), F.first("key").alias("key")).where("n = 1")
    return alone.groupBy("key").agg(F.collect_list("h").alias(name))


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key: the doc_id, or a hash of the text where it is null. Keys need not be distinct."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("key"), "text")


def remove_repeats(docs: DataFrame, length: int = LENGTH, start: int = START) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of ``docs``: its words not covered by a repeated window, joined by a space."""
    small_batches(docs.sparkSession)
    steps, held, known = ladder(length, start), keyed(docs), []
    for step in steps:
        name = f"once_{step}"
        runs = held.mapInArrow(_level(steps, known), "h bigint, key bigint")
        held = held.join(once(runs, name), "key", "left")
        known = [*known, name]
    return held.mapInArrow(_cut(steps, known), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
