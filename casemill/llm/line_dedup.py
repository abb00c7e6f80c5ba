"""Removal of repeated runs of lines, found by winnowing.

A line is what stands between line feeds; empty lines are no part of runs and stay. A run is ``run`` or more consecutive lines. A line goes when it lies in a run of
``run`` lines that occurs earlier: in a document with a smaller doc_id, or further up in the same one.
So the first occurrence of every run stays whole.

- Winnowing: of each window of ``run`` line hashes the least one is a fingerprint. Any run of that
  length has one, and equal runs have equal ones, so no repeat can be missed.
- Fingerprints that occur once are reported back to their documents. All others are extended both
  ways: the windows around them are hashed whole, and the first occurrence of each window is found.
- What is removed is the union of the windows that are not first, which is each later match extended
  to its full length.

Both steps aggregate by hash, so a line that a third of all documents share costs one partial row a
task; the lists that go back belong to one document each. Hashes have 64 bits.

Rows with a null text keep it. Rows without doc_id come last, in the order of a hash of their text;
rows of one doc_id come in that order too; rows that repeat doc_id and text count as one document and
get the same result. All columns of the input stay, whatever their names, with ``text`` replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ._pieces import Anchors, Piece, pieces
from ._shared import U, mix, signed, small_batches, window_hashes

RUN = 3


def _tags(h: np.ndarray, place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One value for a window, its place and its document."""
    return mix(h ^ mix(place.astype(U) + mix(key.view(U))))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _fingerprints(run: int):
    def read(batches):
        for batch in batches:
            keys = _column(batch, "key").to_numpy()
            for piece in pieces(batch, [], lines=True):
                marks = Anchors(piece, run, 1)
                owner = keys[piece.first_row + piece.row_of(marks.places)]
                yield pa.record_batch([pa.array(signed(marks.h[marks.places])), pa.array(owner)], names=["h", "key"])

    return read


def _candidates(piece: Piece, run: int, keys: np.ndarray):
    """The windows around repeated fingerprints: start, row in the batch, hash, place in the document, tag."""
    s = Anchors(piece, run, 1).without(piece.known[0])
    row = piece.row_of(s)
    h, place = window_hashes(piece.hashes, run, s), s - piece.first[row]
    row = row + piece.first_row
    return s, row, h, place, _tags(h, place, keys[row])


def _windows(run: int):
    def read(batches):
        for batch in batches:
            keys, ids = _column(batch, "key"), _column(batch, "doc_id")
            for piece in pieces(batch, ["once"], lines=True):
                s, row, h, place, tag = _candidates(piece, run, keys.to_numpy())
                yield pa.record_batch([pa.array(signed(h)), ids.take(pa.array(row)), keys.take(pa.array(row)), pa.array(place), pa.array(signed(tag))], names=["h", "doc_id", "key", "place", "tag"])

    return read


def _without(text: bytes, gone: np.ndarray) -> bytes:
    lines = text.split(b"\n")
    stays = np.ones(len(lines), dtype=bool)
    stays[[k for k, x in enumerate(lines) if x]] = ~gone
    return b"\n".join(compress(lines, stays))


def _cut(run: int):
    def read(batches):
        for batch in batches:
            keys, out, n_gone = _column(batch, "key").to_numpy(), [], []
            for piece in pieces(batch, ["once", "first"], lines=True):
                s, *_, tag = _candidates(piece, run, keys)
                later = s[~np.isin(tag, piece.known[1])]
                change = np.zeros(len(piece.hashes) + 1, dtype=np.int64)
                np.add.at(change, later, 1)
                np.add.at(change, later + run, -1)
                gone = np.cumsum(change[:-1]) > 0
                for k, text in enumerate(piece.texts):
                    own = gone[piece.first[k] : piece.first[k + 1]]
                    out.append(_without(text, own) if own.any() else text)
                    n_gone.append(int(own.sum()))
            known = _column(batch, "text").is_valid().to_pylist()
            text = pa.array([t if k else None for t, k in zip(out, known, strict=True)], pa.binary()).cast(pa.string())
            yield pa.record_batch([_column(batch, "rest"), text, pa.array(n_gone, pa.int64())], names=["rest", "text", "n_removed"])

    return read


def remove_lines(docs: DataFrame, run: int = RUN, count: str = "n_removed_lines") -> DataFrame:
    """``docs`` with the later repeated runs of lines cut from ``text``, and the number of lines cut in column ``count``."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != "text"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = held.withColumn("key", F.xxhash64(F.isnull("doc_id"), "doc_id", "text"))
    narrow = held.select("doc_id", "key", "text")
    marks = narrow.mapInArrow(_fingerprints(run), "h bigint, key bigint")
    alone = marks.groupBy("h").agg(F.count("*").alias("n"), F.first("key").alias("key"))
    once = alone.where("n = 1").groupBy("key").agg(F.collect_list("h").alias("once"))
    windows = narrow.join(once, "key", "left").mapInArrow(_windows(run), "h bigint, doc_id bigint, key bigint, place bigint, tag bigint")
    order = F.struct(F.isnull("doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("key").alias("c"), F.col("place").alias("d"))
    first = windows.groupBy("h").agg(F.min(F.struct(order.alias("at"), "key", "tag")).alias("w")).select("w.key", "w.tag")
    first = first.groupBy("key").agg(F.collect_list("tag").alias("first"))
    schema = T.StructType([held.schema["rest"], T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])
    cut = held.join(once, "key", "left").join(first, "key", "left").mapInArrow(_cut(run), schema)
    return cut.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns], F.col("n_removed").alias(count))
