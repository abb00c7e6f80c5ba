"""Nearest examples by TF-IDF cosine over all words of the examples, in a sparse inverted index.

Words are known by their 64-bit hashes. The COMMON words of most examples are kept as rows of a matrix,
so that many texts are multiplied at once; all other words have lists of places and weights. No word and
no example is left out. Words that no example has would lengthen a text's vector and so scale all of its
cosines alike; they are no part of its length. Cosines that agree to DIGITS digits tie, and go by place.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._shared import U, lists, signed, texts, token_hashes

COMMON = 256
TOGETHER = 64  # texts multiplied at once
DIGITS = 9

Bag = tuple[np.ndarray, np.ndarray]  # hashes of distinct words in order, and how often each stands there


def bag(text: bytes, letters: bytes) -> Bag:
    return np.unique(token_hashes(text.translate(letters))[0], return_counts=True)


def _bags(letters: bytes):
    def run(batches):
        for batch in batches:
            found = [bag(t, letters) for t in texts(batch)]
            columns = [pa.array([signed(h) for h, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.list_(pa.int32()))]
            yield pa.record_batch([batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "toxic")] + columns, names=["doc_id", "toxic", "words", "counts"])

    return run


def _frequencies(known, letters: bytes):
    def run(batches):
        words, rows = known.value, 0
        total = np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for text in texts(batch):
                rows += 1
                total[_places(words, bag(text, letters)[0])[0]] += 1
        own = np.flatnonzero(total)
        yield pa.record_batch([pa.array([-1, *own], pa.int64()), pa.array([rows, *total[own]], pa.int64())], names=["word", "df"])

    return run


def _places(words: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of those of ``h`` that are among the sorted words, and which they are."""
    at = np.minimum(np.searchsorted(words, h), len(words) - 1) if len(words) else np.zeros(len(h), np.int64)
    is_known = words[at] == h if len(words) else np.zeros(len(h), bool)
    return at[is_known], is_known


class Packed:
    """Compressed when it is sent around, as each executor holds a copy on its disk; array by array, as the driver's memory is short."""

    def __getstate__(self) -> dict:
        kept = {k: v for k, v in vars(self).items() if k not in ("lists", "common", "matrix")}
        return {k: (v.dtype.str, v.shape, zlib.compress(np.ascontiguousarray(v), 1)) if isinstance(v, np.ndarray) else v for k, v in kept.items()}

    def __setstate__(self, state: dict) -> None:
        vars(self).update({k: np.frombuffer(zlib.decompress(v[2]), v[0]).reshape(v[1]) if isinstance(v, tuple) else v for k, v in state.items()})


@dataclass
class Whole(Packed):
    words: np.ndarray  # sorted hashes
    idf: np.ndarray
    n: np.ndarray  # examples that hold each word
    places: np.ndarray  # those examples, word by word
    counts: np.ndarray  # how often the word stands in each of them
    sizes: np.ndarray  # length of each example's vector
    ids: np.ndarray
    toxic: np.ndarray
    levels: np.ndarray | None = None  # score of each bin of votes of texts without a kept term

    @cached_property
    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's list begins, and the end of the last; the weights in the lists."""
        return np.cumsum([0, *self.n]), (1 + np.log(self.counts)) * np.repeat(self.idf, self.n) / self.sizes[self.places]

    @cached_property
    def common(self) -> np.ndarray:
        """Row of each word in the matrix, or -1."""
        most = np.sort(np.argsort(-self.n, kind="stable")[:COMMON])
        out = np.full(len(self.words), -1)
        out[most] = np.arange(len(most))
        return out

    @cached_property
    def matrix(self) -> np.ndarray:
        row = np.repeat(self.common, self.n)
        out = np.zeros((self.common.max(initial=-1) + 1, len(self.ids)))
        out[row[row >= 0], self.places[row >= 0]] = self.lists[1][row >= 0]
        return out

    def vector(self, own: Bag) -> tuple[np.ndarray, np.ndarray]:
        t, known = _places(self.words, own[0])
        v = (1 + np.log(own[1][known])) * self.idf[t]
        return t, v / (np.sqrt((v * v).sum()) or 1)

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector the examples of the k largest cosines over 0, and the cosines; examples ``but`` of each left out."""
        ends, weights = self.lists
        for at in range(0, len(vectors), TOGETHER):
            some = vectors[at : at + TOGETHER]
            left = np.zeros((len(some), len(self.matrix)))
            for row, (t, v) in enumerate(some):
                c = self.common[t]
                left[row, c[c >= 0]] = v[c >= 0]
            for row, ((t, v), cosines) in enumerate(zip(some, left @ self.matrix, strict=True)):
                t, v = t[self.common[t] < 0], v[self.common[t] < 0]
                n = self.n[t]
                own = np.arange(n.sum()) + np.repeat(ends[t] - np.cumsum(n) + n, n)
                cosines = np.round(cosines + np.bincount(self.places[own], np.repeat(v, n) * weights[own], len(self.ids)), DIGITS)
                if but is not None:
                    cosines[but[at + row]] = 0
                least = np.partition(cosines, -k)[-k] if len(cosines) > k else 0
                found = np.flatnonzero((cosines >= least) & (cosines > 0))
                found = found[np.argsort(-cosines[found], kind="stable")[:k]]
                yield found, cosines[found]

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        return float((cosines * self.toxic[places]).sum() / cosines.sum()) if len(places) else 0.0


def _left_out(index, chosen: Callable[[], Callable[[bytes], bool]], letters: bytes, k: int):
    def run(batches):
        whole, fits = index.value, chosen()
        for batch in batches:
            ids, toxic = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "toxic"))
            held = [(i, y, t) for i, y, t in zip(ids, toxic, texts(batch), strict=True) if fits(t)]
            found = whole.nearest([whole.vector(bag(t, letters)) for *_, t in held], k, [np.flatnonzero(whole.ids == i) for i, *_ in held])
            votes = [whole.vote(*x) for x in found]
            yield pa.record_batch([pa.array([i for i, *_ in held], pa.int64()), pa.array([y for _, y, _ in held], pa.int64()), pa.array(votes, pa.float64())], names=["doc_id", "toxic", "vote"])

    return run


def build(docs: DataFrame, rows: DataFrame, letters: bytes) -> Whole | None:
    """The index of the examples ``rows`` (doc_id, text, toxic); document frequencies over ``docs``."""
    spark = docs.sparkSession
    told = rows.mapInArrow(_bags(letters), "doc_id bigint, toxic int, words array<bigint>, counts array<int>").toArrow()
    if not told.num_rows:
        return None
    ids, toxic = (told.column(c).to_numpy() for c in ("doc_id", "toxic"))
    bags = [bag for batch in told.to_batches() for bag in zip(lists(batch, "words"), lists(batch, "counts", np.int32), strict=True)]
    del told
    often = Counter(zip(ids.tolist(), toxic.tolist(), strict=True))
    own = lambda x: tuple(b.tobytes() for b in bags[x]) if often[ids[x], toxic[x]] > 1 else ()
    order = sorted(range(len(ids)), key=lambda x: (ids[x], toxic[x], own(x)))
    ids, toxic, bags = ids[order], toxic[order].astype(float), [bags[x] for x in order]
    place = np.repeat(np.arange(len(ids), dtype=np.int32), [len(b[0]) for b in bags])
    found, counts = (np.concatenate([b[c] for b in bags]) for c in (0, 1))
    del bags
    pa.default_memory_pool().release_unused()
    by_word = np.argsort(found, kind="stable")  # the words of an example stay in their order
    found, place, counts = found[by_word], place[by_word], counts[by_word]
    del by_word
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
    words, n_of = found[first], np.diff(first, append=len(found))
    del found
    known = spark.sparkContext.broadcast(words)
    counted = docs.mapInArrow(_frequencies(known, letters), "word bigint, df bigint").groupBy("word").agg(F.sum("df").alias("df")).toArrow()
    known.destroy()
    at, n = counted["word"].to_numpy(), counted["df"].to_numpy()
    df = np.zeros(len(words))
    df[at[at >= 0]] = n[at >= 0]
    idf = np.log(1 + n[at < 0].sum() / (1 + df))
    weights = 1 + np.log(counts.astype(np.int64))
    weights *= np.repeat(idf, n_of)
    weights **= 2
    return Whole(words, idf, n_of, place, counts, np.sqrt(np.bincount(place, weights, len(ids))), ids, toxic)


def votes(whole: Whole, rows: DataFrame, chosen: Callable[[], Callable[[bytes], bool]], letters: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, toxic and the vote of the other documents' examples, of each example in ``rows`` whose text ``chosen()`` accepts."""
    index = rows.sparkSession.sparkContext.broadcast(whole)
    told = rows.mapInArrow(_left_out(index, chosen, letters, k), "doc_id bigint, toxic bigint, vote double").toArrow()
    index.destroy()
    return tuple(told[c].to_numpy() for c in ("doc_id", "toxic", "vote"))
