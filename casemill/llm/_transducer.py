"""Weighted acyclic automata over words, as arrays.

An automaton maps sequences of words to counts. The states of level k are the prefixes of k words, in order;
each has its parent in level k - 1, the label of the arc that leads to it, and its weight (0: not final).
Labels are places in a sorted list of words, so the order of states is the byte order of phrases. Counts differ
nearly everywhere, so only prefixes are shared, not suffixes.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _smallest(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and the place of each given word there."""
    found = words.dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), place[found.indices.to_numpy()]


@dataclass
class Transducer:
    words: pa.Array  # large_binary
    parents: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    def __len__(self) -> int:
        return sum(map(len, self.labels))

    @staticmethod
    def built(words: pa.Array, grams: np.ndarray, counts: np.ndarray) -> Transducer:
        """From sorted distinct sequences of one length (rows of places in ``words``): each adds the states behind the prefix it shares with the one before."""
        n, m = grams.shape
        used = np.unique(grams)
        grams = np.searchsorted(used, grams)
        new, state, parents, labels, weights = np.zeros(n, bool), np.zeros(n, np.int64), [], [], []
        new[:1] = True
        for k in range(m):
            new = new.copy()
            new[1:] |= grams[1:, k] != grams[:-1, k]
            at = np.flatnonzero(new)
            parents.append(state[at])
            labels.append(grams[at, k])
            weights.append(counts[at] if k == m - 1 else np.zeros(len(at), np.int64))
            state = np.cumsum(new) - 1
        return Transducer(words.take(pa.array(used)), parents, labels, weights)

    @staticmethod
    def union(parts: list[Transducer]) -> Transducer:
        """The automaton of all sequences, with the sum of their weights."""
        if len(parts) == 1:
            return parts[0]
        words, place = sorted_words(pa.concat_arrays([p.words for p in parts])) if parts else (pa.array([], pa.large_binary()), np.zeros(0, np.int64))
        ends = np.cumsum([0, *(len(p.words) for p in parts)])
        place = [place[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        above = [np.zeros(1, np.int64) for _ in parts]
        out = Transducer(words, [], [], [])
        for k in range(max((len(p.labels) for p in parts), default=0)):
            have = [i for i, p in enumerate(parts) if k < len(p.labels)]
            key = np.concatenate([above[i][parts[i].parents[k]] * len(words) + place[i][parts[i].labels[k]] for i in have])
            weight = np.concatenate([parts[i].weights[k] for i in have])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            state = np.empty(len(key), np.int64)
            state[order] = np.cumsum(first) - 1
            ends = np.cumsum([0, *(len(parts[i].labels[k]) for i in have)])
            for j, i in enumerate(have):
                above[i] = state[ends[j] : ends[j + 1]]
            key = key[first]
            out.parents.append(key // max(1, len(words)))
            out.labels.append(key % max(1, len(words)))
            out.weights.append(np.add.reduceat(weight[order], np.flatnonzero(first)) if len(key) else np.zeros(0, np.int64))
        return out

    def grams(self, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of k words with at least this weight, in order, and their weights."""
        if k > len(self.labels):
            return np.zeros((0, k), np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.weights[k - 1] >= least)
        out, weights = np.empty((len(at), k), np.int64), self.weights[k - 1][at]
        for j in range(k - 1, -1, -1):
            out[:, j] = self.labels[j][at]
            at = self.parents[j][at]
        return out, weights

    def at_least(self, least: int) -> Transducer:
        parts = [Transducer.built(self.words, *self.grams(k + 1, least)) for k in range(len(self.labels))]
        return Transducer.union([p for p in parts if len(p)])

    def total(self) -> int:
        return sum(int(w.sum()) for w in self.weights)

    def composed(self, counts: Transducer) -> Transducer:
        """Of the sequences that both accept, those of this automaton with the weights of ``counts``: both are walked at once, arc by arc."""
        both = pc.index_in(self.words, value_set=counts.words).fill_null(-1).to_numpy()
        own, theirs = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of states; own is sorted
        found = Transducer(self.words, [], [], [])
        for k in range(min(len(self.labels), len(counts.labels))):
            key = counts.parents[k] * len(counts.words) + counts.labels[k]
            above = np.minimum(np.searchsorted(own, self.parents[k]), max(0, len(own) - 1))
            goes = (own[above] == self.parents[k]) if len(own) else np.zeros(len(self.parents[k]), bool)
            label = both[self.labels[k]]
            goes &= label >= 0
            state = np.flatnonzero(goes)
            wanted = theirs[above[state]] * len(counts.words) + label[state]
            at = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
            hit = (key[at] == wanted) if len(key) else np.zeros(len(wanted), bool)
            found.parents.append(above[state[hit]])
            found.labels.append(self.labels[k][state[hit]])
            found.weights.append(np.where(self.weights[k][state[hit]] > 0, counts.weights[k][at[hit]], 0))
            own, theirs = state[hit], at[hit]
        return found

    def phrases(self, k: int) -> tuple[pa.Array, np.ndarray]:
        """The accepted sequences of k words, with spaces between, and their weights."""
        grams, weights = self.grams(k)
        columns = [self.words.take(pa.array(grams[:, j])) for j in range(k)]
        return (pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if k > 1 else columns[0]), weights

    def packed(self) -> bytes:
        words = self.words.to_pylist()
        raw = pickle.dumps((b"".join(words), _smallest(np.array([len(w) for w in words], np.int64)), [[_smallest(x) for x in level] for level in (self.parents, self.labels, self.weights)]), 5)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @staticmethod
    def unpacked(blob: bytes) -> Transducer:
        text, sizes, levels = pickle.loads(pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True))
        ends = np.cumsum([0, *sizes.astype(np.int64)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(text)])
        return Transducer(words, *([x.astype(np.int64) for x in level] for level in levels))
