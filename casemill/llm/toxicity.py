"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Training, from labelled rows only:

- At most ``examples`` labelled documents, those of least hash of doc_id, are the examples (default
  8000; the only sample taken, bounded so that the index can be sent to all tasks).
- Terms are words in lower case and the first 4 and 6 bytes of longer words. Terms kept are those
  whose presence depends on the label in the examples (chi-square of at least CHI2), the strongest TERMS
  of them. A term counts once for each pair of words around it, so copies and near copies of an example
  add nothing; in either half of those contexts it must be in LEAST toxic examples. Their document frequencies for the inverse document
  frequency are counted over all documents.
- Examples with a term are sorted by their strongest term and dealt into blocks of BLOCK; the inverted
  index keeps each term's largest weight per block.

Scoring a document: the block maxima bound the cosine in each block from above; blocks are visited
from the largest bound down until the bound falls below the k-th best cosine, so the k nearest are
exact (ties by place in the index). Their labels vote with cosine as weight. A vote becomes a score by
the share of toxic examples among examples of a like vote (leave one out), made monotone.

Texts without any kept term are held against all words of all examples (``_whole``): the nearest vote,
and the vote becomes a score by the examples that have no kept term either. Only texts that share no
word with any example, empty and null ones among them, get the share of toxic examples among examples
without kept terms. ``evidence`` lists doc_ids and cosines of the neighbours that voted.

Nothing but the text enters a score. Labels that are null are ignored; a doc_id labelled twice trains
twice. With no labelled row of either class every score is the smoothed share of toxic rows. Other columns stay,
but for those named like a result, which it replaces; an empty table gives an empty result. Rows without doc_id
are scored like others, and can't be examples.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import _whole
from ._shared import small_batches, stored, texts

EXAMPLES = 8000
TERMS = 512
CHI2 = 28.0
LEAST = 3
NEAREST = 15
BLOCK = 64
BINS = 10
THRESHOLD = 0.3

_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def terms_of(word: bytes) -> list[bytes]:
    """A word, and its beginnings."""
    return [word, *(word[:n] + b"*" for n in (4, 6) if len(word) > n)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _all_terms(batches):
    """(term, toxic, context): each term of a text once, with a digest of the words around it."""
    for batch in batches:
        toxic = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
        for text, y in zip(texts(batch), toxic, strict=True):
            own, found = [b"", *text.translate(_LETTERS).split(), b""], {}
            for k in range(1, len(own) - 1):
                for t in terms_of(own[k]):
                    if t not in found:
                        found[t] = crc32(b" ".join(own[k - 1 : k + 2]))
            yield pa.record_batch([pa.array(list(found), pa.binary()), pa.array([int(y)] * len(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["term", "toxic", "context"])


class Features:
    """Counts of the kept terms in texts; what a word stands for is remembered for REMEMBERED words."""

    REMEMBERED = 500_000

    def __init__(self, terms: list[bytes]):
        self.id = {t: k for k, t in enumerate(terms)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> dict[int, int]:
        counts: dict[int, int] = {}
        known = self.known
        for w in text.translate(_LETTERS).split():
            ids = known.get(w)
            if ids is None:
                if len(known) > self.REMEMBERED:
                    known.clear()
                ids = known[w] = tuple(self.id[t] for t in terms_of(w) if t in self.id)
            if ids:
                for t in ids:
                    counts[t] = counts.get(t, 0) + 1
        return counts


def _without(terms: list[bytes]):
    """Makes the test whether a text has none of the terms."""

    def test():
        features = Features(terms)
        return lambda text: not features(text)

    return test


def _frequencies(terms: list[bytes]):
    def run(batches):
        features, total, rows = Features(terms), np.zeros(len(terms), dtype=np.int64), 0
        for batch in batches:
            for text in texts(batch):
                rows += 1
                for t in features(text):
                    total[t] += 1
        yield pa.record_batch([pa.array([-1, *range(len(terms))], pa.int64()), pa.array([rows, *total.tolist()], pa.int64())], names=["term", "df"])

    return run


def _counted(terms: list[bytes]):
    def run(batches):
        features = Features(terms)
        for batch in batches:
            found = [features(t) for t in texts(batch)]
            lists = lambda f: pa.array([[int(x) for x in f(c)] for c in found], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("toxic")), lists(dict.keys), lists(dict.values)], names=["doc_id", "toxic", "terms", "counts"])

    return run


@dataclass
class Model(_whole.Packed):
    terms: list[bytes]
    idf: np.ndarray
    blocks: np.ndarray  # block x term x example, vectors of length 1
    maxima: np.ndarray  # term x block
    toxic: np.ndarray
    ids: np.ndarray
    levels: np.ndarray  # score of each bin of votes
    none: float  # score of texts without terms
    whole: _whole.Whole | None = None  # all words of the examples, for texts without terms

    @property
    def weights(self) -> np.ndarray:
        """Example by term."""
        return self.blocks.transpose(0, 2, 1).reshape(-1, len(self.terms))[: len(self.toxic)]

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        t = np.fromiter(sorted(counts), dtype=np.int64, count=len(counts))
        v = (1 + np.log(np.array([counts[x] for x in t], dtype=float))) * self.idf[t]
        return t, v / np.sqrt((v * v).sum())

    def nearest(self, t: np.ndarray, v: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The examples of the k largest cosines over 0, and the cosines; example ``but`` left out.

        Bounds and cosines are sums in one order, so that rounding never puts a cosine above its bound.
        Blocks are visited by their bounds, twice as many at a time as before; those of equal bounds in
        their order: behind the k-th place an equal one can't win.
        """
        bounds = (v[:, None] * self.maxima[t]).sum(0)
        best, places = np.zeros(0), np.zeros(0, dtype=np.int64)
        order, at, step = np.argsort(-bounds, kind="stable"), 0, 1
        while at < len(order):
            block = order[at]
            if bounds[block] <= 0 or len(best) == k and (bounds[block] < best[-1] or bounds[block] == best[-1] and block * BLOCK > places[-1]):
                break
            some = order[at : at + step, None]
            at, step = at + step, 2 * step
            cosines, own = (v[None, :, None] * self.blocks[some, t]).sum(1).ravel(), (some * BLOCK + np.arange(BLOCK)).ravel()
            fits = (cosines > 0) & (cosines >= (best[-1] if len(best) == k else 0)) & (own != but)
            best, places = np.concatenate([best, cosines[fits]]), np.concatenate([places, own[fits]])
            first = np.lexsort((places, -best))[:k]
            best, places = best[first], places[first]
        return places, best

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        return float((cosines * self.toxic[places]).sum() / cosines.sum()) if len(places) else 0.0

    def score(self, counts: dict[int, int], k: int) -> tuple[float, np.ndarray, np.ndarray]:
        if not counts or not len(self.blocks):
            return self.none, np.zeros(0, np.int64), np.zeros(0)
        places, cosines = self.nearest(*self.vector(counts), k)
        if not len(places):
            return self.none, places, cosines
        return float(self.levels[min(BINS - 1, int(self.vote(places, cosines) * BINS))]), places, cosines

    def scores(self, own: list[bytes], features: Features, k: int) -> list[tuple[float, list[int], list[float]]]:
        """Score, doc_ids and cosines of each text; those without a neighbour by terms are held against all words."""
        out, bare = [], []
        for text in own:
            score, places, cosines = self.score(features(text), k)
            if not len(places) and self.whole is not None:
                bare.append(len(out))
            out.append((score, self.ids[places].tolist(), cosines.tolist()))
        whole = self.whole
        for row, (places, cosines) in zip(bare, whole.nearest([whole.vector(_whole.bag(own[x], _LETTERS)) for x in bare], k) if bare else [], strict=True):
            if len(places):
                out[row] = float(whole.levels[min(BINS - 1, int(whole.vote(places, cosines) * BINS))]), whole.ids[places].tolist(), cosines.tolist()
        return out


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, terms: int = TERMS, nearest: int = NEAREST) -> Model:
    """A model from the labelled rows; ``labels`` has doc_id and toxic."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(examples)
    rows = stored(docs.join(F.broadcast(chosen), "doc_id"), "examples")  # at most ``examples`` ids are sent
    n, ones = rows.dropDuplicates(["text", "toxic"]).agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    a, df = F.col("a").cast("double"), F.col("df").cast("double")
    seen = rows.dropDuplicates(["text", "toxic"]).mapInArrow(_all_terms, "term binary, toxic bigint, context bigint").distinct()
    half = F.col("context") % 2
    seen = seen.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum(F.col("toxic") * half).alias("b"), F.count("*").alias("df"))
    seen = seen.where((F.col("b") >= LEAST) & (F.col("a") - F.col("b") >= LEAST))
    chi2 = n * (a * n - df * ones) ** 2 / (df * (n - df) * F.lit(float(ones)) * F.lit(float(n - ones)))
    kept = seen.where((df < n) & (chi2 >= CHI2)).orderBy(chi2.desc(), "term").limit(terms) if 0 < ones < n else seen.limit(0)
    vocabulary = sorted(bytes(r.term) for r in kept.select("term").collect())
    counts = {r.term: r.df for r in docs.mapInArrow(_frequencies(vocabulary), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()} if vocabulary else {}
    idf = np.array([np.log(1 + (counts.get(-1) or 0) / (1 + (counts.get(t) or 0))) for t in range(len(vocabulary))])
    told = rows.mapInArrow(_counted(vocabulary), "doc_id bigint, toxic int, terms array<bigint>, counts array<bigint>").collect()
    model = index(vocabulary, idf, told, nearest)
    del told
    model.whole = _whole.build(docs, rows, _LETTERS)
    if model.whole is not None:
        _, toxic, votes = _whole.votes(model.whole, rows, _without(vocabulary), _LETTERS, nearest)
        model.whole.levels = levels(votes, toxic)
    return model


def levels(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The score of each bin of votes: the share of toxic examples there, made monotone."""
    bins = np.minimum(BINS - 1, (votes * BINS).astype(int))
    ones, all_ = np.bincount(bins, toxic, BINS), np.bincount(bins, minlength=BINS)
    middle = (np.arange(BINS) + 0.5) / BINS
    return np.maximum.accumulate((ones + middle) / (all_ + 1))


def index(vocabulary: list[bytes], idf: np.ndarray, told: list, nearest: int) -> Model:
    """The block-max index of the examples, with the scores of votes."""
    told = sorted(told, key=lambda r: (r.doc_id, r.toxic, r.terms))
    prior = (sum(r.toxic for r in told) + 0.1) / (len(told) + 1)
    without = [r.toxic for r in told if not r.terms]
    none = (sum(without) + prior) / (len(without) + 1)
    model = Model(vocabulary, idf, np.zeros((0, len(vocabulary), BLOCK)), np.zeros((len(vocabulary), 0)), np.zeros(0), np.zeros(0, np.int64), np.full(BINS, prior), none)
    vectors = [(r, model.vector(dict(zip(r.terms, r.counts, strict=True)))) for r in told if r.terms]
    if not vectors:
        return model
    vectors.sort(key=lambda x: (int(x[1][0][np.argmax(x[1][1])]), x[0].toxic, x[0].doc_id))
    model.blocks = np.zeros((-(-len(vectors) // BLOCK), len(vocabulary), BLOCK))
    for k, (_, (t, v)) in enumerate(vectors):
        model.blocks[k // BLOCK, t, k % BLOCK] = v
    model.maxima = np.ascontiguousarray(model.blocks.max(axis=2).T)
    model.toxic = np.array([float(r.toxic) for r, _ in vectors])
    model.ids = np.array([r.doc_id for r, _ in vectors])
    votes = np.array([model.vote(*model.nearest(t, v, nearest, but=k)) for k, (_, (t, v)) in enumerate(vectors)])
    model.levels = levels(votes, model.toxic)
    return model


def _scorer(model, nearest: int):
    def run(batches):
        m = model.value
        features = Features(m.terms)
        for batch in batches:
            told = m.scores(list(texts(batch)), features, nearest)
            scores, near, cosines = ([x[c] for x in told] for c in range(3))
            yield pa.record_batch([batch.column(batch.schema.get_field_index("rest")), pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))], names=["rest", "score", "evidence", "cosines"])

    return run


def score(docs: DataFrame, model: Model, nearest: int = NEAREST, prefix: str = "toxic_") -> DataFrame:
    """``docs`` with toxic_score, toxic_evidence (doc_ids of the nearest examples) and toxic_cosines."""
    small_batches(docs.sparkSession)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([held.schema["rest"], T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType())), T.StructField("cosines", T.ArrayType(T.DoubleType()))])
    out = held.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model), nearest), schema)
    added = [f"{prefix}{c}" for c in ("score", "evidence", "cosines")]
    return out.select(*[F.col(f"rest.`{c}`") for c in docs.columns if c not in added], *[F.col(c).alias(a) for c, a in zip(("score", "evidence", "cosines"), added, strict=True)])
