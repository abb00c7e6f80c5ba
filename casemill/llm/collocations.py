"""Phrase collocations from weighted acyclic automata.

Texts, with A to Z in lower case, are split at ``.,;:!?`` and line ends into pieces, and pieces at spaces and tabs
into words. Everything is counted per lang. The count of a phrase is at most that of its parts, so phrases are
counted in three passes, each over whole texts: words; pairs of words that are frequent; triples and
quadruples whose pairs are frequent. What is frequent is sent around as a bitmap of ``BITS`` bits, whatever the
size of the corpus: a wrong hit there costs a count that is dropped later, and nothing frequent is missed.

- A task sorts the n-grams of each chunk, builds a count transducer from them (`_transducer`), and adds it to that of
  its shard by union; what grows beyond ``STATES`` states is handed on.
- Shard transducers are cut by ranges of a hash of the prefix of two words, so one frequent first word spreads over
  all ranges. Each range sums its shards by union, as a stream, and keeps what reaches the least count. The
  number of ranges follows the size of the texts.
- The parts of each candidate (a phrase of 2 to 4 words) are sent as request transducers to the ranges of
  their prefixes, and composed with the count transducers there; the answers are joined back to the cuts.

Scores are floor(2000000 a / (l + r)) in decimals. Sums are in 64 bits. No phrase depends on a hash.

Cases: a null text has no words, a null lang is ``und``; long texts are cut between words into chunks that overlap
by three words; repeated rows count as often as they stand; an empty table gives no rows. Columns other than lang
and text aren't read. Ties in score and count go by the bytes of the phrase.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ._shared import U, mix, small_batches, stored, texts
from ._transducer import Transducer, sorted_words

LEAST = 30
COVER = 80  # percent of a phrase's places that a longer one must hold to replace it
TOP = 2000
LONGEST = 4
BITS = 26  # the bitmap has 2 ** BITS bits, 8 MB
CHUNK = 8 << 20  # bytes of text counted at once
STATES = 1_500_000
RANGE_BYTES = 64 << 20
SALTS = 64
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(BREAKS))
_GAP = re.compile(rb"[ \t.]")
_SHARD = "lang string, range int, automaton binary"


# ---- hashes for ranges and for the bitmap: wrong hits there cost time, not results -------------


def _word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words.to_pylist()), U, len(words))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + mix(b))


def _range_of(grams: np.ndarray, h: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each sequence, by its first two words."""
    prefix = mix(h[grams[:, 0]]) if grams.shape[1] == 1 else _pair_hash(h[grams[:, 0]], h[grams[:, 1]])
    return (((prefix >> U(32)) * U(ranges)) >> U(32)).astype(np.int64)


def _bit(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - BITS)).astype(np.int64)


def _is_set(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bit(h)
    return (bitmap[at >> 6] >> (at & 63).astype(U)) & U(1) > 0


# ---- counting -----------------------------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in lower case with ``.`` for all breaks, cut between words into parts of about CHUNK bytes."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        gap = _GAP.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def _ranks(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """The places of pairs among the distinct ones, and how many there are."""
    distinct, place = np.unique(a * size + b, return_inverse=True)
    return place, len(distinct)


def _counted(words: pa.Array, columns: list[np.ndarray]) -> Transducer | None:
    if not len(columns[0]):
        return None
    key, size = columns[0], len(words)
    if len(columns) == 2:
        key = key * size + columns[1]
    elif len(columns) > 2:
        key = _ranks(columns[0], columns[1], size)[0]
        rest, n = _ranks(columns[2], columns[3], size) if len(columns) == 4 else (columns[2], size)
        key = key * n + rest
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return Transducer.built(words, np.stack([c[first] for c in columns], axis=1), counts)


def _chunk(lang: str, tokens: list[bytes], old: int, lengths: tuple[int, ...], bitmap: np.ndarray | None) -> Transducer | None:
    """The counts of a chunk's phrases that end behind its first ``old`` tokens; ``.`` stands between pieces."""
    if len(tokens) <= old:
        return None
    words, c = sorted_words(pa.array(tokens, pa.large_binary()))
    is_word = pc.not_equal(words, pa.scalar(b".", pa.large_binary())).to_numpy(zero_copy_only=False)
    if lengths == (1,):
        c = c[old:]
        return _counted(words, [c[is_word[c]]])
    h, parts = _word_hashes(lang, words), []
    if lengths == (2,):
        frequent = (is_word & _is_set(bitmap, h))[c]
        starts = {2: frequent[:-1] & frequent[1:]}
    else:
        ok = is_word[c]
        pair = ok[:-1] & ok[1:]
        pair[pair] = _is_set(bitmap, _pair_hash(h[c[:-1][pair]], h[c[1:][pair]]))
        starts = {3: pair[:-1] & pair[1:], 4: pair[:-2] & pair[1:-1] & pair[2:]}
    for m in lengths:
        at = np.flatnonzero(starts[m])
        at = at[at + m > old]
        parts.append(_counted(words, [c[at + j] for j in range(m)]))
    parts = [p for p in parts if p is not None]
    return Transducer.union(parts) if parts else None


def _by_range(lang: str, whole: Transducer, ranges: int) -> Iterator[tuple[int, Transducer]]:
    h, found = _word_hashes(lang, whole.words), {}
    for k in range(1, len(whole.labels) + 1):
        grams, weights = whole.grams(k)
        if not len(grams):
            continue
        place = _range_of(grams, h, ranges)
        order = np.argsort(place, kind="stable")
        at = np.flatnonzero(np.diff(place[order], prepend=-1))
        for a, b in zip(at, [*at[1:], len(order)], strict=True):
            found.setdefault(int(place[order[a]]), []).append(Transducer.built(whole.words, grams[order[a:b]], weights[order[a:b]]))
    for place, parts in found.items():
        yield place, Transducer.union(parts)


def _shard_rows(lang: str, whole: Transducer, ranges: int) -> Iterator[pa.RecordBatch]:
    rows = [(place, part.packed()) for place, part in _by_range(lang, whole, ranges)]
    for k in range(0, len(rows), 64):
        some = rows[k : k + 64]
        yield pa.record_batch([pa.array([lang] * len(some), pa.string()), pa.array([r for r, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary())], names=["lang", "range", "automaton"])


def _shards(lengths: tuple[int, ...], bitmap, ranges: int):
    """The transducers of what a task reads, by lang and range."""

    def read(batches):
        known = None if bitmap is None else bitmap.value
        waiting: dict[str, list[bytes]] = {}
        held: dict[str, list[Transducer]] = {}
        size = 0

        def add(lang: str, tokens: list[bytes], old: int):
            part = _chunk(lang, tokens, old, lengths, known)
            if part is not None:
                held.setdefault(lang, []).append(part)
                if sum(map(len, held[lang])) > STATES:
                    held[lang] = [Transducer.union(held[lang])]
                if sum(len(p) for own in held.values() for p in own) > STATES:
                    yield from hand_on()

        def hand_on():
            for own in held:
                yield from _shard_rows(own, Transducer.union(held[own]), ranges)
            held.clear()

        def count():
            for own, some in waiting.items():
                yield from add(own, b" . ".join(some).replace(b".", b" . ").split(), 0)
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), texts(batch), strict=True):
                if len(text) > CHUNK:
                    last = []
                    for piece in _pieces(text):
                        tokens = piece.replace(b".", b" . ").split()
                        yield from add(lang, last + tokens, len(last))
                        last = (last + tokens)[-(LONGEST - 1) :]
                    continue
                waiting.setdefault(lang, []).append(text.translate(_TABLE))
                size += len(text) + 200
                if size > CHUNK:
                    yield from count()
                    size = 0
        yield from count()
        yield from hand_on()

    return read


def _groups(batches) -> Iterator[tuple[str, int, Iterator[tuple]]]:
    """(lang, range, further columns of its rows) of rows that are sorted by lang and range."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for (lang, place), own in groupby(rows, key=lambda r: (r[0], r[1])):
        yield lang, place, (r[2:] for r in own)


def _unions(blobs: Iterator[bytes]) -> Transducer:
    held, size = [], 0
    for blob in blobs:
        held.append(Transducer.unpacked(blob))
        size += len(held[-1])
        if size > 2 * STATES and len(held) > 8:
            held = [Transducer.union(held)]
            size = 0
    return Transducer.union(held)


def _summed(least: int):
    def read(batches):
        for lang, place, rows in _groups(batches):
            whole = _unions(blob for (blob,) in rows)
            kept = whole.at_least(least)
            yield pa.record_batch([pa.array([lang], pa.string()), pa.array([place], pa.int32()), pa.array([kept.packed()], pa.binary()), pa.array([whole.total()], pa.int64()), pa.array([len(kept)], pa.int64())],
                                  names=["lang", "range", "automaton", "total", "states"])

    return read


def counts(docs: DataFrame, lengths: tuple[int, ...], bitmap, ranges: int, least: int) -> DataFrame:
    """(lang, range, automaton, total, states): the phrases of these lengths that reach the least count; total: the places of all that were counted."""
    shards = docs.mapInArrow(_shards(lengths, bitmap, ranges), _SHARD)
    dealt = shards.repartition(ranges, "lang", "range").sortWithinPartitions("lang", "range")
    return stored(dealt.mapInArrow(_summed(least), f"{_SHARD}, total bigint, states bigint"), f"grams-{lengths[-1]}")


def _bits(batches):
    for batch in batches:
        for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = Transducer.unpacked(blob)
            h, level = _word_hashes(lang, own.words), len(own.labels)
            if not level:
                continue
            grams = own.grams(level)[0]
            at = np.sort(_bit(h[grams[:, 0]] if level == 1 else _pair_hash(h[grams[:, 0]], h[grams[:, 1]])))
            slots, first = np.unique(at >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(U(1) << (at & 63).astype(U), first)
            yield pa.record_batch([pa.array(slots), pa.array(bits.view(np.int64))], names=["slot", "bits"])


def bitmap(found: DataFrame) -> np.ndarray:
    """The bits of the hashes of all words or pairs in ``found``: at most 2 ** BITS / 64 rows come to the driver."""
    rows = found.select("lang", "automaton").mapInArrow(_bits, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((1 << BITS) // 64, U)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(U)
    return out


# ---- candidates ---------------------------------------------------------------------------------


def _cuts(n: int) -> range:
    return range(1, n)


def _requests(ranges: int):
    """Request transducers of the parts of candidates, by the ranges of the parts; each part has weight 1."""

    def read(batches):
        for batch in batches:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, parts = Transducer.unpacked(blob), {}
                for n in range(2, len(own.labels) + 1):
                    grams = own.grams(n)[0]
                    for k in _cuts(n):
                        parts.setdefault(k, []).append(grams[:, :k])
                        parts.setdefault(n - k, []).append(grams[:, k:])
                wanted = [np.unique(np.concatenate(x), axis=0) for x in parts.values()]
                wanted = [Transducer.built(own.words, x, np.ones(len(x), np.int64)) for x in wanted if len(x)]
                if wanted:
                    yield from _shard_rows(lang, Transducer.union(wanted), ranges)

    return read


def _answers(batches):
    """(lang, phrase, f) of the requests of each range, composed with its counts, which come first."""
    for lang, _, rows in _groups(batches):
        blobs = {False: [], True: []}
        for blob, is_request in rows:
            blobs[is_request].append(blob)
        found = _unions(iter(blobs[True])).composed(_unions(iter(blobs[False]))) if blobs[True] else None
        yield from _phrase_rows(lang, found, 1) if found is not None else ()


def _phrase_rows(lang: str, found: Transducer, least: int) -> Iterator[pa.RecordBatch]:
    for k in range(least, len(found.labels) + 1):
        phrases, weights = found.phrases(k)
        for a in range(0, len(weights), 10_000):
            some = phrases.slice(a, 10_000).cast(pa.binary())
            yield pa.record_batch([pa.array([lang] * len(some), pa.string()), some, pa.array(np.full(len(some), k, np.int32)), pa.array(weights[a : a + 10_000])], names=["lang", "phrase", "words", "f"])


def _candidates(batches):
    for batch in batches:
        for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield from _phrase_rows(lang, Transducer.unpacked(blob), 2)


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each lang."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    words = counts(docs, (1,), None, ranges, least)
    known = spark.sparkContext.broadcast(bitmap(words))
    pairs = counts(docs, (2,), known, ranges, least)
    known.destroy()
    known = spark.sparkContext.broadcast(bitmap(pairs))
    longer = counts(docs, (3, 4), known, ranges, least)
    known.destroy()

    phrases = pairs.union(longer).where("states > 0").select("lang", "automaton")
    every = words.union(pairs).union(longer).where("states > 0").select("lang", "range", "automaton", F.lit(False).alias("is_request"))
    asked = phrases.mapInArrow(_requests(ranges), _SHARD).withColumn("is_request", F.lit(True))
    dealt = every.union(asked).repartition(ranges, "lang", "range").sortWithinPartitions("lang", "range", "is_request")
    row = "lang string, phrase binary, words int, f bigint"
    parts = stored(dealt.mapInArrow(_answers, row).select("lang", F.col("phrase").cast("string").alias("phrase"), "f"), "parts")
    found = stored(phrases.mapInArrow(_candidates, row).select("lang", F.col("phrase").cast("string").alias("phrase"), "words", F.col("f").alias("a")), "candidates")

    listed = F.split("phrase", " ")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.array_join(F.slice(listed, F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice(listed, F.col("k") + 1, F.col("words") - F.col("k")), " "))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + r)")
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = found.where("words > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice(listed, F.col("at"), F.col("m")), " ").alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * wide("longer") < F.lit(cover) * wide("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    few = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("total").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
