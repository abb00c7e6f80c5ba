"""How far the sources of a language lie apart, by exact sparse document vectors.

A null text, lang or source counts as ''. Terms are runs of letters A to Z and of code points from 128,
with A to Z in lower case. Each lang keeps the V terms that stand in at least ``MIN_DF`` of its documents.

- Texts are read and cut into terms once. A task makes the sparse vector of each document by its own numbers of terms,
  and adds up the vectors of each (lang, source), and in how many of its documents each term stands. One row for each
  term of a (lang, source) leaves it, and more only where a task would hold over ``MOST_TERMS`` sums.
- These rows are shuffled once, by lang and term, so that a term's sums per source and the number of its documents in
  the lang are made in one place. No vocabulary is gathered anywhere, and there is no limit to its size.
- Pairs of sources are compared by term blocks. A source's terms are held against all sources of a block: with
  x(A, B) the sum of f over terms of A, y(A, B) that over the terms of both and m(A, B) their number, the value
  is x(A, B) + x(B, A) - y(A, B) + f0 (V - |A| - |B| + m), where f0 is f of a term that neither has. Only
  sums per pair leave a task, never a row per pair and term.

p = 1 + floor(10^9 (count + 2) / (N + 2V)) in decimals; f = floor((p - q)^2 / (p + q)) fits 64 bits.

Cases: an empty table gives no rows; a lang with one source has no pairs; a lang without kept terms has pairs
of value 0 and no terms; repeated rows count as often as they stand. Columns other than the three aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._shared import small_batches, stored, texts

MIN_DF = 10
MOST_TERMS = 4_000_000  # sums that a task holds at once
TOP = 10
SOURCES = 256  # of a block
CELLS = 1 << 21  # sources times terms of a block, about
_BYTES = np.arange(256, dtype=np.uint8)
_CAPITAL = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = np.where(_CAPITAL, _BYTES + np.uint8(32), _BYTES)
_LETTER = _CAPITAL | (_BYTES >= 0x61) & (_BYTES <= 0x7A) | (_BYTES >= 0x80)  # in UTF-8, bytes from 128 are those of code points from 128


def _p(count: str, n: str, v: str) -> Column:
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(20, 0)) + 2)) div (CAST({n} AS DECIMAL(20, 0)) + 2 * {v})")


def _terms(of_row: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, and the text that each stands in."""
    data = np.frombuffer(b"\0".join([*of_row, b""]), np.uint8)
    inside = _LETTER[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(_LOWER[data[inside]])])
    begins = np.cumsum([0, *(len(text) + 1 for text in of_row)])
    return terms, np.searchsorted(begins, starts, side="right") - 1


def _group_sums(most: int):
    """(lang, source, term, n, df): sums of the sparse vectors of each group's documents in this task, and in how many each term stands; each group has a row without a term."""

    def run(batches):
        groups, words, held, size, places = {}, [], [], 0, 0

        def summed():
            one = pa.concat_arrays(words).dictionary_encode()
            key, n, df = (np.concatenate(c) for c in zip(*held, strict=True))
            key = key >> 32 << 32 | one.indices.to_numpy()[key & 0xFFFFFFFF]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            return [one.dictionary], [(key[first], np.add.reduceat(n[order], first), np.add.reduceat(df[order], first))]

        def told():
            key, n, df = held[0]
            every, of_place = list(groups), words[0].cast(pa.large_string())
            of_group = [pa.array([x[i] for x in every], pa.string()) for i in (0, 1)]
            for a in range(0, len(key), 50_000):
                some = key[a : a + 50_000]
                yield pa.record_batch([*(x.take(pa.array(some >> 32)) for x in of_group), of_place.take(pa.array(some & 0xFFFFFFFF)).cast(pa.string()), pa.array(n[a : a + 50_000]), pa.array(df[a : a + 50_000])], names=["lang", "source", "term", "n", "df"])

        for batch in batches:
            lang, source = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "source"))
            group = np.array([groups.setdefault(x, len(groups)) for x in zip(lang, source, strict=True)], np.int64)
            terms, row = _terms(list(texts(batch)))
            if not len(terms):
                continue
            found = terms.dictionary_encode()
            v = len(found.dictionary)
            cell, n = np.unique(row * v + found.indices.to_numpy(), return_counts=True)  # the documents' vectors
            held.append((group[cell // v] << 32 | places + cell % v, n.astype(np.int64), np.ones(len(n), np.int64)))
            words.append(found.dictionary)
            size, places = size + len(n), places + v
            if size > min(CELLS, most):
                words, held = summed()
                size, places = len(held[0][0]) // 2, len(words[0])  # the next sum is made when as much again has come
                if len(held[0][0]) > most:
                    yield from told()
                    words, held, size, places = [], [], 0, 0
        if held:
            words, held = summed()
            yield from told()
        for lang, source in groups:
            yield pa.record_batch([pa.array([lang], pa.string()), pa.array([source], pa.string()), pa.array([None], pa.string()), pa.array([0], pa.int64()), pa.array([0], pa.int64())], names=["lang", "source", "term", "n", "df"])

    return run


def kept_counts(docs: DataFrame, min_df: int = MIN_DF, most_terms: int = MOST_TERMS) -> DataFrame:
    """(lang, source, term, n) of kept terms, and a row without a term for each (lang, source)."""
    small_batches(docs.sparkSession, 500)
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    sums = docs.select(lang, source, F.col("text").cast("string").alias("text")).mapInArrow(_group_sums(most_terms), "lang string, source string, term string, n bigint, df bigint")
    sums = sums.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_lang = F.sum("df").over(Window.partitionBy("lang", "term"))
    return sums.withColumn("of_lang", of_lang).where(F.isnull("term") | (F.col("of_lang") >= min_df)).select("lang", "source", "term", "n")


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pair_sums(key, table):
    """Of each ordered pair of a source of block x and one of block y: the sums over the terms of this bucket that the first one has."""
    x_block, y_block = key[2].as_py(), key[3].as_py()
    block, name, term, p, p0 = (table.column(c).combine_chunks() for c in ("block", "source", "term", "p", "p0"))
    names = name.dictionary_encode()
    of, columns = names.indices.to_numpy(), term.dictionary_encode().indices.fill_null(-1).to_numpy()
    s, t = len(names.dictionary), int(columns.max()) + 1
    none, blocks = np.zeros(s, np.int64), np.zeros(s, np.int64)
    none[of], blocks[of] = p0.to_numpy(), block.to_numpy()
    real = columns >= 0
    of, columns = of[real], columns[real]
    value = np.repeat(none[:, None], t, axis=1)
    value[of, columns] = p.to_numpy()[real]
    has = np.zeros((s, t), bool)
    has[of, columns] = True
    others = {b: np.flatnonzero(blocks == b) for b in (x_block, y_block)}
    out = []
    for a in range(s):
        b = others[y_block if blocks[a] == x_block else x_block]
        own = np.flatnonzero(has[a])
        f, both = _f(value[a, own], value[np.ix_(b, own)]), has[np.ix_(b, own)]
        out.append((np.full(len(b), a), b, f.sum(1), (f * both).sum(1), both.sum(1)))
    a, b, x, y, m = (np.concatenate(c) for c in zip(*out, strict=True))
    other = a != b
    take = lambda i: names.dictionary.take(pa.array(i[other]))
    return pa.table({"lang": pa.array([key[0].as_py()] * int(other.sum()), pa.string()), "source": take(a), "item": take(b), "x": x[other], "y": y[other], "m": m[other].astype(np.int64)})


def pair_values(p: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a lang; p: (lang, source, term, p, p0), groups: (lang, source, terms, v, p0, block, blocks)."""
    cells = p.join(groups.select("lang", "source", "block", "blocks", "buckets"), ["lang", "source"])
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")))
    every = groups.where("v > 0").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "p0", "block", "blocks", "buckets", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("buckets") - 1)).alias("bucket"))
    cells = cells.unionByName(every)  # each source has a row in each bucket, whether it has terms there or not
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("lang", "bucket", F.least("block", "other").alias("bx"), F.greatest("block", "other").alias("by"), "block", "source", "term", "p", "p0")
    sums = cells.groupBy("lang", "bucket", "bx", "by").applyInArrow(_pair_sums, "lang string, source string, item string, x bigint, y bigint, m bigint")
    sums = stored(sums.groupBy("lang", "source", "item").agg(*(F.sum(c).alias(c) for c in "xym")), "pair-sums")  # read twice
    one, two = (groups.select("lang", F.col("source").alias(name), F.col("terms").alias(f"terms_{name}"), F.col("p0").alias(f"p0_{name}"), "v") for name in ("source", "item"))
    pairs = one.join(two.drop("v"), "lang").where("source <> item")
    both = sums.select("lang", F.col("source").alias("item"), F.col("item").alias("source"), F.col("x").alias("x_back"))
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").join(both, ["lang", "source", "item"], "left").fillna(0, ["x", "y", "m", "x_back"])
    nothing = F.expr("(p0_source - p0_item) * (p0_source - p0_item) div (p0_source + p0_item)")
    value = F.col("x") + F.col("x_back") - F.col("y") + nothing * (F.col("v") - F.col("terms_source") - F.col("terms_item") + F.col("m"))
    return pairs.select("lang", "source", "item", F.when(F.col("v") > 0, value).otherwise(F.lit(0)).cast("bigint").alias("value"))


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, most_terms: int = MOST_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    rows = stored(kept_counts(docs, min_df, most_terms), "source-terms")
    counts = rows.where("term IS NOT NULL")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.count("*").alias("sources"))
    sizes = of_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    groups = rows.where("term IS NULL").select("lang", "source").join(counts.groupBy("lang", "source").agg(F.count("*").alias("terms"), F.sum("n").alias("group_n")), ["lang", "source"], "left")
    groups = groups.join(sizes, "lang", "left").fillna(0, ["terms", "group_n", "v", "lang_n"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("block", F.floor(place / SOURCES).cast("int"))
    all_of = Window.partitionBy("lang")
    groups = groups.withColumn("blocks", F.max("block").over(all_of) + 1).withColumn("in_lang", F.count("*").over(all_of))
    groups = groups.withColumn("buckets", F.ceil(F.least("in_lang", F.lit(2 * SOURCES)) * F.col("v") / CELLS) + 1)
    groups = stored(groups.withColumn("p0", F.when(F.col("v") > 0, _p("CAST(0 AS BIGINT)", "group_n", "greatest(v, 1)")).otherwise(F.lit(1))), "source-groups")
    p = counts.join(groups.select("lang", "source", "group_n", "lang_n", "v", "p0"), ["lang", "source"]).withColumn("p", _p("n", "group_n", "v"))
    q = of_lang.join(sizes, "lang").select("lang", "term", _p("n", "lang_n", "v").alias("q"))
    terms = p.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    pairs = ranked(pair_values(p.select("lang", "source", "term", "p", "p0"), groups))
    terms = ranked(terms).where(F.col("rank") <= top)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")
