"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

- Vectors that are null, zero, or hold null or non-finite components, and rows without label, link
  with nothing. Equal vectors of one label are compared once and count as often as they occur.
- Spherical k-means on about ``sample`` distinct vectors at most (chosen by a hash) gives centroids, one for
  about ``per_cell`` vectors but MOST_CELLS at most, so that they can be sent to all tasks. Every vector
  has a home, the cell of its largest cosine, and also visits the cells whose cosine
  falls short of that by sqrt(2 - 2 * cosine) / 2 times the distance of both centroids at most. Between
  the homes of a link's ends the shortfalls add up to no more than twice that (Cauchy-Schwarz), so one end
  visits the other's home and no link is lost, at any number of cells. A ``margin`` sets one shortfall
  for all cells in place of this: with 2 every pair meets, smaller values trade recall for work.
- A label of at most CHUNK bytes, as doubles, is compared in one task. The vectors of larger ones are
  stored in the order of their homes, in chunks of that size, and pairs of chunks are read from the files,
  so a vector is shuffled once, however many cells it visits. Of two chunks, those vectors are compared of
  which one visits the home of the other. Cosines are products of normalised vectors in single precision;
  those so close to the threshold that rounding counts are taken again in double precision.
- A pair of chunks returns, per linked vector, its number of links and the least id it is connected to
  there, never the pairs. Components are then joined by stars over these.

Result: per row vec_id, n_links, component_id (the least vec_id reachable), kept (it is the component's
representative). Rows that share a vec_id are one vector each but one node together. Vectors of different
lengths never link. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from ._shared import EITHER, components, discard, large_rows, met, stored

COSINE = 0.93
SAMPLE = 20_000
PER_CELL = 4_000
MOST_CELLS = 1_024
BLOCK = 1_500
CHUNK = 8 << 20
LABELS = 24  # large ones that a job compares
ROUNDS = 10
SPARSE = 20_000  # links of two blocks that are listed; of more, the matrix is kept


def centroids(x: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means on rows of length 1, from rows at even distances."""
    own = x[np.linspace(0, len(x) - 1, cells).astype(int)].copy()
    for _ in range(ROUNDS):
        home = np.argmax(x @ own.T, axis=1)
        for k in range(cells):
            total = x[home == k].sum(axis=0)
            size = np.sqrt(total @ total)
            if size > 0:
                own[k] = total / size
    return own


def _keyed(single: bool):
    """(vec_id, label, key, vec): the vector as bytes, and a digest of it and its label; both null where there is no vector."""

    def run(batches):
        for batch in batches:
            ids, labels, column = batch.columns
            values, ends, fine = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
            values = values.astype(np.float32 if single else np.float64, copy=False)
            vecs = [values[ends[k] : ends[k + 1]].tobytes() if fine[k] else None for k in range(len(column))]
            heads = [(x or "").encode() for x in labels.to_pylist()]
            keys = [None if v is None else hashlib.blake2b(len(x).to_bytes(8, "big") + x + v, digest_size=16).digest() for x, v in zip(heads, vecs, strict=True)]
            yield pa.record_batch([ids, labels, pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["vec_id", "label", "key", "vec"])

    return run


def _matrix(data: bytes, rows: int, single: bool) -> np.ndarray:
    """Vectors as doubles, at length 1."""
    x = np.frombuffer(data, dtype=np.float32 if single else np.float64).astype(np.float64).reshape(rows, -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _allowed(model: np.ndarray, cosine: float, margin: float | None) -> np.ndarray:
    """Of each home and cell, how far the cosine of a visitor of the cell may fall short of that with its home."""
    if margin is not None:
        return np.full((len(model), len(model)), margin)
    apart = np.sqrt(np.maximum(0, (model * model).sum(1)[:, None] + (model * model).sum(1) - 2 * model @ model.T))
    return np.sqrt(2 - 2 * cosine) / 2 * apart + 1e-6


def connected(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each place the least id that the links (a, b) between places connect it to."""
    low = ids.copy()
    while True:
        least = np.minimum(low[a], low[b])
        before = low.copy()
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        if (low == before).all():
            return low


class _Chunk:
    """Vectors in the order of their homes; cells: each home with its first row and the row behind its last."""

    def __init__(self, x: np.ndarray, homes: np.ndarray, ids: np.ndarray, n: np.ndarray, model: np.ndarray):
        order = np.argsort(homes, kind="stable")
        self.x, self.homes, self.ids, self.n = x[order], homes[order], ids[order], n[order].astype(np.float64)
        self.short, self.at_home = self.x.astype(np.float32), (self.x * model[self.homes]).sum(axis=1)
        at = np.flatnonzero(np.diff(self.homes, prepend=-1))
        self.cells = list(zip(self.homes[at].tolist(), at.tolist(), [*at[1:].tolist(), len(self.homes)], strict=True))

    def visits(self, model: np.ndarray, allowed: np.ndarray, cells: list[int]) -> np.ndarray:
        return self.x @ model[cells].T >= self.at_home[:, None] - allowed[self.homes][:, cells]


def _rows(x: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Rows by ascending numbers, not copied where they follow each other."""
    return x[i[0] : i[-1] + 1] if i[-1] - i[0] == len(i) - 1 else x[i]


def _links(x: _Chunk, i: np.ndarray, y: _Chunk, j: np.ndarray, cosine: float, later: bool) -> np.ndarray | None:
    """Which of the rows i of x and j of y are linked, None if none are; later: only those with a row of y behind that of x."""
    found, slack = _rows(x.short, i) @ _rows(y.short, j).T, 2.0**-22 * (x.x.shape[1] + 8)
    if found.max() < cosine - slack:
        return None
    near = found >= cosine - slack
    a, b = np.nonzero(near & (found < cosine + slack))
    for k in range(0, len(a), BLOCK):  # rounding may decide on these
        p, q = a[k : k + BLOCK], b[k : k + BLOCK]
        near[p, q] = (x.x[i[p]] * y.x[j[q]]).sum(axis=1) >= cosine
    return near & (i[:, None] < j[None, :]) if later else near


def _tied(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows and columns that a matrix connects; the places of columns are behind those of rows."""
    rows, columns = near.shape
    low = np.arange(rows + columns)
    while True:
        before = low.copy()
        low[:rows] = np.minimum(low[:rows], np.where(near, low[None, rows:], rows + columns).min(axis=1))
        low[rows:] = np.minimum(low[rows:], np.where(near, low[:rows, None], rows + columns).min(axis=0))
        if (low == before).all():
            break
    return np.arange(rows + columns), low


def _compared(x: _Chunk, y: _Chunk | None, model: np.ndarray, allowed: np.ndarray, cosine: float) -> pa.RecordBatch:
    """(node, links, root) of the linked vectors of two chunks, or of one."""
    other = x if y is None else y
    ids = x.ids if y is None else np.concatenate([x.ids, y.ids])
    behind = 0 if y is None else len(x.ids)
    counts, links = np.zeros(len(ids)), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

    def meet(i: np.ndarray, j: np.ndarray, later: bool = False) -> None:
        for p in range(0, len(i), BLOCK):
            for q in range(0, len(j), BLOCK):
                a, b = i[p : p + BLOCK], j[q : q + BLOCK]
                if later and b[-1] <= a[0]:
                    continue
                near = _links(x, a, other, b, cosine, later)
                if near is None or not (hits := int(np.count_nonzero(near))):
                    continue
                if hits <= SPARSE:
                    s, t = np.nonzero(near)
                    s, t = a[s], b[t]
                    np.add.at(counts, s, other.n[t])
                    np.add.at(counts, t + behind, x.n[s])
                else:
                    counts[a] += near @ other.n[b]
                    counts[b + behind] += x.n[a] @ near
                    place = np.concatenate([a, b + behind])
                    s, t = (place[k] for k in _tied(near))
                    links.append((s, t))
                    continue
                links.append((s, t + behind))

    to_y = x.visits(model, allowed, [c[0] for c in other.cells])
    to_x = to_y if y is None else y.visits(model, allowed, [c[0] for c in x.cells])
    for k, (home, a, b) in enumerate(x.cells):
        own = np.arange(a, b)
        for m, (cell, p, q) in enumerate(other.cells):
            if y is None and m < k:
                continue
            there = np.arange(p, q)
            if home == cell:
                meet(own, there, later=y is None)
                continue
            guest = to_y[a:b, m]
            meet(own[guest], there)
            meet(own[~guest], there[to_x[p:q, k]])
    low = connected(*(np.concatenate([pair[k] for pair in links]) for k in (0, 1)), ids)
    linked = np.flatnonzero(counts)
    return pa.record_batch([pa.array(ids[linked], pa.int64()), pa.array(np.rint(counts[linked]).astype(np.int64), pa.int64()), pa.array(low[linked], pa.int64())], names=["node", "links", "root"])


def _whole(model, single: bool, cosine: float, margin: float | None):
    """The linked vectors of a label."""

    def run(table):
        x = _matrix(b"".join(table["vec"].to_pylist()), len(table), single)
        chunk = _Chunk(x, np.argmax(x @ model.value.T, axis=1), table["node"].to_numpy(), table["n"].to_numpy(), model.value)
        return pa.Table.from_batches([_compared(chunk, None, model.value, _allowed(model.value, cosine, margin), cosine)])

    return run


def _homes(model, single: bool):
    """Rows of (part, node, n, vec), and their homes."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                home = np.argmax(_matrix(b"".join(batch.column(3).to_pylist()), batch.num_rows, single) @ model.value.T, axis=1)
                yield pa.record_batch([*batch.columns, pa.array(home, pa.int64())], names=["part", "node", "n", "vec", "home"])

    return run


_PARTS = {"homes": np.int64, "ids": np.int64, "counts": np.int64}
_CHUNK = "part bigint, chunk bigint, homes binary, ids binary, counts binary, vecs binary"


def _chunks(most: int):
    """Rows in the order of parts and homes, as chunks of at most so many."""

    def run(batches):
        held, size, part, number = [], 0, None, 0

        def chunk():
            values = [part, number << 32 | TaskContext.get().partitionId(), *(b"".join(x) for x in zip(*held, strict=True))]
            return pa.record_batch([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in values], names=[x.split()[0] for x in _CHUNK.split(", ")])

        for batch in batches:
            parts = batch.column(0).to_numpy()
            for a, b in zip(at := [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist()], [*at[1:], len(parts)], strict=True):
                while a < b:
                    if held and (parts[a] != part or size == most):
                        yield chunk()
                        held, size, number = [], 0, number + 1
                    part, end = int(parts[a]), min(b, a + most - size)
                    rows = batch.slice(a, end - a)
                    held.append((*(rows.column(k).to_numpy().astype(np.int64).tobytes() for k in (4, 1, 2)), b"".join(rows.column(3).to_pylist())))
                    size, a = size + end - a, end
        if held:
            yield chunk()

    return run


def _across(model, single: bool, cosine: float, margin: float | None):
    """The linked vectors of pairs of chunks."""

    def run(batches):
        centres, known = model.value, {}
        allowed = _allowed(centres, cosine, margin)

        def chunk(batch, row, side):
            homes, ids, n = (np.frombuffer(batch.column(f"{side}_{c}")[row].as_buffer(), dtype=kind) for c, kind in _PARTS.items())
            return _Chunk(_matrix(batch.column(f"{side}_vecs")[row].as_buffer(), len(ids), single), homes, ids, n, centres)

        for batch in batches:
            for row in range(batch.num_rows):
                number, other = batch.column("x_chunk")[row].as_py(), batch.column("y_chunk")[row].as_py()
                if known.get("number") != number:  # it comes with one y after the other
                    known = {"number": number, "chunk": chunk(batch, row, "x")}
                yield _compared(known["chunk"], None if number == other else chunk(batch, row, "y"), centres, allowed, cosine)

    return run


_LINKS = "node bigint, links bigint, root bigint"


def _found(own: DataFrame, dim: int, single: bool, model, cosine: float, margin: float | None) -> DataFrame:
    """(node, links, root) of what is linked among vectors of one length, label by label."""
    spark, most = own.sparkSession, max(1, CHUNK // (8 * dim))
    large = [(r.label, k, r.n) for k, r in enumerate(own.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > most).orderBy("label").collect())]
    if not large:
        return own.groupBy("label").applyInArrow(_whole(model, single, cosine, margin), _LINKS)
    numbers = F.broadcast(spark.createDataFrame([x[:2] for x in large], "label string, part bigint"))
    found = [own.join(numbers, "label", "left_anti").groupBy("label").applyInArrow(_whole(model, single, cosine, margin), _LINKS)]
    rows = own.join(numbers, "label").select("part", "node", "n", "vec").mapInArrow(_homes(model, single), "part bigint, node bigint, n bigint, vec binary, home bigint")
    rows = rows.repartitionByRange(max(1, -(-sum(x[2] for x in large) // most)), "part", "home", "node").sortWithinPartitions("part", "home", "node")
    chunks = stored(rows.mapInArrow(_chunks(most), _CHUNK), "chunks", by="part")
    names = [c for c in chunks.columns if c != "part"]
    for k in range(0, len(large), LABELS):
        pairs = reduce(DataFrame.union, (met(chunks, "part", part, names, EITHER) for _, part, _ in large[k : k + LABELS]))
        with large_rows(spark):
            found.append(stored(pairs.mapInArrow(_across(model, single, cosine, margin), _LINKS), "chunk-links"))
    discard(chunks)
    return reduce(DataFrame.union, found)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, per_cell: int = PER_CELL, margin: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    single = isinstance(getattr(vectors.schema["embedding"].dataType, "elementType", None), FloatType)
    x = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    fine = F.col("label").isNotNull() & (F.size("embedding") > 0) & F.coalesce(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & F.exists("embedding", lambda v: v != 0)
    kept = F.when(fine & F.col("vec_id").isNotNull(), F.col("embedding").cast("array<float>") if single else F.col("embedding"))
    rows = x.select("vec_id", "label", kept.alias("embedding")).mapInArrow(_keyed(single), "vec_id bigint, label string, key binary, vec binary")
    told = stored(rows.select("vec_id", "key"), "keys")
    firsts = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    firsts = stored(firsts, "classes").withColumn("dim", (F.octet_length("vec") / (4 if single else 8)).cast("int"))
    out = told.join(firsts.select("key", "node", "n"), "key", "left").select("vec_id", "node", "n")
    links = []
    for dim, count in sorted((r.dim, r.n) for r in firsts.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        own = firsts.where(F.col("dim") == dim)
        chosen = own if count <= sample else own.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) <= (1 << 30) * sample // count)
        picked = chosen.select("vec", "node").orderBy(F.xxhash64("node"), "node").limit(sample).toArrow()
        if not len(picked):
            picked = own.select("vec", "node").limit(1).toArrow()
        cells = max(1, min(MOST_CELLS, -(-count // per_cell), len(picked)))
        model = spark.sparkContext.broadcast(centroids(_matrix(b"".join(picked["vec"].to_pylist()), len(picked), single), cells))
        links.append(_found(own, dim, single, model, cosine, margin))
    if not links:
        return x.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = stored(reduce(DataFrame.union, links), "vector-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    tied = out.where("node <> vec_id").select(F.col("node").alias("a"), F.col("vec_id").alias("b"))
    parts = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(tied), "a", "b").withColumnRenamed("node", "of")
    out = out.join(counts, "node", "left").join(parts, F.col("vec_id") == F.col("of"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", (F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"), component.alias("component_id"), F.equal_null("vec_id", component).alias("kept"))
