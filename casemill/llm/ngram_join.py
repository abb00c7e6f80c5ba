"""Similarity join of documents on word shingles by PartEnum signatures.

Words are runs of bytes other than space (0x20, 0x09 to 0x0D), with A to Z in lower case. Two
documents link when the Jaccard similarity of their sets of ``shingle``-word shingles is at least
``threshold`` (a whole percentage, compared exactly in integers).

- Documents with equal sets form a class; only one of each class goes on.
- Sizes fall into bands. Sets linked within a band of largest size u differ in at most
  k = floor(2 u (100 - t) / (100 + t)) shingles. The shingle domain is split into k + m parts by hash;
  two linked sets agree in at least m parts (PartEnum with subsets of one part), so a signature is
  the band, the part, and the sum of the scattered hashes in it. A set signs in its own band and, if a
  linked larger set can lie in the next one, there as well.
- Empty parts would gather unrelated sets, and so would parts with nothing but a common passage. Call
  a part of a set bad if it is empty, or if more than LIGHT sets share its signature. A set with fewer
  than m bad parts in a band leaves their groups, since it agrees with any linked set in a good part,
  too; m is 2 + k / SPARE, so few sets but members of large families of near copies stay in them.
- Pairs within groups of at most LIGHT are candidates if they share as many signatures there as their
  parts that aren't bad leave necessary. Sets that meet in heavy groups form families, which are compared
  by products of their incidence matrices and return what each set is connected to, never the pairs. A
  family is cut, in the order of the sets' sizes, into blocks of FAMILY_BLOCK sets, and blocks are compared
  pair by pair, but for those whose sizes are too far apart for a link. One of at most WHOLE_SETS sets and
  WHOLE_SHINGLES shingles goes to one task; blocks of larger ones are stored, and pairs of them are read from
  the files by many tasks: so a set is shuffled once, however large its family is.
- Sets that candidates connect are families, too, so that a set is sent once and not once a pair. Where
  such a family has more than FAMILY_BLOCK sets, its candidates are compared pair by pair instead, by
  intersecting the sorted 64-bit shingle hashes.

Result: a row per input row with doc_id, n_shingles, class_id (the smallest doc_id with an equal set)
and component_id. A null or empty
text has no shingles and links with nothing; one with fewer words than ``shingle`` has all its words
as its only shingle. Rows without doc_id link with nothing and have no component. A doc_id given twice
is one node with the links of all its rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ._pieces import Piece, pieces
from ._shared import EITHER, U, components, discard, large_rows, met, mix, setting, small_batches, stored, window_hashes
from .embedding_dedup import connected

SHINGLE = 5
THRESHOLD = 80
BAND = 1.5
LIGHT = 8
SPARE = 4
LEFT_BITS = 12
BAND_BITS = 6
MOST_LEFT = (1 << LEFT_BITS) - 1  # a smaller m than 2 + k / SPARE is less than the empty parts of a long set: it would stay in all their groups
FAMILY_BLOCK = 400
FAMILY_SHINGLES = 400_000  # of a block at most
WHOLE_SETS = 20_000
WHOLE_SHINGLES = 2_000_000
FAMILIES = 24  # cut ones that a job compares
COLUMNS = 4096
SMALL_LIST = 1_000_000  # rows of doc_ids, with their family, that may be sent to all executors, 20 MB


def sets(piece: Piece, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    h, out = window_hashes(piece.hashes, shingle), []
    for k in range(len(piece.texts)):
        a, b = piece.first[k], piece.first[k + 1]
        if b - a >= shingle:
            out.append(np.unique(h[a : b - shingle + 1]))
        else:  # the length keeps short texts apart from shingles
            out.append(mix(window_hashes(piece.hashes, int(b - a), np.array([a])) + U(b - a)) if b > a else np.zeros(0, U))
    return out


def bands(size: int, threshold: int) -> list[tuple[int, int]]:
    """(band, k) in which a set of this size signs."""
    own = int(np.log(size) / np.log(BAND) + 1e-9)
    last = int(np.log(size * 100 // threshold) / np.log(BAND) + 1e-9)
    tops = [(band, max(size, int(BAND ** (band + 1) + 1e-6))) for band in range(own, max(own, last) + 1)]
    return [(band, 2 * top * (100 - threshold) // (100 + threshold)) for band, top in tops]


def signatures(own: np.ndarray, threshold: int) -> np.ndarray:
    """The PartEnum signatures of a set; the last bits of each are the band, and how many of the m are not empty parts."""
    out, scattered = [], mix(own)
    for band, k in bands(len(own), threshold) if len(own) else []:
        if k == 0:
            continue  # only equal sets link
        m = min(MOST_LEFT, 2 + k // SPARE)
        part = ((own >> U(11)) % U(k + m)).astype(np.int64)
        sums = np.zeros(k + m, dtype=U)
        np.add.at(sums, part, scattered)
        full = np.bincount(part, minlength=k + m) > 0
        left = max(0, m - int((~full).sum()))
        hashed = mix(sums ^ mix(np.arange(k + m, dtype=U) + U(1_000_003 * (band + 1))))
        low = LEFT_BITS + BAND_BITS
        out.append(((hashed >> U(low) << U(low)) | U(band % (1 << BAND_BITS) << LEFT_BITS | left))[full if left else slice(None)])
    return np.concatenate([np.zeros(0, U), *out])


def _digest(own: np.ndarray) -> tuple[int, int]:
    scattered = mix(own)
    return int(scattered.sum(dtype=U).view(np.int64)), int(np.bitwise_xor.reduce(mix(scattered ^ U(0x5851F42D4C957F2D)), initial=0).view(np.int64))


def _signed(shingle: int, threshold: int):
    """Of each row doc_id, n_shingles, two digests of its set, and its signatures."""

    def read(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for piece in pieces(batch, [], lower=True):
                own = sets(piece, shingle)
                digests = [_digest(x) for x in own]
                signs = [signatures(x, threshold) for x in own]
                ends = np.cumsum([0, *map(len, signs)]).astype(np.int32)
                yield pa.record_batch(
                    [ids.slice(piece.first_row, len(own)), pa.array([len(x) for x in own], pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(signs).view(np.int64)))],
                    names=["doc_id", "n_shingles", "d1", "d2", "signs"])

    return read


def _sets(shingle: int):
    def read(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for piece in pieces(batch, [], lower=True):
                own = sets(piece, shingle)
                yield pa.record_batch([ids.slice(piece.first_row, len(own)), pa.array([len(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], names=["doc_id", "n", "own"])

    return read


def _linked(threshold: int):
    """The pairs whose sets are similar enough."""

    def read(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), dtype=U), np.frombuffer(y.as_py(), dtype=U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= threshold * (len(p) + len(q) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return read


def _compared(pairs: DataFrame, own: DataFrame, threshold: int) -> DataFrame:
    left, right = own.select(F.col("doc_id").alias("a"), F.col("own").alias("x")), own.select(F.col("doc_id").alias("b"), F.col("own").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_linked(threshold), "a bigint, b bigint")


def similar(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) per row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = ["doc_id", "n_shingles", "d1", "d2"]
    signed = stored(docs.mapInArrow(_signed(shingle, threshold), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, signs array<bigint>"), "shingles")
    rows = stored(signed.select(*digests), "digests")
    told = rows.where("doc_id IS NOT NULL")
    classes = told.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("class_id"))
    first = classes.select(F.col("class_id").alias("doc_id"), "n_shingles", "d1", "d2")
    again = stored(told.where("n_shingles > 0").join(first, digests, "left_anti").distinct(), "again")
    # signatures are many times the size of digests: where the later sets of classes are few, these are sent in place of shuffling signatures
    firsts = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    firsts = firsts.join(F.broadcast(again), digests, "left_anti") if again.count() <= SMALL_LIST else firsts.join(first, digests, "left_semi")
    signs = firsts.select("doc_id", F.explode("signs").alias("s")).withColumn("sign", F.col("s").bitwiseAND(F.lit(~MOST_LEFT)))
    together = signs.withColumn("n", F.count("*").over(W.partitionBy("sign"))).where("n > 1")
    together = together.select("sign", "doc_id", F.col("s").bitwiseAND(F.lit(MOST_LEFT)).alias("left"), "n", F.col("sign").bitwiseAND(F.lit((1 << BAND_BITS) - 1 << LEFT_BITS)).alias("band"))
    together = stored(together, "together")
    discard(signed, again)
    heavy = together.where(F.col("n") > LIGHT)
    bad = heavy.groupBy("doc_id", "band").agg(F.count("*").alias("heavy"))
    light = together.where(F.col("n") <= LIGHT).join(bad, ["doc_id", "band"], "left")
    light = light.select("sign", "band", "doc_id", (F.col("left") - F.coalesce("heavy", F.lit(0))).alias("need"))
    pairs = light.alias("x").join(light.alias("y"), F.expr("x.sign = y.sign AND x.doc_id < y.doc_id")).select("x.band", F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.greatest("x.need", "y.need").alias("need"))
    pairs = pairs.groupBy("a", "b", "band").agg(F.count("*").alias("n"), F.max("need").alias("need")).where("n >= need").select("a", "b").distinct()
    pairs = stored(pairs, "pairs")
    many = bad.join(heavy.groupBy("doc_id", "band").agg(F.max("left").alias("left")), ["doc_id", "band"]).where("heavy >= left")
    members = stored(heavy.join(many.select("doc_id", "band"), ["doc_id", "band"], "left_semi").select("sign", "doc_id"), "members")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(members.select("doc_id"))
    wanted = stored(ids.distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= SMALL_LIST else wanted
    own = stored(docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(shingle), "doc_id bigint, n bigint, own binary").distinct(), "sets")
    links = _family_links(_families(members.join(members.groupBy("sign").agg(F.min("doc_id").alias("hub")), "sign"), "hub", "doc_id"), own, threshold)
    near = stored(_families(pairs, "a", "b"), "families")
    links = links.union(_family_links(near.where("blocks = 1"), own, threshold))
    large = pairs.join(near.where("blocks > 1").select(F.col("node").alias("a")), "a", "left_semi")
    links = stored(links.union(_compared(large, own, threshold)), "similar")
    discard(together, pairs, members, own, near)
    # a doc_id with several rows ties the classes of all of them
    tied = told.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"])
    nodes = links.union(tied.where("class_id <> doc_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")))
    parts = components(nodes, "a", "b")
    out = rows.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"], "left")
    out = out.join(parts, out["doc_id"] == parts["node"], "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", "n_shingles", F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"), F.coalesce("component", "doc_id").alias("component_id"))


def _connected(near: np.ndarray, x: np.ndarray, y: np.ndarray | None = None) -> pa.RecordBatch:
    """The links of a matrix between x and y, or within x, as (doc_id, least doc_id connected to it here)."""
    i, j = np.nonzero(near)
    ids = x if y is None else np.concatenate([x, y])
    low = connected(i, j if y is None else j + len(x), ids)
    return pa.record_batch([pa.array(low[low != ids], pa.int64()), pa.array(ids[low != ids], pa.int64())], names=["a", "b"])


def _incidence(rows: int, owner: np.ndarray, column: np.ndarray, low: int) -> np.ndarray:
    """Columns ``low`` to low + COLUMNS of the incidence matrix, of which the entries are in the order of columns."""
    a, b = np.searchsorted(column, [low, low + COLUMNS])
    part = np.zeros((rows, COLUMNS), dtype=np.float32)
    part[owner[a:b], column[a:b] - low] = 1
    return part


def _near(threshold: int, both: np.ndarray, x_sizes: np.ndarray, y_sizes: np.ndarray) -> np.ndarray:
    both = both.astype(np.int64)
    return 100 * both >= threshold * (x_sizes[:, None] + y_sizes[None, :] - both)


def _block(own: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sets as their sizes, the sorted distinct shingles, how many sets hold each, and which sets these are, shingle by shingle."""
    sizes, together = np.array([len(x) for x in own]), np.concatenate(own)
    order = np.argsort(together, kind="stable")
    found, counts = np.unique(together[order], return_counts=True)
    return sizes, found, counts.astype(np.int32), np.repeat(np.arange(len(own), dtype=np.int32), sizes)[order]


def _entries(block: tuple, shared: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the entries in shared columns, where place has the new columns of these."""
    _, _, counts, owner = block
    return owner[np.repeat(shared, counts)], np.repeat(place, counts[shared])


def _inside(threshold: int, x: tuple) -> np.ndarray:
    """Which of the sets of a block are similar enough."""
    shared = x[2] > 1  # the others are in no intersection
    n, (owner, column) = int(shared.sum()), _entries(x, shared, np.arange(int(shared.sum())))
    both = np.zeros((len(x[0]), len(x[0])), dtype=np.float32)
    for low in range(0, n, COLUMNS):
        part = _incidence(len(x[0]), owner, column, low)
        both += part @ part.T
    return _near(threshold, both, x[0], x[0])


def _between(threshold: int, x: tuple, y: tuple) -> np.ndarray:
    """Which sets of two blocks are similar enough."""
    at = np.minimum(np.searchsorted(x[1], y[1]), len(x[1]) - 1)
    in_y = x[1][at] == y[1]
    in_x = np.zeros(len(x[1]), dtype=bool)
    in_x[at[in_y]] = True
    place = np.arange(int(in_y.sum()))  # both are in the order of shingles
    x_entries, y_entries = _entries(x, in_x, place), _entries(y, in_y, place)
    both = np.zeros((len(x[0]), len(y[0])), dtype=np.float32)
    for low in range(0, len(place), COLUMNS):
        both += _incidence(len(x[0]), *x_entries, low) @ _incidence(len(y[0]), *y_entries, low).T
    return _near(threshold, both, x[0], y[0])


def _within(threshold: int, most: int):
    """The links within a family, as (doc_id, least doc_id connected to it in two of its blocks of at most so many sets)."""

    def run(table):
        ids, own = table["doc_id"].to_numpy(), [np.frombuffer(x.as_py(), dtype=U) for x in table["own"]]
        order = np.argsort([len(x) for x in own], kind="stable")
        parts = [order[k : k + most] for k in range(0, len(order), most)]
        blocks, found = [_block([own[k] for k in part]) for part in parts], []
        for k, x in enumerate(blocks):
            found.append(_connected(_inside(threshold, x), ids[parts[k]]))
            for j in range(k + 1, len(blocks)):
                if 100 * x[0].max() < threshold * blocks[j][0].min():
                    break  # those behind are larger still
                found.append(_connected(_between(threshold, x, blocks[j]), ids[parts[k]], ids[parts[j]]))
        return pa.Table.from_batches(found)

    return run


_PARTS = {"ids": np.int64, "sizes": np.int64, "found": U, "counts": np.int32, "owners": np.int32}
_BLOCK = "component bigint, chunk bigint, low bigint, high bigint, ids binary, sizes binary, found binary, counts binary, owners binary"


def _blocks(most: int, shingles: int):
    """Rows in the order of families and sizes, as blocks of at most so many sets and shingles."""

    def block(component, number, ids, own):
        parts = _block(own)
        values = [component, number << 32 | TaskContext.get().partitionId(), int(parts[0].min()), int(parts[0].max()), np.array(ids).tobytes(), *(x.tobytes() for x in parts)]
        return pa.record_batch([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in values], names=[x.split()[0] for x in _BLOCK.split(", ")])

    def read(batches):
        held, family, weight, number = [], None, 0, 0
        for batch in batches:
            for component, node, own in zip(*(batch.column(k) for k in range(3)), strict=True):
                own = np.frombuffer(own.as_py(), dtype=U)
                if held and (component.as_py() != family or len(held) == most or weight + len(own) > shingles):
                    yield block(family, number, *zip(*held, strict=True))
                    held, weight, number = [], 0, number + 1
                family, weight = component.as_py(), weight + len(own)
                held.append((node.as_py(), own))
        if held:
            yield block(family, number, *zip(*held, strict=True))

    return read


def _across(threshold: int):
    """The links between two blocks of a family, or within one."""

    def block(batch, row, side):
        return [np.frombuffer(batch.column(f"{side}_{c}")[row].as_buffer(), dtype=kind) for c, kind in _PARTS.items()]

    def read(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, *x = block(batch, row, "x")
                if batch.column("x_chunk")[row] == batch.column("y_chunk")[row]:
                    yield _connected(_inside(threshold, x), ids)
                else:
                    others, *y = block(batch, row, "y")
                    yield _connected(_between(threshold, x, y), ids, others)

    return read


def _families(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component, blocks) of all nodes that edges connect."""
    family = components(edges, a, b)
    return family.join(family.groupBy("component").agg(F.ceil(F.count("*") / FAMILY_BLOCK).cast("int").alias("blocks")), "component")


def _family_links(families: DataFrame, own: DataFrame, threshold: int) -> DataFrame:
    """Links that connect what the pairs within families connect."""
    spark = own.sparkSession
    families = stored(families.select("component", "node"), "families")
    sent = F.broadcast(families) if families.count() <= SMALL_LIST else families
    rows = own.join(sent, F.col("node") == F.col("doc_id")).select("component", "doc_id", "own", "n")
    weights = rows.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    large = stored(weights.where((F.col("sets") > WHOLE_SETS) | (F.col("shingles") > WHOLE_SHINGLES)), "large-families")
    links = rows.join(F.broadcast(large), "component", "left_anti").groupBy("component").applyInArrow(_within(threshold, FAMILY_BLOCK), "a bigint, b bigint")
    cut = large.orderBy("component").collect()
    if not cut:
        return links
    blocks = rows.join(F.broadcast(large.select("component")), "component", "left_semi")
    blocks = blocks.repartitionByRange(max(1, sum(r.shingles for r in cut) // FAMILY_SHINGLES), "component", "n", "doc_id").sortWithinPartitions("component", "n", "doc_id")
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "200"):
        blocks = stored(blocks.mapInArrow(_blocks(FAMILY_BLOCK, FAMILY_SHINGLES), _BLOCK), "blocks", by="component")
    close = f"{EITHER} AND 100 * x_high >= {threshold} * y_low AND 100 * y_high >= {threshold} * x_low"
    names = [c for c in blocks.columns if c != "component"]
    for k in range(0, len(cut), FAMILIES):
        pairs = reduce(DataFrame.union, (met(blocks, "component", r.component, names, close) for r in cut[k : k + FAMILIES]))
        with large_rows(spark):
            links = links.union(stored(pairs.mapInArrow(_across(threshold), "a bigint, b bigint"), "family-links"))
    discard(blocks)
    return links
