"""Helpers of the operators here: shared storage, token hashes in numpy, connected components."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# ---- storage --------------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a folder of our own only where it is unset and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="casemill-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, so that lost executors cost no recomputation.

    Its shuffles are removed once it is written, as nothing reads them again. ``by``: a column whose values get a folder each.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*frames: DataFrame) -> None:
    """Remove the files of tables that ``stored`` returned, once nothing that is still to run reads them."""
    for df in frames:
        if path := _paths.pop(df, None):
            context = df.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def met(table: DataFrame, by: str, value: int, names: list[str], condition: str) -> DataFrame:
    """The pairs of rows in one folder of a table stored ``by`` a column, as x_ and y_ columns, where ``condition`` holds.

    The rows are read from the files as often as they are needed: no copies are shuffled, however many pairs there are.
    """
    kind = StructType([f for f in table.schema if f.name != by])
    rows = table.sparkSession.read.schema(kind).parquet(f"{_paths[table]}/{by}={value}")
    x, y = (rows.select(*(F.col(c).alias(f"{side}_{c}") for c in names)) for side in "xy")
    return x.join(y.hint("shuffle_replicate_nl"), F.expr(condition))


#: Each pair of two numbered pieces once, on both sides of the diagonal, so that tasks get as many.
EITHER = "(x_chunk = y_chunk OR (x_chunk < y_chunk) = (pmod(x_chunk + y_chunk, 2) = 0))"


@contextmanager
def large_rows(spark: SparkSession):
    """For what runs in the block, few rows at a time are read and sent to Python, as each has megabytes."""
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"), setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "2"):
        yield


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of so many rows, since texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


# ---- hashes ---------------------------------------------------------------------------------

U = np.uint64
CHUNK = 1 << 16
LONG = 256
BASE = 0x9E3779B97F4A7C15 | 1
WINDOW_BASE = 0xD1342543DE82EF95 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(BASE))
_powers: dict[tuple[int, int], np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64; tables grow in steps of CHUNK."""
    size = -(-(n + 1) // CHUNK) * CHUNK
    if (base, size) not in _powers:
        p = np.full(size, U(base & 0xFFFFFFFFFFFFFFFF))
        p[0] = 1
        _powers[base, size] = np.cumprod(p, dtype=U)
    return _powers[base, size][: n + 1]


def _inverse(base: int, n: int) -> np.ndarray:
    return _power(pow(base, -1, 1 << 64), n)


def _spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Of each span of values, the sum of value * base ** offset, scattered."""
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * _power(base, len(values) - 1), out=total[1:])
    return mix((total[ends] - total[starts]) * _inverse(base, len(values))[starts])


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True


def _cuts(data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about CHUNK bytes that end behind a break."""
    at = 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data):
            found = np.flatnonzero(breaks[data[end : end + CHUNK]])
            if len(found):
                end += int(found[0]) + 1
                break
            end = min(len(data), end + CHUNK)
        yield at, end
        at = end


def token_hashes(data: bytes, lines: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word (bytes other than 0x20 and 0x09 to 0x0D), or of each line that isn't empty.

    Sums modulo 2 ** 64 agree for some long texts by their structure (Thue-Morse words from 1,024 letters), so tokens of
    more than LONG bytes are hashed one by one in another way.
    """
    breaks = _NEWLINE if lines else _SPACE
    raw, out = np.frombuffer(data, dtype=np.uint8), []
    for a, b in _cuts(raw, breaks):
        piece = raw[a:b]
        inside = np.zeros(len(piece) + 2, dtype=np.int8)
        inside[1:-1] = ~breaks[piece]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        h = _spans_hash(_BYTE[piece], starts, ends, BASE)
        for k in np.flatnonzero(ends - starts > LONG):
            h[k] = xxhash.xxh3_64_intdigest(data[a + starts[k] : a + ends[k]], LONG)
        out.append((h, starts + a, ends + a))
    if not out:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def window_hashes(tokens: np.ndarray, length: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``length`` tokens from each start (default: every start with so many tokens behind it)."""
    if starts is None:
        starts = np.arange(max(0, len(tokens) - length + 1))
    if not len(starts):
        return np.zeros(0, dtype=U)
    out, low = np.empty(len(starts), dtype=U), int(starts.min())
    for at in range(low, int(starts.max()) + 1, CHUNK):  # the power tables stay small for very long texts
        here = (starts >= at) & (starts < at + CHUNK)
        part, own = tokens[at : at + CHUNK + length], starts[here] - at
        out[here] = _spans_hash(part, own, own + length, WINDOW_BASE + 2 * length)
    return out


def sliding(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """f (minimum or maximum) over each run of ``width`` values, by runs of doubled length."""
    if len(x) < width:
        return x[:0]
    have = 1
    while have < width:
        step = min(have, width - have)
        x = f(x[:-step], x[step:])
        have += step
    return x


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    for x in column.cast(pa.large_binary()) if len(column) else []:
        yield x.as_py() or b""


def lists(batch: pa.RecordBatch, name: str, kind: type = U) -> Iterator[np.ndarray]:
    """The values of a column of lists of long, or of the width of ``kind``, as arrays; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    values, ends = column.values.to_numpy(zero_copy_only=False).view(kind), column.offsets.to_numpy()
    for k in range(len(column)):
        yield values[ends[k] : ends[k + 1]]


# ---- components -----------------------------------------------------------------------------


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that links lead to, for every node with a link.

    Large and small stars by turns (Kiveris et al. 2014): a logarithmic number of rounds, each one
    aggregation and one join on the links, which are stored in the shared folder after each round.
    """
    u, v = F.col("u"), F.col("v")
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v).distinct(), "links")
    last = None
    while True:
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(v.alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        before, edges = edges, stored(small.where(u != v).distinct(), "links")
        discard(before)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if state == last:
            break
        last = state
    stars = edges.select(u.alias("node"), v.alias("component"))
    return stars.union(edges.select(v.alias("node"), v.alias("component")).distinct())
