"""WARC archives written, read back, and indexed by an external merge.

``write_archives`` writes one record a row: the row of least id among equal payloads of at least ``LEAST``
bytes is a ``response`` with its payload, the others are ``revisit`` records that name it; smaller
payloads are all responses. The writer is Spark's own, so archives go to any store that Spark writes to.
An archive is one gzip stream, which makes it a unit that one task reads from start to end; offsets
in the index are those of the unpacked stream.

``read_archives`` cuts the stream at the version line and joins what a payload that holds this line was
cut into, by Content-Length. Digests of responses are computed anew from the payload that was read.

``merged_index`` is the external merge:

- each task sorts at most ``RUN`` captures at a time, by URL key, time and row, and writes them as a run
  of blocks of ``BLOCK`` captures;
- at most ``SPLITTER_SAMPLE`` first keys of blocks give the limits of key ranges. The key goes on with
  time and place in the archive, so captures of one hot URL spread over ranges, too;
- blocks are cut at the limits and dealt by range; in a range Spark sorts the blocks, not the captures,
  by their first keys, and a loser tree merges the runs that are open. At any time only the blocks
  that begin before the next unseen one, and those of a window of ``WINDOW`` captures, are held.

Cases: a null html is an empty payload; a null URL has an empty key; a null id comes last of its equals, so
it is the response only of rows that all lack one, and then no revisit can name a page: such rows are all
responses. Rows that repeat the least id of their payload are all responses. A null time is 1970. An empty
table gives no archive and an empty index. Columns other than the named ones are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._shared import shared_folder, small_batches, stored

LEAST = 100  # bytes of the smallest payload that may be revisited
HOT_SHARE = 200  # a payload with more than one in so many rows is hot, so there are fewer than so many
RECORDS = 20_000  # of an archive at most
RUN = 50_000
BLOCK = 128
WINDOW = 100_000
SPLITTER_SAMPLE = 10_000
SPLITTER_BYTES = 256

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
CAPTURE = "url_key binary, captured bigint, page_id bigint, archive string, offset bigint, length bigint, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, intact boolean"


# ---- writing ----------------------------------------------------------------------------------


def url_key(url: Column) -> Column:
    """Host names in reverse, then port, path and query: the sort key of capture indexes. Scheme, user, ``www.`` and fragment are left out."""
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#[\\s\\S]*$", "")
    site = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*", 0), "^[^@]*@", "")
    host = F.regexp_replace(F.lower(F.regexp_replace(site, ":[0-9]*$", "")), "^www[0-9]*\\.", "")
    port = F.regexp_replace(F.regexp_extract(site, ":[0-9]*$", 0), "^:(80|443)?$", "")
    path = F.regexp_replace(F.regexp_replace(rest, "^[^/?]*", ""), "^(?=\\?|$)", "/")
    return F.when(rest == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), port, F.lit(")"), path))


def _one_line(value: Column) -> Column:
    """Control characters and spaces of a header value in percent form, so that no header can be forged."""
    for code in (0x00, 0x09, 0x0A, 0x0D, 0x20):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def with_responses(rows: DataFrame) -> DataFrame:
    """Adds ``refers_to``: the id of the response that a row revisits, or null.

    Digests that repeat are joined back. Those of more than one in HOT_SHARE rows, of which there are fewer than
    HOT_SHARE, are sent to all tasks; their rows and those that need no partner are dealt by their own rows.
    """
    large = rows.where(F.col("payload_bytes") >= LEAST)
    groups = stored(large.groupBy("payload_digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1 AND least IS NOT NULL"), "equal-payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(groups.where(F.col("n") > total / HOT_SHARE).select(F.col("payload_digest").alias("hot_digest"), F.col("least").alias("hot_least")))
    rest = groups.where(F.col("n") <= total / HOT_SHARE).select(F.col("payload_digest").alias("dealt_by"), "least")
    rows = rows.join(hot, (F.col("payload_digest") == F.col("hot_digest")) & (F.col("payload_bytes") >= LEAST), "left")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url", "payload_digest").cast("string"))
    rows = rows.withColumn("dealt_by", F.when((F.col("payload_bytes") < LEAST) | F.col("hot_least").isNotNull(), own).otherwise(F.col("payload_digest")))
    rows = rows.join(rest, "dealt_by", "left").withColumn("least", F.coalesce("hot_least", "least"))
    return rows.withColumn("refers_to", F.when(F.coalesce(F.col("page_id") > F.col("least"), F.col("page_id").isNull()), F.col("least"))).drop("dealt_by", "hot_digest", "hot_least", "least")


def record(payload: Column, size: Column, digest: Column, page_id: Column, url: Column, captured: Column, refers_to: Column) -> Column:
    """The text of a record without the blank lines behind it."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit(END))
    date = F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.concat(F.lit("<urn:sha256:"), F.sha2(F.concat_ws(" ", page_id.cast("string"), url, digest).cast("binary"), 256), F.lit(">"))
    revisit = refers_to.isNotNull()
    profile = F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    headers = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), _one_line(url)),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.concat(F.lit("Page-Id: "), page_id.cast("string")),
        F.when(revisit, profile),
        F.concat(F.lit("Refers-To-Page-Id: "), refers_to.cast("string")),
        F.concat(F.lit("Url-Key: "), _one_line(url_key(url))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(size)).cast("string")),
    ]
    return F.concat(F.lit(VERSION), F.concat_ws("\r\n", *headers), F.lit(END), http, F.when(revisit, F.lit("")).otherwise(payload))


def write_archives(pages: DataFrame, captured: Column, path: str | None = None) -> str:
    """Archives of all rows of ``pages`` (page_id, url, html) in a folder, whose path is returned; ``captured`` is a timestamp."""
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(captured, F.timestamp_seconds(F.lit(0))).alias("captured"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))
    rows = with_responses(rows)
    text = record(*(F.col(c) for c in ("payload", "payload_bytes", "payload_digest", "page_id", "url", "captured", "refers_to")))
    out = rows.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    out.option("maxRecordsPerFile", RECORDS).text(path)
    return path


# ---- reading ----------------------------------------------------------------------------------


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, dict[bytes, bytes], bytes]]:
    """Archive, offset, headers and block of each record, from what stands between the version lines of archives."""
    version, archive, at, held, need = VERSION.encode(), None, 0, [], 0
    for batch in batches:
        for value, name in zip(batch.column(0), batch.column(1), strict=True):
            value, name = value.as_py() or b"", name.as_py()
            if name != archive:
                if held:
                    raise ValueError(f"{archive} ends within a record")
                archive, at = name, 0
                if value:
                    raise ValueError(f"{archive} doesn't begin with a version line")
                continue
            held.append(value)
            if not need:
                head = value.find(b"\r\n\r\n")
                headers = dict(line.split(b": ", 1) for line in value[:head].split(b"\r\n"))
                need = head + 8 + int(headers[b"Content-Length"])
            size = sum(map(len, held)) + len(version) * (len(held) - 1)
            if size < need:
                continue  # the payload holds a version line
            whole = held[0] if len(held) == 1 else version.join(held)
            if size > need or not whole.endswith(b"\r\n\r\n"):
                raise ValueError(f"{archive}: a record at {at} doesn't fit its Content-Length")
            yield archive, at, headers, whole[head + 4 : -4]
            at, held, need = at + len(version) + size, [], 0
    if held:
        raise ValueError(f"{archive} ends within a record")


def _whole_number(text: bytes | None) -> int | None:
    return None if text is None else int(text)


def _seconds(date: bytes) -> int:
    from datetime import datetime

    return int(datetime.fromisoformat(date.decode().replace("Z", "+00:00")).timestamp())


def _capture(archive: str, at: int, headers: dict[bytes, bytes], block: bytes) -> tuple:
    """A row of CAPTURE. The payload is what follows the HTTP headers; a revisit tells its size and digest only."""
    kind, digest = headers[b"WARC-Type"].decode(), headers[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    http = block.find(b"\r\n\r\n")
    told = int(next(line for line in block[:http].split(b"\r\n") if line.startswith(b"Content-Length: "))[16:])
    if kind == "response":
        payload = memoryview(block)[http + 4 :]
        found, size = hashlib.sha256(payload).hexdigest(), len(payload)
    else:
        found, size = digest, told
    return (headers[b"Url-Key"], _seconds(headers[b"WARC-Date"]), _whole_number(headers.get(b"Page-Id")), archive, at, len(block), kind, found, size,
            _whole_number(headers.get(b"Refers-To-Page-Id")), found == digest and size == told)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """What stands between version lines (value) of each archive, in order within the partition that reads the archive."""
    small_batches(spark, 200)
    return spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_name").alias("archive"))


# ---- the index --------------------------------------------------------------------------------

NAMES = [field.split()[0] for field in CAPTURE.split(", ")]
TYPES = pa.struct(list(zip(NAMES, [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()], strict=True)))


def sort_key(capture: tuple) -> tuple:
    """URL key, time, id with null last, archive and offset: no two captures agree in all."""
    key, captured, page_id, archive, at = capture[:5]
    return key, captured, page_id is None, page_id or 0, archive, at


def _blocks(captures: list[tuple], limits: list[tuple]) -> Iterator[tuple[int, list[tuple]]]:
    """(range, captures) of sorted captures, cut at the limits and after BLOCK captures."""
    at = 0
    while at < len(captures):
        place = bisect.bisect_right(limits, sort_key(captures[at]))
        end = min(len(captures), at + BLOCK)
        if place < len(limits):
            end = bisect.bisect_left(captures, limits[place], at, end, key=sort_key)
        yield place, captures[at:end]
        at = end


def _block_batch(run: str, blocks: list[tuple[int, list[tuple]]]) -> pa.RecordBatch:
    entries = pa.array([[dict(zip(NAMES, c, strict=True)) for c in block] for _, block in blocks], pa.list_(TYPES))
    return pa.record_batch([pa.array([place for place, _ in blocks], pa.int32()), pa.array([run] * len(blocks), pa.string()), entries], names=["range", "run", "entries"])


def _runs(batches):
    """Sorted runs of what a task reads, as blocks."""
    held, n = [], 0

    def run():
        held.sort(key=sort_key)
        blocks = list(_blocks(held, []))
        name = f"{held[0][3]}-{n}"
        for k in range(0, len(blocks), 64):
            yield _block_batch(name, blocks[k : k + 64])
        held.clear()

    for found in _records(batches):
        held.append(_capture(*found))
        if len(held) == RUN:
            yield from run()
            n += 1
    if held:
        yield from run()


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, str, list[tuple]]]:
    lists = batch.column(2)
    columns = [x.to_pylist() for x in lists.values.flatten()]
    ends, rows = lists.offsets.to_pylist(), None
    rows = list(zip(*columns, strict=True))
    for k, (place, run) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
        yield place, run, rows[ends[k] : ends[k + 1]]


def _cut(limits: list[tuple]):
    def read(batches):
        for batch in batches:
            for _, run, captures in _entries(batch):
                yield _block_batch(run, list(_blocks(captures, limits)))

    return read


class LoserTree:
    """Merges sorted lists: each inner node keeps the list that lost there, and the winner stands on top."""

    def __init__(self, lists: list[list[tuple]]):
        self.lists, self.at = lists, [0] * len(lists)
        self.keys = [sort_key(x[0]) if x else None for x in lists]
        self.losers = [-1] * max(1, len(lists))
        for k in range(len(lists)):
            self._play(k)

    def _beats(self, a: int, b: int) -> bool:
        """A list that is used up loses to all others."""
        return self.keys[a] is not None and (self.keys[b] is None or self.keys[a] < self.keys[b])

    def _play(self, winner: int) -> None:
        """From a leaf to the top; a node that no list has reached yet keeps the first one until its rival comes."""
        node = (winner + len(self.lists)) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def before(self, limit: tuple | None) -> Iterator[tuple]:
        """The captures below ``limit``, in order; all of them for None."""
        while (top := self.losers[0]) >= 0 and self.keys[top] is not None and (limit is None or self.keys[top] < limit):
            yield self.lists[top][self.at[top]]
            self.at[top] += 1
            own = self.lists[top]
            self.keys[top] = sort_key(own[self.at[top]]) if self.at[top] < len(own) else None
            self._play(top)

    def rest(self) -> list[list[tuple]]:
        return [x[k:] for x, k in zip(self.lists, self.at, strict=True) if k < len(x)]


def merged(pieces: Iterator[tuple[int, list[tuple]]], window: int = WINDOW) -> Iterator[tuple[int, tuple]]:
    """(range, capture) in order, from (range, sorted captures) in the order of range and first capture."""
    place, held, size = None, [], 0
    for here, captures in pieces:
        if here != place or size >= window:
            tree = LoserTree(held)
            limit = sort_key(captures[0]) if here == place else None
            n = 0
            for x in tree.before(limit):
                n += 1
                yield place, x
            place, held = here, tree.rest()
            size -= n
        held.append(captures)
        size += len(captures)
    for x in LoserTree(held).before(None):
        yield place, x


def _merge(batches):
    out = []

    def batch():
        got = pa.array([dict(zip(NAMES, c, strict=True)) for _, c in out], TYPES)
        return pa.record_batch([pa.array([p for p, _ in out], pa.int32()), *got.flatten()], names=["range", *NAMES])

    for x in merged((place, captures) for b in batches for place, _, captures in _entries(b)):
        out.append(x)
        if len(out) == 5000:
            yield batch()
            out = []
    if out:
        yield batch()


def _limits(runs: DataFrame, ranges: int) -> list[tuple]:
    """The least keys of all ranges but the first, from a bounded sample of first keys, each of bounded length."""
    first = F.col("entries")[0]
    keys = runs.select(F.substring(first["url_key"], 1, SPLITTER_BYTES), first["captured"], first["page_id"], first["archive"], first["offset"])
    sample = sorted(sort_key((bytes(r[0]), *r[1:])) for r in keys.orderBy(F.xxhash64(first["archive"], first["offset"])).limit(SPLITTER_SAMPLE).collect())
    return sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []


def merged_index(spark: SparkSession, path: str, ranges: int | None = None) -> DataFrame:
    """All captures of the archives in a folder: ``range`` and the columns of CAPTURE. Ranges follow one another, and captures are in order within each."""
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = f"range int, run string, entries array<struct<{CAPTURE.replace(' ', ': ').replace(',:', ',')}>>"
    runs = stored(read_archives(spark, path).mapInArrow(_runs, schema), "runs")
    limits = _limits(runs, ranges)
    first = F.col("entries")[0]
    order = ["range", first["url_key"], first["captured"], first["page_id"].asc_nulls_last(), first["archive"], first["offset"]]
    dealt = runs.mapInArrow(_cut(limits), schema).repartitionByRange(len(limits) + 1, "range").sortWithinPartitions(*order)
    return dealt.mapInArrow(_merge, f"range int, {CAPTURE}")
