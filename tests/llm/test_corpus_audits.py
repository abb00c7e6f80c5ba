"""Collocations, source divergence and WARC archives against DuckDB and brute force, with odd rows."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casemill.llm import _transducer, collocations, divergence, queries, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def duck(name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        rows = frame.toArrow()  # noqa: F841
        con.execute(f"CREATE TABLE {table} AS SELECT * FROM rows")
    return Counter(con.execute(queries.SQL[name]).fetchall())


def got(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(7)
    vocabulary = ["and", "a", "zoo", "Ärger", "x-1", "new", "york", "city", "the", "über"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=60)) + ". New York\tcity\nnew york city, the NEW york", rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "é"]), 1) for k in range(80)]
    rows += [(900, None, None, None, None), (901, "", "en", "none", 0), (902, "... \n\t ", "en", "", 4), (903, "new york " * 20_000, "en", "long", 9), (904, "one lang only", "xx", "s", 1), (904, "one lang only", "xx", "s", 1),
             (None, "new york city", "en", "a", 1), (905, "é" * 40, "yy", "p", 1), (906, None, "yy", "q", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(frame):
    return frame.withColumns({c: F.lit(7) for c in ("phrase", "f", "lang_n", "range", "terms", "word", "vector", "rank", "n", "words", "value", "item")})


def test_transducers():
    rng, grams = random.Random(3), []
    for _ in range(6):
        grams.append(Counter(tuple(rng.choices([b"a", b"aa", b"b", b"\xc3\xa4", b"c" * 300], k=rng.randint(1, 4))) for _ in range(200)))

    def built(counts):
        parts = []
        for m in range(1, 5):
            own = {g: n for g, n in counts.items() if len(g) == m}
            words, place = _transducer.sorted_words(pa.array([w for g in own for w in g], pa.large_binary()))
            rows = place.reshape(-1, m)
            order = np.lexsort(rows.T[::-1])
            parts.append(_transducer.Transducer.built(words, rows[order], np.array(list(own.values()))[order]))
        return _transducer.Transducer.union(parts)

    def told(t):
        out = {}
        for m in range(1, len(t.labels) + 1):
            phrases, weights = t.phrases(m)
            out |= {tuple(p.split(b" ")): int(w) for p, w in zip(phrases.to_pylist(), weights, strict=True)}
            assert phrases.to_pylist() == [b" ".join(g) for g in sorted(tuple(p.split(b" ")) for p in phrases.to_pylist())]
        return out

    total = sum(grams, Counter())
    shards = [_transducer.Transducer.unpacked(built(g).packed()) for g in grams]
    whole = _transducer.Transducer.union(shards)
    assert told(whole) == total and whole.total() == sum(total.values())
    assert told(whole.at_least(4)) == {g: n for g, n in total.items() if n >= 4}
    asked = {g: 1 for g in list(total)[:100]} | {(b"not", b"there"): 1, (b"a", b"zz"): 1}
    assert {g: n for g, n in told(built(asked).composed(whole)).items() if n} == {g: total[g] for g in asked if g in total}
    assert told(_transducer.Transducer.union([])) == {}


def test_collocations(spark, odd):
    assert got(collocations.collocations(clashing(odd))) == duck("op11_collocations", documents=odd)
    assert collocations.collocations(odd.limit(0)).count() == 0
    assert got(queries.QUERIES["op11_collocations"](spark, SF)) == duck("op11_collocations", documents=spark.read.parquet(f"{SF}/documents.parquet"))


@pytest.mark.parametrize(("chunk", "states"), [(50, 10), (1000, 10_000)])
def test_collocation_chunks(monkeypatch, chunk, states):
    """Chunks and shards of any size give the same counts."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "STATES", states)
    rng = random.Random(1)
    docs = [("en", " ".join(rng.choices(["a", "b.", "c", "d!", "long" * 20], k=rng.randint(0, 300)))) for _ in range(20)]
    want = defaultdict(int)
    for _, text in docs:
        for piece in text.replace("!", ".").split("."):
            w = piece.split()
            for i in range(len(w) - 1):
                want[tuple(w[i : i + 2])] += 1
    batch = pa.record_batch([pa.array([t.encode() for _, t in docs]), pa.array([x for x, _ in docs])], names=["text", "lang"])
    everything = type("Known", (), {"value": np.full((1 << collocations.BITS) // 64, np.uint64(2**64 - 1))})
    rows = [r for b in collocations._shards((2,), everything, 5)(iter([batch])) for r in b.to_pylist()]
    whole = _transducer.Transducer.union([_transducer.Transducer.unpacked(r["automaton"]) for r in rows])
    phrases, weights = whole.phrases(2)
    assert {tuple(p.decode().split(" ")): int(n) for p, n in zip(phrases.to_pylist(), weights, strict=True)} == dict(want)


@pytest.mark.parametrize("most_terms", [divergence.MOST_TERMS, 0])
def test_divergence(spark, odd, most_terms, monkeypatch):
    want = duck("op12_source_divergence", documents=odd)
    assert got(divergence.audit(clashing(odd), most_terms=most_terms)) == want
    monkeypatch.setattr(divergence, "SOURCES", 2)  # several blocks of sources
    monkeypatch.setattr(divergence, "CELLS", 20)  # and buckets of terms
    assert got(divergence.audit(odd, most_terms=most_terms)) == want
    assert divergence.audit(odd.limit(0), most_terms=most_terms).count() == 0


def test_divergence_query(spark):
    assert got(queries.QUERIES["op12_source_divergence"](spark, SF)) == duck("op12_source_divergence", documents=spark.read.parquet(f"{SF}/documents.parquet"))


PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    copy, marker = "copy of a page " * 20, "before WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\nbehind " * 4
    rows = [(k, f"https://www.Shop.example.com:443/p{k % 3}?q={k}#top", copy) for k in range(40, 0, -1)]
    rows += [(100, "http://a.example/", marker), (101, "http://a.example/\r\nX: y", marker), (102, None, marker + "!"), (103, "http://user@a.example:8080", None), (104, "", ""), (105, "x", "é" * 60), (106, "x", "é" * 60),
             (107, "x", "short"), (108, "x", "short"), (None, "http://a.example/", copy), (None, "n", "only without an id " * 9), (None, "n", "only without an id " * 9), (1, "again", copy), (109, "y", "long " * 300_000), (110, "y", "\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame(rows, PAGES)


def test_warc(spark, pages):
    path = warc.write_archives(pages.withColumns({"payload": F.lit(1), "least": F.lit(2), "dealt_by": F.lit(3), "archive": F.lit("x")}), F.timestamp_seconds(F.col("page_id") % 7))
    index = warc.merged_index(spark, path, ranges=5).collect()
    rows = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    least = {}
    for page_id, _, html in rows:
        if page_id is not None and len(html) >= warc.LEAST:
            least[html] = min(page_id, least.get(html, page_id))
    want = Counter()
    for page_id, _, html in rows:
        first = least.get(html)
        refers = first if first is not None and (page_id is None or page_id > first) else None
        want[page_id, len(html), hashlib.sha256(html).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in index) == want
    assert all(r.intact for r in index)
    keys = [warc.sort_key(tuple(r)[1:]) for r in index]
    assert keys == sorted(keys) and len({r.range for r in index}) > 1
    assert {bytes(r.url_key) for r in index if r.page_id == 3} == {b"com,example,shop)/p0?q=3"}
    assert {bytes(r.url_key) for r in index if r.page_id == 103} == {b"example,a:8080)/"}


def test_warc_query_and_empty(spark, pages):
    given = spark.read.parquet(f"{SF}/pages.parquet")
    assert got(queries.QUERIES["op13_warc"](spark, SF)) == duck("op13_warc", pages=given)
    some = pages.where("page_id IS NOT NULL").dropDuplicates(["page_id"])
    assert got(queries.op13(some)) == duck("op13_warc", pages=some)
    assert queries.op13(pages.limit(0)).count() == 0


def test_damaged_archives(spark, pages):
    head = b"WARC-Type: response\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: 5\r\n\r\n"

    def read(*values):
        batch = pa.record_batch([pa.array(values, pa.binary()), pa.array(["f"] * len(values))], names=["value", "archive"])
        return list(warc._records(iter([batch])))

    assert [r[3] for r in read(b"", head + b"12345\r\n\r\n")] == [b"12345"]
    for broken in ([b"", head + b"1234"], [b"", head + b"123456789012345\r\n\r\n"], [b"junk", head + b"12345\r\n\r\n"]):
        with pytest.raises(ValueError, match="f"):
            read(*broken)


@pytest.mark.parametrize("window", [1, 7, 1000])
def test_loser_tree_merge(window):
    rng = random.Random(5)
    captures = [(rng.choice([b"a", b"b", b"c"]), rng.randint(0, 5), rng.choice([None, 1, 2]), f"f{rng.randint(0, 3)}", k, 0, "", "", 0, None, True) for k in range(500)]
    runs = [sorted(captures[a : a + 90], key=warc.sort_key) for a in range(0, 500, 90)]
    limits = sorted({warc.sort_key(c) for c in captures[::120]})
    blocks = sorted((b for run in runs for b in warc._blocks(run, limits)), key=lambda b: (b[0], warc.sort_key(b[1][0])))
    out = list(warc.merged(iter(blocks), window))
    assert [c for _, c in out] == sorted(captures, key=warc.sort_key) and [p for p, _ in out] == sorted(p for p, _ in out)
    assert list(warc.merged(iter([]))) == []
