"""The operators here against brute force on small fixtures, with nulls, empty texts, repeats and empty tables."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.llm import chat, embedding_dedup, hamming_search, licenses, line_dedup, mixing, ngram_join, queries, sentencepiece, substring_dedup, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def docs(spark):
    """Sixty given documents, copies of two, and odd rows."""
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    passage = " ".join(f"w{k}" for k in range(60))
    lines = "\n".join(f"line {k} of a run" for k in range(6))
    odd = [(900, None, None, None, None), (901, "", "en", "src0", 0), (902, "one", "en", "src1", 3), (903, "one", "en", None, 3), (904, " \t\n ", "en", "", 4),
           (905, "x " + passage + " y", "en", "src0", 9), (906, "z " + passage, "en", "src0", 9), (907, "a b " * 60, "en", "src0", 9),
           (908, lines + "\nown", "en", "src0", 9), (909, "before\n" + lines, "en", "src1", 9), (None, "no id here", "en", "src0", 9),
           (910, "long " * 30000, "en", "src9", 9), (911, given[0][1], "en", "src0", 9), (912, given[0][1] + " more", "en", "src0", 9)]
    return spark.createDataFrame(given + odd, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup(spark, docs):
    rows = docs.collect()
    seen = Counter(tuple(w[i : i + 35]) for r in rows for w in [words(r.text)] for i in range(len(w) - 34))
    want = []
    for r in rows:
        w = words(r.text)
        gone = {j for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        want.append((str(r.doc_id), len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(docs).collect()]
    assert sorted(got) == sorted(want)
    assert sorted(got) == sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(docs, start=18).collect())
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_line_dedup(spark, docs):
    seen, want = set(), []
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    for r in order:
        lines = (r.text or "").split("\n")
        at, gone = [k for k, x in enumerate(lines) if x], set()
        for j in range(len(at) - 2):
            key = tuple(lines[k] for k in at[j : j + 3])
            gone |= set(at[j : j + 3]) if key in seen else set()
            seen.add(key)
        want.append((str(r.doc_id), r.text and "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone), r.source))
    got = [(str(r.doc_id), r.text, r.n_removed_lines, r.source) for r in line_dedup.remove_lines(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.remove_lines(empty(spark)).count() == 0
    clash = docs.withColumns({"key": F.lit("k"), "once": F.lit(1), "first": F.lit(2), "h": F.lit(3)})
    assert line_dedup.remove_lines(clash).select("key", "once", "first", "h").distinct().collect() == [("k", 1, 2, 3)]


def components(links, nodes):
    low = {n: n for n in nodes}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


@pytest.mark.parametrize(("shingle", "threshold"), [(3, 90), (5, 80)])
def test_ngram_join(spark, docs, shingle, threshold):
    base = [f"t{k}" for k in range(200)]
    near = [(2000 + k, " ".join([*base[:k], "new", *base[k + 1 :]]), "en", "s", 1) for k in range(0, 200, 9)]  # a family of near copies
    rows = docs.union(spark.createDataFrame([(1999, " ".join(base), "en", "s", 1), *near], SCHEMA)).where("doc_id IS NOT NULL")
    sets = {}
    for r in rows.collect():
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets[r.doc_id] = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])]
    low = components(links, sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar(rows, shingle, threshold).collect()}
    assert got == {k: (len(sets[k]), low[k]) for k in sets}


def test_ngram_join_of_nothing(spark):
    assert ngram_join.similar(empty(spark)).count() == 0


def test_signatures_meet():
    """Any two sets at the threshold share a signature."""
    rng = np.random.default_rng(1)
    for size in (5, 9, 10, 19, 40, 150, 700):
        for threshold in (80, 90):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            cut = int(len(a) * (100 - threshold) / 100)
            assert cut == 0 or len(np.intersect1d(ngram_join.signatures(a, threshold) >> np.uint64(8), ngram_join.signatures(a[cut:], threshold) >> np.uint64(8)))


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (r.size * k for k in range(4))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight, share, total = {s: k % 3 + 1 for k, s in enumerate(names)}, {}, sum(sizes.values())
    while True:
        left = total - sum(share.values())
        free = [s for s in names if s not in share]
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 3 * sizes[s]]
        if not over:
            share |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        share |= {s: 3.0 * sizes[s] for s in over}
    longest = Counter()
    for r in got:
        longest[r.source] = max(longest[r.source], r.size)
    for s in names:
        assert target[s] == pytest.approx(share[s]) and abs(taken[s] - target[s]) <= longest[s] / 2 + 1
    assert mixing.repeated(docs).groupBy().agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(empty(spark)).count() == 0


def test_chat(spark):
    odd = "a\\1 <s></s>[INST] <<SYS>>\\ \\0 <|x|> [/INST <<</SYS>>"
    rows = [(1, 0, "system", "be"), (1, 1, "user", odd), (1, 2, "assistant", odd), (2, 1, "assistant", "first"), (3, 0, "tool|x", None), (3, None, None, "n"), (None, 0, "user", "u"), (4, 0, "user", "x"), (4, 0, "user", "x")]
    told = chat.format_chat(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).select("*", chat.read(F.col("formatted")).alias("turns"))
    got = {r.conv_id: r for r in told.collect()}
    for conv in (1, 2, 3, None, 4):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
    assert {k: r.state for k, r in got.items()} == {1: "assistant", 2: "invalid", 3: "invalid", None: "user", 4: "invalid"}
    assert [s.text for s in got[2].segments if s.loss] == ["first"]
    one = chat.digests(chat.format_chat(spark.createDataFrame(rows[:3], "conv_id bigint, turn bigint, role string, text string"))).first()
    assert one.loss_sha256 == hashlib.sha256(odd.encode()).hexdigest() and one.loss_chars == len(odd)


def test_licenses(spark, docs):
    more = [(3000, "CC BY cc by-nc; All  Rights Reserved. (General Public License)", None, None, 1), (3001, licenses.TEMPLATES["mit"].replace("associated", "related"), None, None, 1)]
    rows = docs.union(spark.createDataFrame(more, SCHEMA))
    got = {str(r.doc_id): r for r in licenses.scan_licenses(rows).collect()}
    for r in rows.collect():
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r.text or "").encode()))
        hits = [(i, p) for p in licenses.PHRASES for q in [p.encode().split()] for i in range(len(w)) if w[i : i + len(q)] == q]
        g = got[str(r.doc_id)]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None))
        assert g.base_labels == ",".join(sorted({licenses.PHRASES[p] for _, p in hits}))
    assert "mit" in got["3001"].labels.split(",") and got["900"].labels == "" and got["900"].score == 0


def test_sentencepiece(spark, docs):
    import sentencepiece as other

    model = other.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    odd = ["  a  b ", "日本語 テスト 😀 <s> </s> <0x0A>", "\n\n x\t\ty", "a▁ b", "   ", "tab\tand\r\nbreak"]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(4000 + k, t) for k, t in enumerate(odd)], "doc_id bigint, text string"))
    for r in sentencepiece.decode(sentencepiece.encode(rows)).collect():
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == model.encode(r.text) and r.parity and r.decoded == model.decode(r.ids)


def test_unigram_model_is_parsed():
    def piece(text, score, kind):
        import struct

        own = bytes([10, len(text.encode())]) + text.encode() + b"\x15" + struct.pack("<f", score) + bytes([24, kind])
        return bytes([10, len(own)]) + own

    model = b"".join([piece("<unk>", 0, 2), piece("▁a", -1, 1), piece("b", -2, 1), piece("▁", -3, 1), piece("a", -4, 1)]) + bytes([18, 2, 24, 1]) + bytes([26, 4, 24, 1, 32, 0])
    parsed = sentencepiece.parse(model)
    assert parsed["kind"] == sentencepiece.UNIGRAM and parsed["pieces"][1] == ("▁a", -1.0, 1)
    assert sentencepiece.build(parsed).encode("ab a", add_special_tokens=False).ids == [1, 2, 1]


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base, base[:20] + rng.normal(scale=0.15, size=(20, 16)), base[:5], base[:5]])
    rows = [(k, v.tolist(), k % 40 % 2) for k, v in enumerate(x)] + [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, x[0].tolist(), None), (504, [None] * 16, 1)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), per_cell=10).collect()}
    y = np.array([np.array(r[1], dtype=np.float32).astype(float) for r in rows[:70]])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    links = [(a, b) for a, b in itertools.combinations(range(70), 2) if rows[a][2] == rows[b][2] and y[a] @ y[b] >= 0.93]
    found = sum(got[k].n_links for k in range(70)) / (2 * len(links))
    assert 0.9 <= found <= 1 and all(got[k].n_links == 0 and got[k].kept for k in range(500, 505))
    whole = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), per_cell=10, margin=2.0).collect()}
    low = components(links, range(70))
    assert {k: whole[k].component_id for k in range(70)} == low and sum(whole[k].n_links for k in range(70)) == 2 * len(links)


def test_hamming(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(160, 64)).astype(np.float32)
    x[100:140] = x[0]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, None), (None, x[0].tolist()), (1050, [1.0])]
    got = {(r.vec_id, r.rank): (r.neighbour, r.distance) for r in hamming_search.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()}
    bits = x > 0
    want = {}
    for q in range(0, 160, 50):
        near = sorted((int((bits[q] != bits[k]).sum()), k) for k in range(160) if k != q)[:10]
        want |= {(q, n): (k, d) for n, (d, k) in enumerate(near, 1)}
    assert got == want


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    plain = ["".join(chr(97 + k // 26 ** i % 26) for i in range(2)) + "ord" for k in range(300)]  # digits are no part of words
    rows, labels = [], []
    for k in range(400):
        text = list(rng.choice(plain, 40))
        if k % 5 == 0:
            for _ in range(3):
                text.insert(int(rng.integers(0, 40)), str(rng.choice(["vile", "nasty", "horrid"])))
        rows.append((k, " ".join(text), "en", "s", 1))
        labels.append((k, int(k % 5 == 0)))
    rows += [(1000, None, None, None, None), (1001, "", None, None, None)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels + [(2, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, marks.where(~toxicity.held_out(F.col("doc_id"))))
    got = {r.doc_id: r.toxic_score for r in toxicity.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 402
    assert sum((got[k] >= 0.3) == (k % 5 == 0) for k in range(400)) >= 395 and got[1000] == got[1001] < 0.3
    q = {k: 1 for k in range(min(3, len(model.terms)))}
    t, v = model.vector(q)
    cosine = model.weights[:, t] @ v
    best = np.lexsort((np.arange(len(cosine)), -cosine))[:15]
    assert np.allclose(model.nearest(t, v, 15)[1], cosine[best])  # block-max pruning is exact
    none = toxicity.fit(docs, marks.limit(0))
    assert toxicity.score(empty(spark), none).count() == 0 and 0 <= toxicity.score(docs, none).agg(F.max("toxic_score")).first()[0] <= 1


def test_line_query_has_the_same_rows_as_its_statement(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name, sql in queries.SQL.items():
        df = queries.QUERIES[name](spark, SF)
        told = con.execute(sql)
        columns = [c[0] for c in told.description]
        assert sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(str, told.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (_, stage), limit in zip(corpus_pipeline.STAGES, (None,) * 5, strict=True):
        docs = stage(spark, docs, SF)
    assert docs.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "parity", "round_trip"]
    assert docs.count() > 100 and docs.where("NOT parity").count() == 0
