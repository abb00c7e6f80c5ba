"""What large groups leave on disk: each row once, and no shuffles of tables that are written."""

import itertools

import numpy as np
import pytest

from casemill.llm import _shared, embedding_dedup, ngram_join

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def reachable(links, nodes):
    low = {n: n for n in nodes}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


def test_stored_tables_leave_no_shuffle(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").sum("id").orderBy("k")
    before, key = env.get().mapOutputTracker().shuffleStatuses().size(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key, None)
    assert _shared.stored(rows, "sums").count() == 7
    kept = env.get().mapOutputTracker().shuffleStatuses().size() - before
    assert kept <= 1 and spark.conf.get(key, None) == setting  # one of count()


def test_large_families_are_stored_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FAMILY_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "WHOLE_SETS", 20, raising=False)
    blocks, stored = [], ngram_join.stored

    def seen(df, name, **how):
        out = stored(df, name, **how)
        if name == "blocks":
            blocks.extend(out.select("component", "ids", "low", "high").collect())
        return out

    monkeypatch.setattr(ngram_join, "stored", seen)
    rng, rows = np.random.default_rng(4), []
    for family, words in enumerate((200, 120)):
        base = [f"f{family}w{k}" for k in range(words)]
        for copy in range(36):  # of many sizes, and with passages of their own
            own = base[: words - int(rng.integers(0, words // 2))]
            for k in rng.integers(0, len(own), int(rng.integers(0, 9))):
                own[k] = f"c{copy}"
            rows.append((len(rows), " ".join(own), "en", "s", 1))
    sets = {r[0]: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for r in rows for w in [r[1].split()]}
    low = reachable([(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], sets)
    got = {r.doc_id: r.component_id for r in ngram_join.similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == low and len(set(low.values())) > 2
    ids = [np.frombuffer(b.ids, np.int64) for b in blocks]
    assert len(ids) > 4 and max(map(len, ids)) <= 4 and len(np.unique(np.concatenate(ids))) == sum(map(len, ids))
    assert all(len(sets[k]) >= b.low and len(sets[k]) <= b.high for b, own in zip(blocks, ids, strict=True) for k in own)


def test_long_unrelated_texts_form_no_family(spark, monkeypatch):
    found, stored = {}, ngram_join.stored

    def seen(df, name, **how):
        found[name] = stored(df, name, **how)
        found[f"{name} rows"] = found[name].count()
        return found[name]

    monkeypatch.setattr(ngram_join, "stored", seen)
    monkeypatch.setattr(ngram_join, "LIGHT", 2)
    rows = spark.createDataFrame([(d, " ".join(f"d{d}w{k}" for k in range(6_000)), "en", "s", 1) for d in range(40)], SCHEMA)
    assert {(r.doc_id, r.component_id) for r in ngram_join.similar(rows).collect()} == {(d, d) for d in range(40)}
    assert found["members rows"] == 0


def test_long_sets_sign_no_empty_parts():
    """Else every long text would meet all others: their families, and what is stored of them, would grow with the input."""
    rng = np.random.default_rng(6)
    for size in (2_000, 6_000, 20_000):
        signs = [ngram_join.signatures(np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)), 80) for _ in range(2)]
        assert not len(np.intersect1d(*signs)) and min(int(x) & ngram_join.MOST_LEFT for x in signs[0]) > 0
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        x, y = (ngram_join.signatures(v, 80) for v in (a[: int(size * 0.95)], a[int(size * 0.1) :]))  # 85 of 100 in both
        for band in {int(v) >> ngram_join.LEFT_BITS & 63 for v in x} & {int(v) >> ngram_join.LEFT_BITS & 63 for v in y}:
            own = [v[v >> np.uint64(ngram_join.LEFT_BITS) & np.uint64(63) == band] for v in (x, y)]
            left = max(int(v[0]) & ngram_join.MOST_LEFT for v in own)
            both = len(np.intersect1d(*(v >> np.uint64(ngram_join.LEFT_BITS) for v in own)))
            assert both >= left > 0


@pytest.mark.parametrize(("per_cell", "sparse", "block", "kind"), [(4_000, 20_000, 1_500, "float"), (25, 20_000, 7, "double"), (25, 0, 7, "float")])
def test_large_labels_are_stored_once(spark, monkeypatch, per_cell, sparse, block, kind):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 8 * 16 * 20, raising=False)  # 20 vectors
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "SPARSE", sparse, raising=False)
    chunks, stored = [], embedding_dedup.stored

    def seen(df, name, **how):
        out = stored(df, name, **how)
        if name == "chunks":
            chunks.extend(out.select("part", "ids").collect())
        return out

    monkeypatch.setattr(embedding_dedup, "stored", seen)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 240)] + rng.normal(scale=0.18, size=(240, 16))
    x[200:215] = x[0] * np.linspace(1, 3, 15)[:, None]  # the same direction
    x[220:230] = x[3]  # the same vector
    x = x.astype(np.float32)
    label = np.where(np.arange(240) % 12 == 0, 2, np.arange(240) % 2)  # one that needs no chunks
    rows = spark.createDataFrame([(int(k), v.tolist(), int(label[k])) for k, v in enumerate(x)], f"vec_id bigint, embedding array<{kind}>, label int")
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (y @ y.T >= embedding_dedup.COSINE) & (label[:, None] == label[None, :])
    links = [(a, b) for a, b in itertools.combinations(range(240), 2) if near[a, b]]
    low, count = reachable(links, range(240)), np.bincount(np.array(links).ravel(), minlength=240)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(rows, per_cell=per_cell).collect()}
    assert got == {k: (count[k], low[k], low[k] == k) for k in range(240)} and len(links) > 100
    ids = [np.frombuffer(c.ids, np.int64) for c in chunks]
    assert {c.part for c in chunks} == {0, 1} and len(ids) > 6 and max(map(len, ids)) <= 20
    assert sorted(np.concatenate(ids).tolist()) == sorted(k for k in range(240) if label[k] != 2 and not (220 <= k < 230 and any(label[j] == label[k] for j in (3, *range(220, k)))))


def test_links_at_the_threshold_are_decided_in_doubles():
    """Cosines that single precision takes for more or less than they are."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=64)
    x /= np.linalg.norm(x)
    across = rng.normal(size=(300, 64))
    across -= np.outer(across @ x, x)
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    c = embedding_dedup.COSINE + np.linspace(-3e-8, 3e-8, 300)
    y = c[:, None] * x + np.sqrt(1 - c * c)[:, None] * across
    own = np.concatenate([x[None], y])
    chunk = embedding_dedup._Chunk(own, np.zeros(301, np.int64), np.arange(301), np.ones(301, np.int64), x[None])
    near = embedding_dedup._links(chunk, np.arange(1), chunk, np.arange(1, 301), embedding_dedup.COSINE, False)[0]
    assert (near == ((own[0] * own[1:]).sum(axis=1) >= embedding_dedup.COSINE)).all() and 100 < near.sum() < 200
    assert (near != (chunk.short[0] @ chunk.short[1:].T >= np.float32(embedding_dedup.COSINE))).any()
