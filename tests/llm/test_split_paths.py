"""The ways that large families, cells and indexes take, forced on small tables, against brute force."""

import itertools

import numpy as np
import pytest

from casemill.llm import embedding_dedup, hamming_search, ngram_join

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def reachable(links, nodes):
    low = {n: n for n in nodes}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            return low


@pytest.mark.parametrize(("block", "small"), [(5, 0), (400, 1_000_000)])
def test_families_in_blocks(spark, monkeypatch, block, small):
    monkeypatch.setattr(ngram_join, "FAMILY_BLOCK", block)
    monkeypatch.setattr(ngram_join, "SMALL_LIST", small)
    rng, rows = np.random.default_rng(3), []
    for family, (size, changes) in enumerate([(30, 1), (24, 6), (12, 12), (3, 2)]):
        base = [f"f{family}w{k}" for k in range(150)]
        for copy in range(size):
            own = list(base)
            for k in rng.integers(0, 150, int(rng.integers(0, changes + 1))):
                own[k] = f"c{copy}"
            rows.append((len(rows), " ".join(own), "en", "s", 1))
    sets = {r[0]: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for r in rows for w in [r[1].split()]}
    low = reachable([(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], sets)
    got = {r.doc_id: r.component_id for r in ngram_join.similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == low and len(set(low.values())) > 4


def test_doc_ids_given_twice_or_not_at_all(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text, None, None, 1), (5, "other words of the same number here", None, None, 1), (9, text, None, None, 1), (8, "other words of the same number here", None, None, 1), (None, text, None, None, 1), (None, None, None, None, None)]
    got = sorted(((r.doc_id, r.component_id) for r in ngram_join.similar(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (9, 5), (8, 5), (None, None), (None, None)], key=str)


@pytest.mark.parametrize("per_cell", [4_000, 30])
def test_cells_in_blocks(spark, monkeypatch, per_cell):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    x = (centres[rng.integers(0, 20, 260)] + rng.normal(scale=0.18, size=(260, 16))).astype(np.float32)
    rows = spark.createDataFrame([(k, v.tolist(), k % 2) for k, v in enumerate(x)], VECTORS)
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = y @ y.T >= embedding_dedup.COSINE
    links = [(a, b) for a, b in itertools.combinations(range(260), 2) if near[a, b] and a % 2 == b % 2]
    low, count = reachable(links, range(260)), np.bincount(np.array(links).ravel(), minlength=260)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(rows, per_cell=per_cell).collect()}
    assert got == {k: (count[k], low[k]) for k in range(260)} and len(links) > 100


def test_vectors_of_several_lengths_repeated_ids_and_none(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0, 0.0], 0), (4, [1.0, 0.0, 0.01], 0), (5, [1.0, 0.0], 1), (6, [], 0), (7, None, 0), (8, [1.0, None], 0)]
    got = {(r.vec_id, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False), *((k, k, True) for k in (5, 6, 7, 8))}
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_index_sent_or_shuffled(spark, monkeypatch, small):
    monkeypatch.setattr(hamming_search, "SMALL_INDEX", small)
    rng = np.random.default_rng(8)
    signs = rng.choice([-1.0, 1.0], size=(160, 64))
    signs[100:130] = signs[0]  # equal codes
    rows = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(signs)], VECTORS)
    want = []
    for q in range(0, 160, 50):
        far = sorted((int((signs[q] != signs[k]).sum()), k) for k in range(160) if k != q)[:10]
        want += [(q, rank, k, d) for rank, (d, k) in enumerate(far, 1)]
    assert sorted(map(tuple, hamming_search.top_k(rows).collect())) == sorted(want)


def test_fewer_rows_than_asked_for(spark):
    rows = [(k, [1.0] * 64, 0) for k in range(4)]
    got = sorted(map(tuple, hamming_search.top_k(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == [(0, 1, 1, 0), (0, 2, 2, 0), (0, 3, 3, 0)]
    assert hamming_search.top_k(spark.createDataFrame([], VECTORS)).count() == 0
