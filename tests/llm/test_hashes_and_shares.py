"""Long tokens of one structure keep their own hashes; shares reach the rows of many sources alike."""

import numpy as np
import pytest

from casemill.llm import _shared, line_dedup, mixing, ngram_join

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def thue_morse(letters, n=2048):
    bits = np.array([bin(k).count("1") & 1 for k in range(n)])
    return "".join(letters[b] for b in bits)


ONE, OTHER = thue_morse("ab"), thue_morse("ba")


def test_hashes_of_thue_morse_words():
    h = _shared.token_hashes(f"{ONE} {OTHER} {ONE}".encode())[0]
    assert h[0] == h[2] != h[1]
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list("xy"), size=int(n))) for n in rng.integers(1, 600, 3000)}
    assert len(np.unique(_shared.token_hashes(" ".join(words).encode())[0])) == len(words)


def test_long_lines_and_words_are_told_apart(spark):
    docs = spark.createDataFrame([(1, ONE, "en", "s", 1), (2, OTHER, "en", "s", 1), (3, ONE, "en", "s", 1)], SCHEMA)
    assert {r.doc_id: r.text for r in line_dedup.remove_lines(docs, run=1).collect()} == {1: ONE, 2: OTHER, 3: ""}
    assert {r.doc_id: r.component_id for r in ngram_join.similar(docs).collect()} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("small", [100_000, 0])
def test_shares_by_broadcast_and_by_salt(spark, monkeypatch, small):
    rows = [(k, "w " * (k % 9), "en", ["hot", "hot", None, "a", f"s{k % 5}"][k % 5], 1) for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "SMALL_SOURCES", small)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == want and len(want) == 200
    taken = {r.doc_id: r.repeats for r in mixing.mix(docs).collect()}
    got = [r.doc_id for r in mixing.repeated(docs).collect()]
    assert {k: got.count(k) for k in taken} == taken


def test_discard_removes_files(spark):
    from pathlib import Path

    kept, gone = (_shared.stored(spark.range(3).toDF("x"), n) for n in ("kept", "gone"))
    paths = [Path(_shared._paths[df].removeprefix("file:")) for df in (kept, gone)]
    _shared.discard(gone)
    _shared.discard(gone)
    assert paths[0].exists() and not paths[1].exists() and kept.count() == 3
