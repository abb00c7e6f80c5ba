"""Licence chains against all chains there are; phrases of one word; names that clash with results."""

import random

from pyspark.sql import functions as F

from casemill.llm import licenses, sentencepiece, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def best_cover(spans, gap):
    """The most words that a chain of (start, end, place, to) covers, by trying all of them."""

    def behind(last, covered):
        top = covered
        for start, end, place, to in spans:
            if start >= last[0] and end > last[1] and to > last[3] and start - last[1] <= gap and place - last[3] <= gap:
                top = max(top, behind((start, end, place, to), covered + min(end - start, to - last[3], end - last[1])))
        return top

    return max(behind(s, s[1] - s[0]) for s in spans)


def test_best_chain_of_all():
    rng = random.Random(6)
    for _ in range(300):
        matches = sorted({(rng.randrange(14), rng.randrange(1, 5), "t", rng.randrange(14)) for _ in range(rng.randrange(1, 8))})
        spans = [(s, s + n, p, p + n) for s, n, _, p in matches]
        found = licenses.chains(matches, {"t": 99}, 3)
        assert max(c for *_, c in found) == best_cover(spans, 3)
        assert all(any(s == x[0] for x in spans) and any(e == x[1] for x in spans) for _, s, e, _ in found)


def test_a_stray_match_does_not_break_the_chain():
    # the stray match at place 7 would be chained first, and shut out the one at place 4
    matches = [(0, 4, "t", 0), (4, 1, "t", 7), (5, 6, "t", 4)]
    assert max(licenses.chains(matches, {"t": 10}, 3), key=lambda x: x[3]) == ("t", 0, 11, 10)


def test_phrases_of_one_word(spark):
    docs = spark.createDataFrame([(1, "zzz gpl qqq", None, None, 1), (2, "this is gpl code", None, None, 1), (3, "gpl", None, None, 1), (4, "gplx", None, None, 1)], SCHEMA)
    got = {r.doc_id: (r.n_base, r.first_word, r.base_labels) for r in licenses.scan_licenses(docs, phrases={"gpl": "g", "code of law": "l"}).collect()}
    assert got == {1: (1, 1, "g"), 2: (1, 2, "g"), 3: (1, 0, "g"), 4: (0, None, "")}
    bare = {r.doc_id: r.base_labels for r in licenses.scan_licenses(docs, templates={}, phrases={"gpl": "g"}).collect()}
    assert bare == {1: "g", 2: "g", 3: "g", 4: ""}


def test_results_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "cc by", None, None, 1)], SCHEMA).withColumns({c: F.lit("mine") for c in ("labels", "score", "rest", "ids", "parity", "decoded", "toxic_score")})
    told = licenses.scan_licenses(docs)
    assert len(set(told.columns)) == len(told.columns)
    assert told.select("labels", "rest", "ids").collect() == [("cc-by", "mine", "mine")]
    coded = sentencepiece.decode(sentencepiece.encode(docs))
    assert len(set(coded.columns)) == len(coded.columns)
    assert coded.select("decoded", "parity", "rest", "labels").collect() == [("cc by", True, "mine", "mine")]
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert len(set(scored.columns)) == len(scored.columns) and scored.schema["toxic_score"].dataType.typeName() == "double"
    assert scored.select("rest", "score").collect() == [("mine", "mine")]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert licenses.scan_licenses(docs).count() == sentencepiece.decode(sentencepiece.encode(docs)).count() == 0


def test_toxicity_of_nothing_and_without_ids(spark):
    docs = spark.createDataFrame([(1, "some words", None, None, 1), (None, "some words", None, None, 1), (2, None, None, None, 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {(r.doc_id, r.text): r.toxic_score for r in toxicity.score(docs, model).collect()}
    assert len(scores) == 3 and scores[1, "some words"] == scores[None, "some words"] and all(0 <= v <= 1 for v in scores.values())
    assert None not in [int(k) for k in model.ids] and toxicity.score(spark.createDataFrame([], SCHEMA), model).count() == 0
