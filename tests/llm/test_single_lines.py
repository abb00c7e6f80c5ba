"""Repeated single lines go in op7 and in the pipeline, whatever the length of the document."""

import hashlib
from collections import Counter

import corpus_pipeline
from casemill.llm import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def kept_lines(rows):
    """doc_id, text without the lines that stand earlier, and their number; rows that agree in both count once."""
    seen, done, out = set(), {}, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if (doc_id, text) not in done:
            kept, gone = [], 0
            for line in (text or "").split("\n"):
                if line and line in seen:
                    gone += 1
                else:
                    kept.append(line)
                seen.add(line)
            done[doc_id, text] = text and "\n".join(kept), gone
        out.append((doc_id, *done[doc_id, text]))
    return out


def test_op7_removes_single_lines(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(d, n, t if t is None else hashlib.sha256(t.encode()).hexdigest()) for d, t, n in kept_lines(rows)]
    assert Counter(map(tuple, queries.QUERIES["op7_line_dedup"](spark, SF).collect())) == Counter(want)


def test_stage_removes_single_lines(spark):
    rows = [(1, "own\nfooter"), (2, "footer"), (3, "footer\n\nother"), (4, "a\nb"), (5, "a\nb"), (6, "b\nb\nc"), (7, None), (8, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF).collect()}
    assert got == {1: "own\nfooter", 3: "\nother", 4: "a\nb", 6: "c", 7: None, 8: ""}
    assert got == {d: t for d, t, n in kept_lines(rows) if not n or t.strip()}
