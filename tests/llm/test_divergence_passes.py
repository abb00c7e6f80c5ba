"""The divergence reads texts and pairs once, and sums sparse vectors right."""

import re
from collections import Counter

import pyarrow as pa

from casemill.llm import divergence


def test_sums_of_a_task():
    odd = ["aB é-ab AB", "", None, "x\x00y zÄÄ z", "AB", "1 2", "日本 ab"]
    lang, source = ["l", "l", "l", "m", "l", "n", "m"], ["s", "t", "s", "s", "s", "", "s"]
    batch = pa.record_batch([pa.array(lang), pa.array(source), pa.array(odd)], names=["lang", "source", "text"])
    n, df = Counter(), Counter()
    for g, s, text in zip(lang, source, odd, strict=True):
        own = Counter("".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
        for t, k in [*own.items(), (None, 0)]:
            n[g, s, t] += 2 * k
            df[g, s, t] += 2 * (t is not None)
    for most in (0, divergence.MOST_TERMS):
        found, places = (Counter(), Counter())
        for out in divergence._group_sums(most)(iter([batch, batch.slice(0, 0), batch])):
            for r in out.to_pylist():
                found[r["lang"], r["source"], r["term"]] += r["n"]
                places[r["lang"], r["source"], r["term"]] += r["df"]
        assert dict(found) == dict(n) and dict(places) == dict(df)


def test_pairs_are_summed_once(spark):
    docs = spark.createDataFrame([(f"w{'abcdefghijk'[i % 11]} common", "en", f"s{i % 3}") for i in range(60)], "text string, lang string, source string")
    plan = divergence.audit(docs, min_df=1)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan
