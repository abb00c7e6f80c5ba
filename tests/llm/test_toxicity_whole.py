"""Texts without a kept term are held against all words of the examples."""

import numpy as np
from pyspark.sql import functions as F

from casemill.llm import _whole, toxicity

SCHEMA = "doc_id bigint, text string"


def test_near_copy_of_an_example_without_kept_terms(spark):
    rng = np.random.default_rng(7)
    plain = ["".join(chr(97 + k // 26**i % 26) for i in range(2)) + "ord" for k in range(300)]
    rows = [(k, " ".join(rng.choice(plain, 40))) for k in range(200)]
    rows += [(200 + k, " ".join([*rng.choice(plain, 30), "vile", "nasty"])) for k in range(20)]
    odd = " ".join(f"q{chr(97 + k)}x{chr(97 + k)}" for k in range(20))
    rows += [(300, odd), (301, " ".join(reversed(odd.split()))), (302, ""), (303, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, int(k >= 200)) for k in range(220)] + [(300, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    features = toxicity.Features(model.terms)
    assert model.terms and not features(odd.encode())
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[301].toxic_evidence[0] == 300 and abs(got[301].toxic_cosines[0] - 1) < 1e-6 and got[301].toxic_score >= toxicity.THRESHOLD
    assert got[302].toxic_evidence == got[303].toxic_evidence == [] and got[302].toxic_score == got[303].toxic_score == model.none
    own = {k: (t or "").split() for k, t in rows}
    df = {w: sum(w in set(x) for x in own.values()) for w in {w for x in own.values() for w in x}}
    examples = [*range(220), 300]

    def vector(k):
        v = {w: (1 + np.log(own[k].count(w))) * np.log(1 + len(rows) / (1 + df[w])) for w in set(own[k])}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {k: vector(k) for k in examples}
    whole = _whole.build(docs, docs.join(labels, "doc_id"), toxicity._LETTERS)
    told = _whole.votes(whole, docs.join(labels, "doc_id"), lambda: lambda text: True, toxicity._LETTERS, 15)
    votes = dict(zip(told[0].tolist(), told[2].tolist(), strict=True))
    assert sorted(votes) == examples
    for common in (0, 5, 256):  # with and without lists, and with some words of either kind
        _whole.COMMON, before = common, _whole.COMMON
        whole = _whole.build(docs, docs.join(labels, "doc_id"), toxicity._LETTERS)
        assert whole.matrix.shape == (min(common, len(whole.words)), 221)
        _whole.COMMON = before
        for k in (0, 7, 210, 300):
            cosines = {e: sum(x * vectors[e].get(w, 0) for w, x in vectors[k].items()) for e in examples}
            want = sorted(cosines.items(), key=lambda x: (-round(x[1], 9), x[0]))[:15]
            (places, found), = whole.nearest([whole.vector(_whole.bag(" ".join(own[k]).encode(), toxicity._LETTERS))], 15)
            want = [(e, c) for e, c in want if round(c, 9) > 0]
            assert whole.ids[places].tolist() == [e for e, _ in want] and np.allclose(found, [c for _, c in want])
            alone = [(e, c) for e, c in sorted(cosines.items(), key=lambda x: (-round(x[1], 9), x[0])) if e != k and round(c, 9) > 0][:15]
            vote = sum(c for e, c in alone if e >= 200) / sum(c for _, c in alone) if alone else 0
            assert np.isclose(votes[k], vote)


def test_no_labels_no_index(spark):
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert model.whole is None and toxicity.score(docs, model).agg(F.count("toxic_score")).first()[0] == 1
