"""What the driver holds for the toxicity index, and examples that repeat or are empty."""

import pickle
import tracemalloc

import numpy as np

from casemill.llm import _whole


def test_index_is_sent_without_a_copy_of_it_all():
    n = 3_000_000
    whole = _whole.Whole(np.zeros(n, np.uint64), np.zeros(n), np.arange(2), np.zeros(n, np.int32), np.ones((2, 3)), np.zeros(2), np.arange(2), np.zeros(2))
    tracemalloc.start()
    sent = pickle.dumps(whole, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000  # the arrays take 60 MB
    back = pickle.loads(sent)
    assert all(np.array_equal(getattr(back, k), v) and getattr(back, k).dtype == v.dtype for k, v in vars(whole).items() if v is not None)
    assert back.levels is None


def test_index_takes_examples_that_repeat_and_have_no_words(spark):
    rows = spark.createDataFrame([(2, "b a a", 1), (1, "", 0), (2, "a b", 1), (2, "b a a", 1), (3, None, 0)], "doc_id long, text string, toxic int")
    whole = _whole.build(rows, rows, bytes(range(256)))
    assert whole.ids.tolist() == [1, 2, 2, 2, 3] and whole.toxic.tolist() == [0, 1, 1, 1, 0]
    assert whole.n.tolist() == [3, 3] and whole.places.tolist() == [1, 2, 3] * 2
    assert sorted(whole.counts.tolist()) == [1, 1, 1, 1, 2, 2]
    assert _whole.build(rows.where("doc_id = 1"), rows.where("doc_id = 1"), bytes(range(256))).words.tolist() == []
