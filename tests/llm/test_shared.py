import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from halyard.llm import shared


def lower(x):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), x)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB\u00e9 \t\n\x0b\u00a0", max_size=40)), min_size=1, max_size=12), st.integers(1, 60))
def test_words_and_shingles_equal_the_plain_way(texts, most):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    seen = 0
    for part, data, offsets in shared.blocks([batch], "text", most):
        plain = [re.findall(shared.WORD, x or "") for x in part.column("text").to_pylist()]
        start, end, doc = shared.words(data, offsets)
        got = [bytes(data[a:b]).decode() for a, b in zip(start, end, strict=True)]
        assert got == [w for x in plain for w in x]
        h = shared.word_hashes(data, start, end)
        assert len({*h.tolist()}) == len({lower(w) for w in got})
        runs, of = shared.shingles(h, doc, len(plain), 4)
        for i, x in enumerate(plain):
            x = [lower(w) for w in x]
            want = {tuple(x[k : k + 4]) for k in range(max(1, len(x) - 3))} if x else set()
            assert len(np.unique(runs[of == i])) == len(want)
        seen += part.num_rows
    assert seen == len(texts)


def test_a_word_longer_than_a_segment(monkeypatch):
    monkeypatch.setattr(shared, "SEGMENT", 50)
    rng = random.Random(1)
    words = ["".join(rng.choice("abC") for _ in range(rng.choice((3, 20, 120)))) for _ in range(200)] * 2
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end, _ = shared.words(data, np.array([0, len(data)]))
    h = shared.word_hashes(data, start, end).tolist()
    assert h[:200] == h[200:] and len({*h}) == len({w.lower() for w in words})


def test_most_frequent_is_bounded_and_takes_the_largest(spark):
    counts = spark.range(1000).selectExpr("id h", "id + 1 as n")
    for most in (0, 1, 10, 500, 5000):
        got = sorted(r.n for r in shared.most_frequent(counts, "n", most).collect())
        if most in (1,):  # less than the highest band of 1 %: a part of it, by a hash
            assert len(got) == 1 and got[0] >= 990
        else:
            assert len(got) <= most and got == list(range(1001 - len(got), 1001))
    assert len(shared.most_frequent(counts, "n", 5000).collect()) == 1000
    assert shared.most_frequent(counts.limit(0), "n", 5).count() == 0
