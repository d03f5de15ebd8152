from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rodaje.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.integers(1, 40), max_size=30))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = Counter()
    for pattern, count in patterns:
        assert count > 0 and sum(n * k for n, k in pattern) <= 50
        for n, k in pattern:
            held[n] += k * count
    assert held == Counter({n: c for n, c in histogram.items() if n > 0})
    # No two containers could be one.
    used = sorted(sum(n * k for n, k in p) for p, c in patterns for _ in range(min(c, 2)))
    assert len(used) < 2 or used[0] + used[1] > 50


def test_every_token_has_one_place(spark):
    sizes = [(i, (i * 37) % 120) for i in range(500)] + [(900, 1000), (901, None), (902, 0), (None, 5), (3, 111)]
    df = spark.createDataFrame(sizes, "doc_id long, n long")
    out = packing.pack(df, capacity=100, deal=7).toPandas()
    want = Counter()
    for i, n in sizes:
        if i is not None:
            want[i] += n or 0
    assert out.groupby("doc_id").n_tokens.sum().to_dict() == dict(want)
    assert set(out.doc_id) == set(want)
    real = out[out.n_tokens > 0].sort_values(["container", "at"])
    for _, c in real.groupby("container"):
        assert (c["at"].to_numpy()[1:] >= (c["at"] + c.n_tokens).to_numpy()[:-1]).all()
        assert (c["at"] + c.n_tokens).max() <= 100
    # Only what is longer than a container is split.
    split = out.groupby("doc_id").piece.max()
    longest = {}
    for i, n in sizes:
        if i is not None:
            longest[i] = max(longest.get(i, 0), n or 0)
    assert all((split[i] > 0) == (n > 100) for i, n in longest.items())
    assert out.container.nunique() <= 1.15 * -(-real.n_tokens.sum() // 100)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, n long")
    assert packing.pack(df).count() == 0
    only = packing.pack(spark.createDataFrame([(1, 0), (2, None)], "doc_id long, n long")).toPandas()
    assert sorted(only.doc_id) == [1, 2] and set(only.container) == {0}
