import random

import pytest
from pyspark.sql import functions as F

from rodaje.llm import tokens

PARTS = ["a", "b", "é", "ñ", " ", "  ", "\n", "1", "2", "'", "'s", "'re", ".", "!", "--", "日本", "aaaa", "ab" * 9, "    ", "x" * 40, "-" * 30, " ", "\x1c", "🙂"]


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder()


def texts(n, seed=0):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return [*out, "".join(rng.choice("abcdefgh") for _ in range(3000)), "z" * 2000, " " * 999 + "x", "'" * 500]


def test_pieces_join_to_the_encoding_of_the_whole(enc):
    for t in texts(600):
        whole = enc.encode_ordinary(t)
        assert enc.decode(whole) == t
        for piece in (4, 7, 16, 100):
            assert tokens.encode(enc, t, piece) == whole


def test_rows_null_empty_and_repeated(spark, enc):
    data = [(1, None), (2, ""), (3, " "), (4, "El service de 10.000 km"), (4, "El service de 10.000 km"), (5, "<|endoftext|>")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = sorted((r.doc_id, r.ids) for r in tokens.token_ids(df).collect())
    assert got == sorted((i, enc.encode_ordinary(t or "")) for i, t in data)
    assert tokens.token_ids(df.limit(0)).count() == 0


def test_long_texts_spread_over_tasks(spark, enc):
    data = [(i, t) for i, t in enumerate(texts(40, 5))] + [(0, "b" * 3000)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted((r.doc_id, r.ids) for r in tokens.token_ids(df, piece=50, spread=200).collect())
    assert got == sorted((i, enc.encode_ordinary(t)) for i, t in data)
    counts = sorted(tuple(r) for r in tokens.token_counts(df, piece=50, spread=200).collect())
    assert counts == sorted((i, len(enc.encode_ordinary(t))) for i, t in data)
