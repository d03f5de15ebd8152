import random

from pyspark.sql import functions as F

from rodaje.llm import spans

SPAN, K = 30, 16


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    shared = [word(k) for k in (29, 30, 31, 45, 90)]
    docs = []
    for i in range(n):
        parts = [word(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), word(rng.randint(0, 40))]
        docs.append((i, "ñ" * (i % 3) + "".join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "-" * 200), (n + 3, "x" + "-" * 90 + "y"), (n + 4, "-" * 31), (n + 5, docs[5][1]), (n + 6, docs[5][1])]
    return docs


def brute(docs):
    where = {}
    for i, t in docs:
        for p in range(len(t or "") - SPAN + 1):
            where.setdefault(t[p : p + SPAN], set()).add(i)
    pairs = {(a, b) for s in where.values() for a in s for b in s if a < b}
    covered = {
        i: len({q for p in range(len(t or "") - SPAN + 1) if len(where[t[p : p + SPAN]]) > 1 for q in range(p, p + SPAN)}) for i, t in docs
    }
    return pairs, covered


def test_pairs_and_shares_against_all_windows(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("doc", F.lit("clash"))
    pairs, covered = brute(docs)
    for fill in (5000, 3):
        assert {tuple(r) for r in spans.shared_pairs(df, span=SPAN, k=K, fill=fill).collect()} == pairs
        share = {r["doc"]: (r["shared_chars"], r["n_chars"]) for r in spans.shared_share(df, span=SPAN, k=K, fill=fill).collect()}
        assert share == {i: (covered[i], len(t or "")) for i, t in docs}


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(spans, "_STARTS", 50)
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in spans.shared_pairs(df, span=SPAN, k=K).collect()} == brute(docs)[0]


def test_repeated_rows_and_empty_table(spark):
    text = "abcdefghijklmnopqrstuvwxyz0123456789"
    df = spark.createDataFrame([(1, text), (1, text), (2, "zz" + text)], "doc_id long, text string")
    assert [tuple(r) for r in spans.shared_pairs(df, span=SPAN, k=K).collect()] == [(1, 2)]
    assert spans.shared_pairs(df.limit(0), span=SPAN, k=K).count() == 0
    assert spans.shared_share(df.limit(0), span=SPAN, k=K).count() == 0


def stretches(seed=0):
    """Pairs of texts that share evenly repeated passages of about SPAN characters, in any phase or up to their ends."""
    rng = random.Random(seed)
    docs = []
    for period in [*range(1, SPAN - K + 3)] * 12:
        word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
        unit = word(period)
        a = word(3) + unit * (rng.randint(2, 5) * SPAN // period) + word(2)
        phase, n = rng.randint(0, period), rng.randint(SPAN - 3, SPAN + 2)
        b = rng.choice([(unit * (n + 2))[phase : phase + n], a[-n:], a[:n]])
        docs += [word(rng.randint(0, 40)) + t + word(rng.randint(0, 60)) for t in (a, b)]
    return list(enumerate(docs))


def test_evenly_repeated_passages_off_phase(spark):
    for seed in range(2):
        docs = stretches(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string")
        pairs, covered = brute(docs)
        assert {tuple(r) for r in spans.shared_pairs(df, span=SPAN, k=K).collect()} == pairs
        for fill in (5000, 7):
            share = {r["doc"]: r["shared_chars"] for r in spans.shared_share(df, span=SPAN, k=K, fill=fill).collect()}
            assert share == covered


def test_ruler_that_ends_alike(spark):
    # One text holds the last 29 dashes of the other's ruler and the letter after them.
    docs = [(i, "abcdefghijklm"[i:] + "-" * 80 + "X" + "nopqrstuvwxyz" * 3) for i in range(8)]
    docs += [(10 + i, "ABCDEFGHIJKLM"[i:] + "-" * 29 + "X" + "NOPQRSTUVWXYZ"[i:] * 3) for i in range(8)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in spans.shared_pairs(df, span=SPAN, k=K).collect()} == brute(docs)[0]


def test_classes_and_links(spark):
    docs = corpus(5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    pairs, _ = brute(docs)
    text = dict(docs)
    rep = {i: min(j for j, u in docs if u == t) if t and len(t) >= SPAN else i for i, t in docs}
    other = {i: {rep[j] for p in pairs if i in p for j in p if text[j] != text[i]} for i, _ in docs}
    got = {r["doc"]: (r["class"], r["copies"], r["links"]) for r in spans.shared_links(df, span=SPAN, k=K).collect()}
    assert got == {i: (rep[i], sum(rep[j] == rep[i] for j, _ in docs), len(other[i])) for i, _ in docs}


def test_zero_characters_do_not_match_a_beginning(spark):
    body = "abcdefghijklmnopqrstuvwxyz0123"
    docs = [(1, body[:29] + "!!" * 20), (2, "zz\x00" + body[:29] + "??" * 20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert spans.shared_pairs(df, span=SPAN, k=K).count() == 0


def test_production_span_over_periodic_boilerplate_and_random_texts(spark):
    """The span and gram of the queries: rulers and tables of all periods in any phase, one passage in a third of the texts, random texts."""
    rng = random.Random(11)
    word = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    common = word(170)
    docs = []
    for period in [2, 3, 7, 20, 30, 31, 50, 60, 69, 70, 71, 80] * 6:
        unit = word(period)
        a = unit * (rng.randint(160, 600) // period + 1)
        phase, n = rng.randint(0, period), rng.randint(146, 176)
        b = (unit * (n // period + 3))[phase : phase + n]
        docs += [word(rng.randint(0, 90)) + t + word(rng.randint(0, 90)) for t in (a, b)]
    docs += [word(rng.randint(0, 300)) + common[rng.randint(0, 25) :] + word(rng.randint(0, 300)) for _ in range(70)]
    docs += [word(rng.randint(0, 600)) for _ in range(30)]
    docs = list(enumerate(docs))
    where = {}
    for i, t in docs:
        for p in range(len(t) - 149):
            where.setdefault(t[p : p + 150], set()).add(i)
    pairs = {(a, b) for s in where.values() for a in s for b in s if a < b}
    covered = {i: len({q for p in range(len(t) - 149) if len(where[t[p : p + 150]]) > 1 for q in range(p, p + 150)}) for i, t in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for fill in (5000, 40):
        assert {tuple(r) for r in spans.shared_pairs(df, fill=fill).collect()} == pairs
    assert {r["doc"]: r["shared_chars"] for r in spans.shared_share(df).collect()} == covered
