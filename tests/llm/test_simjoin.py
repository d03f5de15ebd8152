import random

from pyspark.sql import functions as F

from rodaje.llm import simjoin


def test_set_join_against_all_pairs(spark):
    rng = random.Random(4)
    sets = lambda n: [(f"k{i}", sorted({rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 9))})) for i in range(n)]
    a, b = sets(60), sets(40)
    left = spark.createDataFrame([*a, ("e", []), ("n", None)], "key string, members array<string>")
    right = spark.createDataFrame(b, "key string, members array<string>")
    for t in (0.25, 0.5, 0.8, 1.0):
        want = {(i, j) for i, x in a for j, y in b if len({*x} & {*y}) / len({*x} | {*y}) >= t - 1e-12}
        for hot in (20_000, 5):
            assert {(r.l, r.r) for r in simjoin.set_join(left, right, t, hot=hot).collect()} == want


ENTRIES = [("f16", "Anclajes para silla infantil"), ("f17", "Aviso de presión de cubiertas"), ("f38", "Espejado de celular por cable"), ("f45", "Faros para niebla"), (None, "x"), ("f99", None)]


def named(spark, items):
    entries = spark.createDataFrame(ENTRIES, "caracteristica_id string, nombre string")
    df = spark.createDataFrame(items, "item_id long, item string").withColumn("entry", F.lit("clash"))
    got = {}
    for r in simjoin.named_entries(df, simjoin.reference_list(entries, simjoin.wordings(spark))).collect():
        got.setdefault(r.item_id, set()).add(r.entry)
    return got


def test_texts_name_entries(spark):
    items = [
        (1, "FAROS PARA NIEBLA"), (2, "• Fars para niebla (según versión)"), (3, "Anclaje ISOFIX + Top Tether / opcional"), (4, "TPMS y fog lmaps"),
        (5, "Android Auto y CarPlay con cable; Alfombras de goma"), (6, "Alfombras de goma"), (7, None), (8, ""), (9, " - de serie"),
        (4, "TPMS y fog lmaps"), (None, "TPMS"), (10, "Techo vidriado"),
    ]
    assert named(spark, items) == {
        1: {"f45"}, 2: {"f45"}, 3: {"f16"}, 4: {"f17", "f45"}, 5: {"f38"}, 6: {"ninguna"}, 7: {"ninguna"}, 8: {"ninguna"}, 9: {"ninguna"}, 10: {"ninguna"},
    }


def test_empty_table(spark):
    assert named(spark, []) == {}


def test_long_texts_within_the_edit_bound_are_found(spark):
    rng = random.Random(6)
    entry = ["faroparanieblaadelant", "abababababababababab", "sensordelluviaycrepuscular", "aaaaaaaaaabbbbbbbbbb"]
    spoilt = []
    for i, text in enumerate(entry):
        most = len(text) * 3 // 10
        for shift in range(3):
            letters = list(text)
            for e in range(most):
                letters[min(len(text) - 1, shift + e * len(text) // most)] = rng.choice("0123456789")
            spoilt.append(("".join(letters), f"f{i}"))
    values = spark.createDataFrame(spoilt, "bare string, want string")
    reference = spark.createDataFrame([(t, f"f{i}") for i, t in enumerate(entry)], "bare string, entry string")
    got = {r.bare: r.entry for r in simjoin.closest(values, reference).collect()}
    assert got == dict(spoilt)


def test_misprints_of_names_that_are_not_in_the_table_of_wordings(spark):
    """Names made up here, without any other words for them: nine of ten misprinted ones are found, and to no wrong entry."""
    rng = random.Random(8)
    syllable = lambda: rng.choice("bcdfglmnprstv") + rng.choice("aeiou")
    names = {f"e{i}": " ".join("".join(syllable() for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 3))) for i in range(60)}
    entries = spark.createDataFrame(list(names.items()), "caracteristica_id string, nombre string")
    items = []
    for i in range(600):
        entry = f"e{i % 60}"
        letters = list(names[entry])
        for _ in range(1 + len(letters) // 12):
            at = rng.randrange(len(letters))
            letters[at : at + 1] = rng.choice([[], [letters[at]] * 2, [rng.choice("aeiouxyz")]])
        items.append((i, "".join(letters)))
    df = spark.createDataFrame(items, "item_id long, item string")
    got = [(r.item_id, r.entry) for r in simjoin.named_entries(df, simjoin.reference_list(entries)).collect() if r.entry != "ninguna"]
    right = sum(e == f"e{i % 60}" for i, e in got)
    assert right >= 0.9 * len(items)
    assert len(got) - right <= 0.01 * len(items)
