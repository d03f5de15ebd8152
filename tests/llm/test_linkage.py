import numpy as np

from rodaje.llm import linkage


def test_label_model_learns_accuracies_and_dependence():
    rng = np.random.default_rng(0)
    n = 20_000
    y = rng.random(n) < 0.3
    vote = lambda acc, quiet: np.where(rng.random(n) < quiet, 0, np.where((rng.random(n) < acc) == y, 1, -1))
    votes = np.stack([vote(0.95, 0.1), vote(0.9, 0.2), vote(0.85, 0.0), vote(0.6, 0.3)], axis=1)
    votes = np.column_stack([votes, np.where(rng.random(n) < 0.97, votes[:, 3], 0)])  # the fifth repeats the fourth
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = linkage.LabelModel([f"v{i}" for i in range(5)], dependent=0.05).fit(patterns, counts.astype(float))
    assert [4, 3] in model.factors
    post = dict(zip(map(tuple, patterns), model.posterior(patterns)))
    p = np.array([post[tuple(v)] for v in votes])
    assert ((p >= 0.5) == y).mean() > 0.95
    assert abs(p.mean() - y.mean()) < 0.03


GUIDE = "guia_id long, marca string, cca_modelo string, cca_version string, anio int, precio_miles long"
NEW = "registro_id long, marca string, descripcion string, anio int, valor_fiscal long, name string"


def tables(spark):
    trims = ["URBANA", "EXCELSA", "CUMBRE", "PULSO", "SENDERO"]
    guide, new, truth, i = [], [], set(), 0
    for m in range(40):
        model = "".join("BCDFG"[(m // 5**k) % 5] + "AEIOU"[(m + k) % 5] for k in range(3)) + "LA"
        for t in range(5):
            price = 20_000 + 317 * m + 4_000 * t
            i += 1
            trim, size = trims[t], ["1.0", "1.3", "1.6", "2.0", "2.8"][(t + m) % 5]
            guide.append((i, "ALVERA", model + [" 12", "-12", "12"][i % 3], f"5P {size.replace('.', ',')} {trim} MT6 2024", [2024, None][i % 7 == 0], price))
            if i % 2:
                short = [trim, trim[:3], trim[:4], trim][i % 4]
                new.append((i, "alvera ", f"{['', 'ALVERA '][i % 2]}{model} 12 {[size + 'L ', ''][i % 6 == 0]}{short} MT", 2024, int(price * 700 * (1 + (i % 5 - 2) / 200)), "x"))
                truth.add((i, i))
    new += [(9001, "ALVERA", None, 2024, 1, "x"), (9002, None, "ZZZ 1.0", None, None, "x"), new[0]]
    guide += [(8001, "ALVERA", None, None, None, None), guide[0]]
    return spark.createDataFrame(new, NEW), spark.createDataFrame(guide, GUIDE), truth


def test_links_versions_with_confidence(spark):
    new, guide, truth = tables(spark)
    linked = linkage.versions(new, guide)
    assert {(r.id_a, r.id_b) for r in linked.pairs().collect()} == truth
    # Every pair of records of one model name is in exactly one pair of classes, pairs against the trim included.
    by_model = {}
    for side, of in (("a", linked.a), ("b", linked.b)):
        for r in of.collect():
            by_model.setdefault(r.name, {"a": 0, "b": 0})[side] += 1
    every = linked.class_pairs().collect()
    assert sum(r.weight for r in every) == sum(m["a"] * m["b"] for m in by_model.values())
    assert any(r.v_trim < 0 for r in every) and all(0 <= r.confidence <= 1 for r in every)
    known = {(r.source, r.sig) for r in linked.members().collect()}
    assert all(("a", r.sig_a) in known and ("b", r.sig_b) in known for r in every)


def test_empty_tables(spark):
    new, guide, _ = tables(spark)
    assert linkage.versions(new.limit(0), guide).pairs().count() == 0
    assert linkage.versions(new, guide.limit(0)).class_pairs().count() == 0


def test_trims_are_spelled_out(spark):
    """Any number of full names, however rare each: a variant follows the name that is more frequent than it."""
    names = ["PACKPLUS", "PULSO", "TITANIA", "URBANA", "XR", *[f"{a}{b}O{a}IRA" for a in "BCDFGLMNR" for b in "AEIU"]]
    trims = names * 6 + ["URB", "UBRANA", "TTN", "PLS", "RBANA", "BAOBIR"] + [None]
    df = spark.createDataFrame([(t,) for t in trims], "trim string")
    full = linkage.full_trims(df)
    got = {r.trim: r.full for r in full.collect()}
    assert {k: got.get(k) for k in ("URB", "UBRANA", "TTN", "PLS", "RBANA", "BAOBIR")} == {
        "URB": "URBANA", "UBRANA": "URBANA", "TTN": "TITANIA", "PLS": "PULSO", "RBANA": "URBANA", "BAOBIR": "BAOBIRA",
    }
    assert not set(names) & set(got)
    assert linkage.with_full_trim(df, full).where("trim is null").count() == 1


def test_a_misprinted_model_name_meets_its_sole_partner(spark):
    row = "id long, brand string, name string"
    a = spark.createDataFrame([(1, "X", "SALIZAMO"), (2, "X", "FOVE"), (3, "X", "KETUNABO"), (4, "Y", "MIPEFESO"), (5, "X", "LEREKIDI"), (6, "X", "LEREKIDA"), (7, None, "BAGUKETO")], row)
    b = spark.createDataFrame([(1, "X", "SALIZAM"), (2, "X", "FOVI"), (3, "X", "KETUNABO"), (4, "X", "MIPEFESA"), (5, "X", "LEREKID"), (6, "X", "KETUNABA"), (7, None, "BAGUKETI")], row)
    got = {r.id: r.name for r in linkage.aligned_names(a, b).collect()}
    assert got == {1: "SALIZAMO", 2: "FOVI", 3: "KETUNABO", 4: "MIPEFESA", 5: "LEREKID", 6: "KETUNABA", 7: "BAGUKETI"}
