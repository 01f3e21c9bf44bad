import numpy as np

from pyspark.sql import functions as F

from tallymark.llm import linkage as L
from tallymark.llm import queries as Q
from tallymark.session import shuffled, small_side

PEOPLE = "person_id bigint, name string, insts array<string>, doctorate array<string>, counts array<bigint>, indexes array<bigint>"
FOUND = "candidate_id bigint, name string, insts array<string>, count bigint, h_index bigint, reported double"


def tables(spark, people, found):
    p = spark.createDataFrame(people, PEOPLE).withColumn("forms", L.name_forms(F.col("name"))).withColumn("count", F.lit("clash")).withColumn("k", F.lit(1)).withColumn("cf", F.lit(2))
    f = spark.createDataFrame(found, FOUND).withColumn("forms", L.name_forms(F.col("name"))).withColumn("counts", F.lit("clash")).withColumn("pi", F.lit(1))
    return p, f


def test_name_forms(spark):
    cases = {
        "Dr. Élla M. Brøok": [("ella", "m", "brook", 1)], "Brook, Ella": [("ella", "", "brook", 1)], "BROOK Ella": [("ella", "", "brook", 1)], "ELLA BROOK": [("ella", "", "brook", 1)],
        "Ella Brook-Stone": [("ella", "", "brookstone", 1), ("ella", "", "brook", 0), ("ella", "", "stone", 0)], "Ella Brook, Ph.D.": [("ella", "", "brook", 1)], "Ella": [], "": [], None: [], "...": [],
    }
    got = {r.n: [tuple(x) for x in r.f] if r.f is not None else [] for r in spark.createDataFrame([(c,) for c in cases], "n string").select("n", L.name_forms(F.col("n")).alias("f")).collect()}
    assert got == cases


def test_levels(spark):
    def level(a, b):
        df = spark.createDataFrame([(a, b)], "a string, b string").select(L.name_forms(F.col("a"))[0].alias("x"), L.name_forms(F.col("b"))[0].alias("y"))
        return df.select(L.name_level(F.col("x"), F.col("y"))).first()[0]

    assert [level("Ella M. Brook", x) for x in ("Ella Mary Brook", "Ella Brook", "Elle Brook", "Ell Brook", "E. Brook", "Ella K. Brook", "Cara Brook", "Ella Brok")] == [6, 5, 4, 4, 2, 1, 0, 4]


def test_blocking_finds_typos_initials_and_short_names(spark):
    people = [(1, "Rosalind Harper", [], [], [], [])]
    names = ["Rosalind Harper", "Harper, R.", "Rosalnid Harper", "Rosalind Harpr", "Rosa Harper", "Petra Harper", "HARPER Rosalind"]
    p, f = tables(spark, people, [(i, n, [], None, None, None) for i, n in enumerate(names)])
    got = {r.candidate_id for r in L.compared_pairs(p, f).where("name_level > 0").collect()}
    assert got == {0, 1, 2, 3, 4, 6}


def test_em_separates_matches():
    r = np.random.default_rng(0)
    n = 20_000
    match = r.random(n) < 0.3
    draw = lambda good, bad: np.where(match, r.choice(len(good), n, p=good), r.choice(len(bad), n, p=bad))
    data = np.stack([draw([0.02, 0.03, 0.05, 0.1, 0.1, 0.5, 0.2], [0.5, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05]), draw([0.05, 0.1, 0.15, 0.7], [0.8, 0.1, 0.05, 0.05]), draw([0.02, 0.08, 0.05, 0.1, 0.75], [0.5, 0.25, 0.05, 0.1, 0.1]), draw([0.1, 0.1, 0.3, 0.5], [0.4, 0.1, 0.3, 0.2])], 1)
    patterns, counts = np.unique(data, axis=0, return_counts=True)
    model = L.fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.3) < 0.03 and abs(model.m["inst_level"][3] - 0.7) < 0.05 and abs(model.u["inst_level"][0] - 0.8) < 0.05


def test_link_picks_one_person_and_leaves_ties(spark):
    r = np.random.default_rng(1)
    syll = ["ba", "ko", "ri", "ten", "mul", "sar", "vel", "ox", "pim", "dra"]
    word = lambda: "".join(r.choice(syll, 3)).title()
    people, found = [], []
    for i in range(300):
        name, inst, total = f"{word()} {word()}", f"university of {word().lower()} bay", int(r.integers(50, 5000))
        people.append((i, name, [inst], [], [total], [10]))
        found.append((i, name if i % 3 else f"{name.split()[1]}, {name.split()[0]}", [inst], int(total * 0.9), 9, 0.95))
        found.append((1000 + i, name, ["technical institute elsewhere"], total * 20, 60, 0.8))
    people += [(900, "Twin Brother", ["college of oaks"], [], [100], [5]), (901, "Twin Brother", ["college of oaks"], [], [100], [5])]
    found += [(5000, "Twin Brother", ["college of oaks"], 95, 5, 0.9), (5001, None, [], None, None, None)]
    p, f = tables(spark, people, found)
    rows = L.link(p, f).collect()
    got = {(x.person_id, x.candidate_id) for x in rows}
    want = {(i, i) for i in range(300)}
    assert len(got & want) >= 295 and len(got - want) <= 5 and not any(c == 5000 for _, c in got)
    assert len({x.candidate_id for x in rows}) == len(rows) and all(0.5 <= x.confidence <= 1 for x in rows)
    assert L.link(p.limit(0), f).count() == 0 and L.link(p, f.limit(0)).count() == 0


def test_hot_names_are_refined_without_loss(spark, monkeypatch):
    r = np.random.default_rng(5)
    syll = ["ba", "ko", "ri", "ten", "mul", "sar", "vel", "ox", "pim", "dra", "zu", "fen"]
    word = lambda: "".join(r.choice(syll, 4)).title()
    people, found = [], []
    for i in range(400):
        # A third of all people and candidates share one name.
        name = "Ann Brook" if i % 3 == 0 else f"{word()} {word()}"
        inst, total = f"university of {word().lower()} harbour", int(r.integers(50, 5000))
        people.append((i, name, [inst], [], [total], [10]))
        found.append((i, name, [inst], int(total * 0.9), 9, 0.95))
        found.append((1000 + i, name, ["technical institute elsewhere"], total * 20, 60, 0.8))
    p, f = tables(spark, people, found)
    n_plain = L.compared_pairs(p, f).count()
    right = {(i, i) for i in range(400)}
    assert len(right & {(x.person_id, x.candidate_id) for x in L.link(p, f).collect()}) >= 392
    monkeypatch.setattr(L, "HOT_PAIRS", 1000)
    fine = {(x.person_id, x.candidate_id) for x in L.link(p, f).collect()}
    assert L.compared_pairs(p, f).count() < n_plain / 2
    assert len(right & fine) >= 392 and len(fine - right) <= 2


def hot_tables(spark, people, found, others=()):
    """Everyone is called Ann Brook, with or without one of three middle names; ``others`` have names of their own and one candidate each."""
    middle = lambda i: ["", "Mary ", "K. ", "Zoe "][i % 4]
    p = [(i, f"Ann {middle(i)}Brook", insts, doctorate, counts, [len(insts) + 3]) for i, (insts, doctorate, counts) in enumerate(people)]
    f = [(i, f"Ann {middle(i)}Brook", insts, count, h, 0.8 if i % 3 else None) for i, (insts, count, h) in enumerate(found)]
    p += [(1000 + i, f"Cara {w}", [f"university of {w}"], [], [100 + i], [9]) for i, w in enumerate(others)]
    f += [(1000 + i, f"Cara {w}", [f"university of {w}"], 95 + i, 9, 0.95) for i, w in enumerate(others)]
    return tables(spark, p, f)


def patterns(rows):
    out = {}
    for x in rows:
        k = (x.candidate_id, *(x[f] for f in L.LEVELS))
        n, one = out.get(k, (0, None))
        out[k] = (n + x.n, x.person_id if n + x.n == 1 else None)
    return out


def both_ways(monkeypatch, take):
    got = []
    for hot_pairs in (10**12, 100):
        monkeypatch.setattr(L, "HOT_PAIRS", hot_pairs)
        got.append(take())
    return got


def confidences(p, f):
    return {(x.person_id, x.candidate_id): round(x.confidence, 9) for x in L.link(p, f).collect()}


def test_many_people_that_agree_alike_count_as_rivals(spark, monkeypatch):
    # 300 people share institution and count, so one key of evidence holds them all.
    monkeypatch.setattr(L, "PEOPLE_BLOCK", 70, raising=False)
    people = [(["university of oaks"], [], [100])] * 300 + [([f"college of place {chr(97 + i)}x"], [], [100 * i]) for i in range(20)]
    p, f = hot_tables(spark, people, [(["university of oaks"], 95, 5)] * 8 + [([f"college of place {chr(97 + i)}x"], 100 * i, 5) for i in range(20)])
    plain, hot = both_ways(monkeypatch, lambda: confidences(p, f))
    assert plain and hot == plain
    plain, hot = both_ways(monkeypatch, lambda: patterns(L.compared_pairs(p, f).collect()))
    assert sum(n for n, _ in hot.values()) == len(people) * 28 and hot == plain


def test_hot_names_keep_every_pair(spark, monkeypatch):
    # Misspelt, missing and several institutions, figures far off or missing; two people also meet through another name.
    monkeypatch.setattr(L, "PEOPLE_BLOCK", 25, raising=False)
    monkeypatch.setattr(L, "FOUND_BLOCK", 40, raising=False)
    r = np.random.default_rng(3)
    syll = ["ba", "ko", "ri", "ten", "mul", "sar", "vel", "ox", "pim", "dra"]
    places = ["".join(r.choice(syll, 4)) for _ in range(60)]
    people = [([f"university of {w} bay"] + ["college of oaks"] * (i % 5 == 0), ["college of elms"] * (i % 3), [int(x) for x in r.integers(50, 5000, int(i % 7 > 0))]) for i, w in enumerate(places)]
    found = [([f"{r.choice(['university', 'universitty', 'uniiversity'])} of {w} bay"] * (i % 6 > 0), int(people[i][2][0] * r.choice([0.1, 0.9])) if people[i][2] and i % 4 else None, 9 if i % 3 else None) for i, w in enumerate(places)]
    found += [([f"{w} college"], int(r.integers(0, 90_000)), 5) for w in places[:28]]
    p, f = hot_tables(spark, people, found, ["".join(r.choice(syll, 5)) for _ in range(150)])
    more = L.name_forms(F.lit("Ann Stonefield-Brook"))
    p = p.withColumn("forms", F.when(F.col("person_id") < 2, F.concat("forms", more)).otherwise(F.col("forms")))
    f = f.withColumn("forms", F.when(F.col("candidate_id") < 2, F.concat("forms", more)).otherwise(F.col("forms")))
    plain, hot = both_ways(monkeypatch, lambda: confidences(p, f))
    assert plain and hot == plain
    plain, hot = both_ways(monkeypatch, lambda: patterns(L.compared_pairs(p, f).collect()))
    assert sum(n for k, (n, _) in hot.items() if k[0] < 1000) == len(people) * len(found) and hot == plain


def plans_of(monkeypatch, module, written):
    """The plans of the tables that ``module`` writes go to ``written``."""
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: (written.append((label, df._jdf.queryExecution().executedPlan().toString())), keep(df, label))[1])


def test_nothing_that_grows_is_broadcast(spark, sf, monkeypatch):
    # Small tables look small enough to the planner everywhere; only sides that were counted may be broadcast, and here none is.
    written = []
    for module in (L, Q):
        plans_of(monkeypatch, module, written)
        monkeypatch.setattr(module, "small_side", lambda df: df)
    Q.p7_found(spark, sf).collect()
    people = [([f"university of place {chr(97 + i)}x"], ["college of elms"], [100 * i]) for i in range(20)]
    p, f = hot_tables(spark, people, [([f"universitty of place {chr(97 + i)}x"], 100 * i, 5) for i in range(20)], ["Oakes"])
    monkeypatch.setattr(L, "HOT_PAIRS", 100)
    best = L.link(p, f)
    best.collect()
    written.append(("best", best._jdf.queryExecution().executedPlan().toString()))
    labels = {label for label, _ in written}
    assert {"linkage-people", "linkage-found", "linkage-names", "linkage-hot", "linkage-hot-names", "linkage-pairs"} <= labels
    assert [label for label, plan in written if "Join" in plan] and not [label for label, plan in written if "Broadcast" in plan]


def test_a_counted_side_is_broadcast_against_a_shuffled_one(spark):
    a, b = spark.range(50).withColumn("x", F.lit(1)), spark.range(30)
    plan = lambda most: shuffled(a).join(small_side(b, most), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(30) and "SortMergeJoin" in plan(29)
