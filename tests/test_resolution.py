import random

from tallymark.operators import audit as A
from tallymark.operators import resolve as R


def test_name_similarity(spark):
    rows = [(1, "Ann Lee", "Ann", "Lee", ["Ann Lee"]), (2, "Ann Lee", "Ann", "Lee", ["A. Lee"]), (3, "Ann Lee", "Ann", "Lee", ["Ann Roe"]), (4, "Ann Lee", "Ann", "Lee", []), (5, "Ann Lee", "Ann", "Lee", None), (6, None, None, None, ["Ann"]), (1, "Ann Lee", "Ann", "Lee", ["Ann Lee"])]
    df = spark.createDataFrame(rows, "id int, full string, f string, l string, vs array<string>")
    got = sorted((r.id, r.similarity) for r in R.name_similarity(df, "full", "f", "l", "vs").collect())
    assert got[:3] == [(1, 1.0), (1, 1.0), (2, 0.92)] and got[3][1] <= 0.6 and got[4][1] == got[5][1] == 0.0 and got[6][1] <= 0.6


def test_decide(spark):
    rows = [
        (1, 1, 0.92, 0.95, 1.0, 80, 900), (1, 2, 0.80, 0.9, 1.0, 2, 3),
        (2, 1, 0.92, 0.95, 1.0, 80, 900), (2, 2, 0.87, 0.9, 1.0, 40, 300),
        (3, 1, 0.92, 0.95, 1.0, 2, 3), (4, 1, 0.92, 0.95, 0.0, 80, 900), (5, 1, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "p int, ord int, score double, name_sim double, inst_match double, works_count int, cited_by_count int")
    got = {r.p: r.decision for r in R.decide(R.top_candidates(df, "p", "score", "ord"), "p").collect()}
    assert got == {1: "accepted", 2: "pending", 3: "pending", 4: "pending", 5: "pending"}
    veto = spark.createDataFrame([(1, 1)], "p int, ord int")
    assert R.top_candidates(df, "p", "score", "ord", vetoed=veto).where("p = 1").first().ord == 2


def test_primary_and_labels(spark):
    df = spark.createDataFrame([(1, "a", 1, 2, 900), (1, "b", 2, 40, 100), (1, "c", 3, 40, 50), (1, "d", 4, None, None)], "p int, id string, o int, works_count int, cited_by_count int")
    assert R.primary_record(df, "p", "id", "o").first().primary_id == "b"
    texts = spark.createDataFrame([(1, "Dept. of Planning, University of Alder Bay"), (2, "Alder University"), (3, "Bay of Alder"), (4, None), (5, "UCLX campus")], "t int, txt string")
    labels = spark.createDataFrame([(1, "University of Alder Bay"), (2, "UCLX"), (3, "University of the State"), (4, None)], "l int, lab string")
    got = sorted(tuple(r) for r in R.label_hits(texts, "t", "txt", labels, "l", "lab").collect())
    assert got == [(1, 1), (3, 1), (5, 2)]


def test_known_people(spark):
    people = spark.createDataFrame([(1, "Ann", "Lee"), (2, "Bob", "Lee"), (3, "Ann", "Roe"), (4, "Ann", "Lee")], "person_id bigint, first_name string, last_name string")
    names = spark.createDataFrame([(1, "Ann M. Lee"), (2, "A. Lee"), (3, "Cat Lee"), (4, "Ann Poe"), (5, None)], "i int, n string")
    got = {r.i: (r.person_id, r.agreement) for r in R.known_people(names, "i", "n", people).collect()}
    assert got == {1: (1, 1.0), 2: (1, 0.9)}


def brute_settle(rows):
    taken, state = [], {}
    for p, o, ns, im, c, w, base, held, has, ok, ts in sorted(rows, key=lambda r: (r[0], r[1])):
        total, record = state.get(p, (float(held), has))
        take = False
        if (ns or 0) >= 0.95 and (im or 0) >= 1:
            if (w or 0) <= 3:
                take = True
            elif base is not None and base >= 25 and c is not None:
                take = (ok is not False or (ts or 0) >= 0.5) and (total + c) / base <= 1.2 if record else c / base <= 1.5
        if take:
            taken.append((p, o))
            if c is not None:
                total, record = total + c, True
        state[p] = (total, record)
    return taken


def test_settle_equals_a_loop(spark):
    r = random.Random(2)
    people = {p: (r.choice([None, 10, 100, 1000]), r.choice([0, 50]), ) for p in range(40)}
    rows = []
    for o in range(400):
        p = r.randrange(40)
        base, held = people[p]
        rows.append((p, o, r.choice([None, 0.9, 0.96, 1.0]), r.choice([0.5, 1.0, 1.0]), r.choice([None, 0, 20, 60, 120, 900]), r.choice([None, 1, 8, 90]), base, held, held > 0, r.choice([None, True, False]), r.choice([None, 0.2, 0.7])))
    df = spark.createDataFrame(rows, "p int, o bigint, name_sim double, inst_match double, cited_by_count int, works_count int, base int, held int, has_record boolean, last_inst_ok boolean, topic_share double")
    assert sorted(tuple(x) for x in A.settle(df, "p", "o").collect()) == sorted(brute_settle(rows))


def test_implausible(spark):
    df = spark.createDataFrame([(3000, 1000), (3001, 1000), (40, 1000), (9999, 24), (None, 1000), (5, None)], "a int, b int")
    from pyspark.sql import functions as F

    assert [x.r for x in df.select(A.implausible(F.col("a"), F.col("b")).alias("r")).collect()] == [None, 3.001, 0.04, None, None, None]
