import json
import random

from tallymark.operators.shred import ChildTable, Node, leaves, payloads, reconstruct, shred

NODES = (
    Node("tags", repeated=True),
    Node("years", repeated=True, keyed=True, children=(Node("year"), Node("n"))),
    Node("places", repeated=True, children=(Node("id"), Node("line", repeated=True))),
)
TABLES = (
    ChildTable("tag", "tags[]"),
    ChildTable("year", "years[]/year", "years[]/n"),
    ChildTable("year", "years{}/key", "years{}/value"),
    ChildTable("place", "places[]/id"),
    ChildTable("line", "places[]/line[]"),
)


def as_list(v):
    return [] if v is None else v if isinstance(v, list) else [v]


def naive(rid, obj):
    out = []
    for i, t in enumerate(as_list(obj.get("tags"))):
        if t is not None:
            out.append((rid, "tag", i, -1, t, None))
    y = obj.get("years")
    if isinstance(y, dict):
        out += [(rid, "year", -1, -1, k, None if v is None else str(v)) for k, v in y.items()]
    else:
        out += [(rid, "year", i, -1, str(e["year"]), str(e["n"])) for i, e in enumerate(as_list(y)) if e is not None]
    for i, p in enumerate(as_list(obj.get("places"))):
        if p is None:
            continue
        out.append((rid, "place", i, -1, p.get("id"), None))
        out += [(rid, "line", i, j, x, None) for j, x in enumerate(as_list(p.get("line"))) if x is not None]
    return out


def random_record(r):
    tag = lambda: r.choice([None, "", "a", "é", "x" * 2000])
    obj = {}
    if r.random() < 0.8:
        obj["tags"] = r.choice([None, [], [tag() for _ in range(r.randint(1, 4))], "one"])
    if r.random() < 0.8:
        obj["years"] = r.choice([None, {}, {"2020": 1, "2021": None}, [{"year": 2019, "n": 2}, None, {"year": "2020", "n": 3}], {"year": 1} and []])
    if r.random() < 0.8:
        place = lambda: r.choice([None, {"id": "p"}, {"id": "q", "line": None}, {"id": "r", "line": "l"}, {"id": "s", "line": ["l", None, "m"]}, {"id": "t", "line": []}])
        obj["places"] = r.choice([None, [], [place() for _ in range(r.randint(1, 4))], {"id": "u", "line": ["z"]}])
    return obj


def test_shred_and_reconstruct_match_a_walk(spark):
    r = random.Random(3)
    objs = [random_record(r) for _ in range(400)]
    rows = [(i, json.dumps(o)) for i, o in enumerate(objs)]
    df = spark.createDataFrame(rows, "id bigint, raw string").repartition(5)
    got = [tuple(x) for x in reconstruct(shred(df, "id", "raw", NODES), "id", NODES, TABLES).drop("payload_no").collect()]
    want = [x for i, o in enumerate(objs) for x in naive(i, o)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_wrapped_invalid_and_empty(spark):
    good = {"tags": ["a"]}
    rows = [(1, None), (2, ""), (3, "{bad"), (4, json.dumps(json.dumps(good))), (5, json.dumps({"fetched": "x", "payload": good})), (6, "[]"), (7, "null"), (8, '"text"'), (9, json.dumps([good, good])), (10, json.dumps({"other": 1})), (11, '{"tags": ["\\ud800"]}')]
    df = spark.createDataFrame(rows, "id bigint, raw string").selectExpr("id", "raw", "1 as d", "'x' as v", "'y' as child_key")
    got = sorted((x.id, x.payload_no, x.child_key) for x in reconstruct(shred(df, "id", "raw", NODES), "id", NODES, TABLES).collect())
    # Two payloads of one text are told apart by their number.
    assert got == [(4, 0, "a"), (5, 0, "a"), (9, 0, "a"), (9, 1, "a"), (11, 0, "?")]
    assert reconstruct(shred(df.limit(0), "id", "raw", NODES), "id", NODES, TABLES).count() == 0


def test_levels_of_a_record(spark):
    df = spark.createDataFrame([(1, json.dumps({"places": [{"id": "a", "line": ["x", None]}, None, {"id": "b"}]}))], "id bigint, raw string")
    row = shred(df, "id", "raw", NODES).first()
    col = row["places[]/line[]"]
    assert list(col.v) == ["x", None, None, None] and list(col.r) == [0, 2, 1, 1] and list(col.d) == [6, 5, 2, 3]
    assert {x.path: x.max_rep for x in leaves(NODES)}["places[]/line[]"] == 2
    assert list(payloads({"a": {"b": [{"tags": 1}]}}, frozenset({"tags"}))) == [{"tags": 1}]
