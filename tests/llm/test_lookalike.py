from tallymark.llm.lookalike import RULES, lookalike_classes, lookalike_pairs, unified

SAME = [
    ["Office cafe", "Office cаfe", "Ｏｆｆｉｃｅ cafe", "Office cafe", "Offi​ce cafe", "Oﬃce cafe", "Ofﬁce cafe", "﻿Office cafe", "Off­ice cafe"],
    ["café", "café", "cаfé", "саfе́"],
    ["Привет", "Привeт"],
    ["well-known", "well‐known", "well‑known"],
    ["ё", "ё", "ë"],
    ["ό", "ó", "ó"],
    ["ạ̇", "ạ̇"],
    ["room １２", "room 12", "room 12"],
    ["x" * 30000 + "a", "x" * 30000 + "а"],
    # Joiners, selectors and tags that show nothing where they stand; forms drawn just like others.
    ["zero width", "zero\u200d wid\u200cth", "zero\u2060 wi\ufe0fdth", "\u200ezero width\u200f", "zero wid\U000e0061th", "zero\u2800width", "ze\U0001d5cbo width", "zero wi\u0501th"],
    ["King IV", "King \u2163", "Kin\u0261 IV".replace("\u0261", "g\u200b")],
    ["dž", "\u01c6"],
]
# Visible differences made by characters of the same kinds.
SEEN = [
    "\U0001f468\u200d\U0001f469\u200d\U0001f466", "\U0001f468\U0001f469\U0001f466",  # a joined family and its members
    "\U0001f3f4\U000e0067\U000e0062\U000e0073\U000e0063\U000e0074\U000e007f", "\U0001f3f4",  # a flag spelt with tags and a plain one
    "\u0645\u06cc\u200c\u062e\u0648\u0627\u0647\u0645", "\u0645\u06cc\u062e\u0648\u0627\u0647\u0645",  # a non-joiner that changes letter shapes
    "\u0600\u0661", "\u0661",  # a visible number sign
    "\u0915\u094d\u200d\u0937", "\u0915\u094d\u0937",  # a joiner that keeps letters apart
    "\u2764\ufe0f", "\u2764", "\U0001d400", "A", "A\u202eB", "AB",
]
APART = ["x2", "x²", "1/2", "½", "cafe", "CAFE", "Cafe", "и", "й", "a b", "a  b", "a\nb", "resume", "résumé", "", " ", "o", "0", "l", "1", "ß", "ss", "æ", "ae", "…", "..."]


def frame(spark, texts):
    rows = list(enumerate(texts))
    return spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as _id", "'c' as _c", "2 as class_id")


def test_pairs(spark):
    texts, want, n = [], set(), 0
    for group in SAME:
        ids = range(n, n + len(group))
        want |= {(a, b) for a in ids for b in ids if a < b}
        texts += group
        n += len(group)
    texts += APART + SEEN + [None, None]
    got = {tuple(x) for x in lookalike_pairs(frame(spark, texts), "doc_id", "text").collect()}
    assert got == want, [(texts[a], texts[b]) for a, b in got ^ want]


def test_copies_and_forms(spark):
    texts = ["cаfe", "cafe", "cafe", "cаfe", "alone", "alone", None, "tea​", "tеa"]
    df = frame(spark, texts)
    members = {x.doc_id: (x.class_id, x.canonical_id) for x in lookalike_classes(df, "doc_id", "text")[0].collect()}
    assert members == {0: (0, 1), 1: (0, 1), 2: (0, 1), 3: (0, 1), 4: (4, 4), 5: (4, 4), 7: (7, 7), 8: (7, 7)}
    out = {x.doc_id: (x.text, x.is_changed) for x in unified(df, "doc_id", "text").collect()}
    assert out[0] == ("cafe", True) and out[1] == ("cafe", False) and out[5] == ("alone", False) and out[6] == (None, False) and out[8] == ("tea​", True)
    # Copies of one string are no pair of each other.
    assert {tuple(x) for x in lookalike_pairs(df, "doc_id", "text").collect()} == {(0, 1), (0, 2), (1, 3), (2, 3), (7, 8)}
    assert lookalike_pairs(df.limit(0), "doc_id", "text").count() == 0 and unified(df.limit(0), "doc_id", "text").count() == 0


def test_rules_keep_looks():
    assert RULES["Ａ"] == "A" and RULES["ё"] == "ë" and RULES["　"] == " " and "²" not in RULES and "½" not in RULES
