"""Probabilistic record linkage without a shared key.

Several blocking passes bring records with near names together: one deleted letter on either
side, and one first name that begins the other (initials included). Pairs are compared in
levels of agreement on name, institution, citation count and the score of the search that
found the record. Expectation-maximisation over the counts of the level patterns estimates how
often each level occurs among matches and among others; the posterior of a pair, set against
the candidate's other pairs, is its confidence.

Only the pattern counts, whose number does not depend on the data's size, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.names import plain
from tallymark.session import materialize, shuffled, small_side

#: Pairs of one pair of written names beyond which its records are compared in blocks, which give counted level patterns instead of rows of pairs. Results do not depend on it.
HOT_PAIRS = 50_000
#: Most people and candidates, about, of one block.
PEOPLE_BLOCK, FOUND_BLOCK = 200_000, 20_000
NAME_TYPE = "struct<f: string, m: string, l: string, w: int>"


def name_forms(c: Column) -> Column:
    """Forms of a written name as array<struct<f, m, l, w>>: first name, middle names, last name, 1 if whole.

    'Last, First' and a leading surname in capitals are turned round, titles go. A name with a
    double surname has each of its parts as a further form (w = 0). Null or letterless names
    have no form.
    """
    t = F.trim(F.regexp_replace(F.regexp_replace(c, r"(?i)^\s*(?:(?:dr|prof|professor|mr|mrs|ms)\.?\s+)+", ""), r"(?i),?\s+(?:ph\.?\s?d\.?|jr\.?|sr\.?|iii?)\s*$", ""))
    comma = F.when(t.contains(","), F.concat_ws(" ", F.regexp_extract(t, r",(.*)$", 1), F.regexp_extract(t, r"^([^,]*),", 1)))
    capital = r"^((?:[\p{Lu}\p{M}'-]{3,}\s+)+)(.*\p{Ll}.*)$"
    turned = F.coalesce(comma, F.when(t.rlike(capital), F.concat_ws(" ", F.regexp_extract(t, capital, 2), F.regexp_extract(t, capital, 1))), t)
    words = F.filter(F.split(F.trim(F.regexp_replace(F.regexp_replace(plain(turned), r"['’.]", " "), r"[^a-z-]+", " ")), " "), lambda w: w.rlike("[a-z]"))
    last = F.element_at(words, -1)
    first = F.regexp_replace(words[0], "-", "")
    middle = F.concat_ws(" ", F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0))))
    form = lambda l, w: F.struct(first.alias("f"), middle.alias("m"), l.alias("l"), F.lit(w).alias("w"))  # noqa: E731, E741
    whole = F.array(form(F.regexp_replace(last, "-", ""), 1))
    parts = F.transform(F.filter(F.split(last, "-"), lambda p: F.length(p) > 2), lambda p: form(p, 0))
    both = F.when(last.contains("-"), F.concat(whole, parts)).otherwise(whole)
    return F.when(F.size(words) >= 2, both).otherwise(F.array().cast(f"array<{NAME_TYPE}>"))


def institution_parts(c: Column) -> Column:
    """Evened-out names in a free institution text: accents, case, 'the' and abbreviations go."""
    t = F.regexp_replace(plain(c), r"\buniv\b\.?", "university")
    t = F.regexp_replace(t, r"\b(?:universite|universidad|universitat)\b", "university")
    return F.filter(F.transform(F.split(t, "[;,|/]"), lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"[^a-z ]+", " "), r"^\s*the\s+|\s+", " "))), lambda p: F.length(p) > 3)


def _dropped(s: Column) -> Column:
    """The text and all texts with one letter less."""
    return F.array_distinct(F.concat(F.array(s), F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, F.length(s))))))


def _prefixes(s: Column, tag: str, last: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.lit(tag), last, F.lit("|"), F.substring(s, 1, i)))


def blocking_keys(forms: Column, person_side: bool) -> Column:
    """64-bit keys of the blocking passes for all forms of a name."""

    def of(n: Column) -> Column:
        f, l = n["f"], n["l"]  # noqa: E741
        near = F.transform(_dropped(F.concat(f, F.lit("|"), l)), lambda k: F.concat(F.lit("d:"), k))
        own = lambda tag: F.array(F.concat(F.lit(tag), l, F.lit("|"), f))
        short = _prefixes(f, "p:", l) if person_side else own("p:")
        long = own("q:") if person_side else _prefixes(f, "q:", l)
        return F.concat(near, short, long)

    return F.array_distinct(F.transform(F.flatten(F.transform(forms, of)), lambda k: F.xxhash64(k)))


def name_level(a: Column, b: Column) -> Column:
    """Level of agreement of two name forms: 0 to 6."""
    same_f, same_l = a["f"] == b["f"], a["l"] == b["l"]
    one = lambda x, y: F.levenshtein(x, y, 1) >= 0
    swap = F.levenshtein(F.concat(a["f"], F.lit("|"), a["l"]), F.concat(b["f"], F.lit("|"), b["l"]), 2) >= 0
    near = (same_l & one(a["f"], b["f"]) | same_f & one(a["l"], b["l"]) | swap) & (F.length(a["f"]) > 1) & (F.length(b["f"]) > 1)
    begins = same_l & (a["f"].startswith(b["f"]) | b["f"].startswith(a["f"]))
    initial = (F.length(a["f"]) == 1) | (F.length(b["f"]) == 1)
    no_middle = (a["m"] == "") | (b["m"] == "")
    middle = (a["m"] == b["m"]) | a["m"].startswith(F.substring(b["m"], 1, 1)) & ((F.length(a["m"]) == 1) | (F.length(b["m"]) == 1))
    whole = (a["w"] == 1) & (b["w"] == 1)
    clash = ~no_middle & ~middle
    return (
        F.when(same_f & same_l & clash, 1)
        .when(same_f & same_l & whole & ~no_middle, 6)
        .when(same_f & same_l & whole, 5)
        .when(same_f & same_l, 3)
        .when(begins & initial, F.when(clash, 0).otherwise(2))
        .when(begins | near, F.when(clash, 0).when(begins & ~near, 3).otherwise(4))
        .otherwise(0)
    )


def alike_texts(x: Column, y: Column) -> Column:
    return (F.levenshtein(x, y, 2) >= 0) & (F.length(y) > 8)


def inside_texts(x: Column, y: Column) -> Column:
    return (F.length(y) > 5) & x.contains(y) | (F.length(x) > 12) & y.contains(x)


def institution_level(people: Column, doctorate: Column, found: Column) -> Column:
    """3 an appointment's university, 2 the doctorate's or a shortened name, 1 nothing to compare, 0 none of them."""
    alike = lambda xs, ys: F.exists(xs, lambda x: F.exists(ys, lambda y: alike_texts(x, y)))
    inside = lambda xs, ys: F.exists(xs, lambda x: F.exists(ys, lambda y: inside_texts(x, y)))
    both = F.concat(people, doctorate)
    return F.when((F.size(found) == 0) | (F.size(both) == 0), 1).when(alike(people, found), 3).when(alike(doctorate, found) | inside(both, found), 2).otherwise(0)


def count_level(ratios: Column) -> Column:
    """4 as many as on file, 3 near, 2 nothing to compare, 1 far fewer, 0 far more."""
    some = lambda lo, hi: F.exists(ratios, lambda r: (r >= lo) & (r <= hi))
    return F.when(F.size(ratios) == 0, 2).when(some(0.55, 1.15), 4).when(some(0.3, 1.5), 3).when(F.array_max(ratios) < 0.3, 1).otherwise(0)


def report_level(sim: Column) -> Column:
    """Reported similarity of the search: 3 from 0.9, 2 from 0.7, 1 none reported, 0 below."""
    return F.when(sim.isNull() | F.isnan(sim), 1).when(sim >= 0.9, 3).when(sim >= 0.7, 2).otherwise(0)


#: Compared fields with their number of levels.
LEVELS = {"name_level": 7, "inst_level": 4, "count_level": 5, "report_level": 4}


@dataclass
class Model:
    """Share of matches among the pairs, and per field the share of each level among matches and others."""

    prior: float
    m: dict[str, np.ndarray] = field(default_factory=dict)
    u: dict[str, np.ndarray] = field(default_factory=dict)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, prior: float = 0.3) -> Model:
    """Expectation-maximisation over level patterns.

    Starts with levels tilted upwards among matches and downwards among others, so the class
    called match is the agreeing one. One pair's worth of smoothing keeps every share above zero.
    """
    names = list(LEVELS)
    model = Model(prior)
    for k, n in enumerate(LEVELS.values()):
        seen = np.bincount(patterns[:, k], weights=counts, minlength=n) + 1
        up = seen * 2.0 ** np.arange(n)
        down = seen * 2.0 ** -np.arange(n)
        model.m[names[k]], model.u[names[k]] = up / up.sum(), down / down.sum()
    for _ in range(rounds):
        like_m, like_u = np.full(len(counts), model.prior), np.full(len(counts), 1 - model.prior)
        for k, f in enumerate(names):
            like_m, like_u = like_m * model.m[f][patterns[:, k]], like_u * model.u[f][patterns[:, k]]
        post = like_m / (like_m + like_u)
        before = model.prior
        model.prior = float((post * counts).sum() / counts.sum())
        for k, (f, n) in enumerate(LEVELS.items()):
            for table, weight in ((model.m, post * counts), (model.u, (1 - post) * counts)):
                got = np.bincount(patterns[:, k], weights=weight, minlength=n) + 1.0 / n
                table[f] = got / got.sum()
        if abs(model.prior - before) < 1e-9:
            break
    return model


#: Fields of a level pattern as they come from a block, in the order of its codes.
BLOCK_ROW = "candidate_id bigint, name_level int, inst_level int, count_level int, report_level int, n bigint, person_id bigint"


def _padded(lists: pa.ChunkedArray, fill) -> np.ndarray:
    """Lists as a matrix with one column per list, short ones filled up."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    flat = pc.list_flatten(lists).to_numpy()
    out = np.full((len(n), max(int(n.max(initial=0)), 1)), fill)
    out[np.arange(out.shape[1]) < n[:, None]] = flat
    return np.ascontiguousarray(out.T)


def _count_levels(figure: float, shift: float, on_file: np.ndarray) -> np.ndarray:
    """``count_level`` of one figure against the columns of a matrix that NaN fills up."""
    r = (figure + shift) / (on_file + shift)
    least = r >= 0.3
    near, same = (least & (r <= 1.5)).any(0), ((r >= 0.55) & (r <= 1.15)).any(0)
    return np.where(np.isnan(on_file).all(0), 2, np.where(same, 4, np.where(near, 3, np.where(least.any(0), 0, 1))))


def _first(xs: np.ndarray, shift: float, on_file: np.ndarray, bound: float, beyond: bool) -> np.ndarray:
    """Place of the first of the ascending figures ``xs`` whose ratio to each value reaches (or exceeds) ``bound``; NaN gives len(xs)."""
    holds = lambda i: ((xs[i] + shift) / (on_file + shift) > bound) if beyond else ((xs[i] + shift) / (on_file + shift) >= bound)
    at = np.searchsorted(xs, np.nan_to_num(bound * (on_file + shift) - shift, nan=np.inf))
    # The division decides, as it does for a single pair; the guess is at most one place off.
    for _ in range(2):
        at = np.where((at > 0) & holds(np.maximum(at - 1, 0)), at - 1, at)
        at = np.where((at < len(xs)) & ~holds(np.minimum(at, len(xs) - 1)), at + 1, at)
    return np.minimum(at, len(xs))


def _totals(xs: np.ndarray, shift: float, on_file: np.ndarray, kind: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """How many people of each kind agree at each count level with each figure, and the sum of their places: (kind * 5 + level, figure).

    A person's level is a step function of the figure. Its steps are counted as differences
    and summed along the figures, so the work is that of the steps and not of the pairs.
    """
    m = len(xs)
    low, lower, upper, high = (_first(xs, shift, on_file, b, beyond) for b, beyond in ((0.3, False), (0.55, False), (1.15, True), (1.5, True)))
    steps = np.sort(np.concatenate([np.zeros((1, on_file.shape[1]), np.int64), low, lower, upper, high]), axis=0)
    blank = np.isnan(on_file)
    filled = (~blank).any(0)
    size = kinds * 5 * (m + 1)
    n, places = np.zeros(size), np.zeros(size)
    place = np.arange(on_file.shape[1], dtype=float)
    for k in range(len(steps)):
        a, b = steps[k], steps[k + 1] if k + 1 < len(steps) else np.full(on_file.shape[1], m)
        same = ((lower <= a) & (a < upper) & ~blank).any(0)
        near = ((low <= a) & (a < high) & ~blank).any(0)
        under = ((a < low) | blank).all(0)
        level = np.where(filled, np.where(same, 4, np.where(near, 3, np.where(under, 1, 0))), 2)
        row = (kind * 5 + level) * (m + 1)
        for at, sign in ((a, 1.0), (b, -1.0)):
            some = a < b
            n += sign * np.bincount((row + at)[some], minlength=size)
            places += sign * np.bincount((row + at)[some], weights=place[some], minlength=size)
    return tuple(x.reshape(kinds * 5, m + 1).cumsum(1) for x in (n, places))


def _postings(lists: pa.ChunkedArray) -> dict[int, np.ndarray]:
    """Places of the rows whose list holds each code."""
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    codes = pc.list_flatten(lists).to_numpy()
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else []
    return {int(codes[a]): owner[a:b] for a, b in zip(cuts, [*cuts[1:], len(codes)])}


def _block(left: pa.Table, right: pa.Table) -> pa.Table:
    """Every candidate of a block against every person: one row per candidate and level pattern with the number of people, and the person if it is one.

    People whose institutions say nothing about a candidate are counted by tables of step
    functions; only those who share an institution with it are looked at one by one.
    """
    ids, names = left["person_id"].to_numpy(), left["name_level"].to_numpy().astype(np.int64)
    bare = (pc.fill_null(pc.list_value_length(left["insts"]), 0).to_numpy() + pc.fill_null(pc.list_value_length(left["doctorate"]), 0).to_numpy()) == 0
    kind = names * 2 + bare
    held = {"count": (_padded(left["counts"].cast(pa.list_(pa.float64())), np.nan), 1.0), "h_index": (_padded(left["indexes"].cast(pa.list_(pa.float64())), np.nan), 0.5)}
    homes, schools = _postings(left["insts"]), _postings(left["doctorate"])
    rows = right.sort_by("evidence").to_pylist()
    figure = lambda c: "count" if c["count"] is not None else "h_index" if c["h_index"] is not None else None
    tables = {}
    for f, (on_file, shift) in held.items():
        xs = np.unique(np.array([float(c[f]) for c in rows if figure(c) == f]))
        if len(xs):
            tables[f] = (xs, *_totals(xs, shift, on_file, kind, 14))
    flat = np.zeros((14, 5))
    flat[:, 2] = np.bincount(kind, minlength=14)
    flat_places = np.zeros((14, 5))
    flat_places[:, 2] = np.bincount(kind, weights=np.arange(len(ids)), minlength=14)
    none = np.empty(0, np.int64)
    union = lambda posted, codes: np.unique(np.concatenate([posted.get(x, none) for x in codes] or [none]))
    out: dict[str, list] = {c: [] for c in ("candidate_id", "code", "report_level", "n", "person_id")}
    last = home = other = None
    for c in rows:
        if c["evidence"] != last:
            last = c["evidence"]
            home = union(homes, c["alike"])
            other = np.setdiff1d(np.unique(np.concatenate([union(schools, c["alike"]), union(homes, c["inside"]), union(schools, c["inside"])])), home)
        f = figure(c)
        if f is None:
            n, places = flat, flat_places
        else:
            xs, all_n, all_places = tables[f]
            i = np.searchsorted(xs, float(c[f]))
            n, places = all_n[:, i].reshape(14, 5), all_places[:, i].reshape(14, 5)
        # (name level, institution level, count level): without anything to compare the institution level is 1, else 0 unless shared.
        whole, whole_places = np.zeros((7, 4, 5)), np.zeros((7, 4, 5))
        whole[:, 1], whole_places[:, 1] = n[1::2], places[1::2]
        plain_at = 1 if c["bare"] else 0
        whole[:, plain_at] += n[0::2]
        whole_places[:, plain_at] += places[0::2]
        for level, some in ((3, home), (2, other)):
            if len(some) and not c["bare"]:
                steps = np.full(len(some), 2) if f is None else _count_levels(float(c[f]), held[f][1], held[f][0][:, some])
                np.add.at(whole, (names[some], level, steps), 1)
                np.add.at(whole, (names[some], 0, steps), -1)
                np.add.at(whole_places, (names[some], level, steps), some)
                np.add.at(whole_places, (names[some], 0, steps), -some)
        seen = np.flatnonzero(np.rint(whole.ravel()))
        found = np.rint(whole.ravel()[seen]).astype(np.int64)
        at = np.rint(whole_places.ravel()[seen]).astype(np.int64)
        out["candidate_id"] += [c["candidate_id"]] * len(seen)
        out["report_level"] += [c["report_level"]] * len(seen)
        out["code"] += seen.tolist()
        out["n"] += found.tolist()
        out["person_id"] += [int(ids[p]) if k == 1 else None for k, p in zip(found.tolist(), at.tolist())]
    code = np.array(out["code"], np.int64)
    whole = lambda c: pa.array(out[c], pa.int64())
    small = lambda x: pa.array(x, pa.int32())
    columns = [whole("candidate_id"), small(code // 20), small(code // 5 % 4), small(code % 5), small(out["report_level"]), whole("n"), whole("person_id")]
    return pa.table(columns, names=[x.split()[0] for x in BLOCK_ROW.split(", ")])


def _near_texts(ys: DataFrame, xs: DataFrame) -> DataFrame:
    """(y, x) of texts that may be within two edits or one inside the other: every pair that is, and some more.

    A text inside another shares all its six-letter pieces with it, so it meets it through its
    rarest one. Of a text within two edits, one third stands unchanged in the other, at most two
    letters aside.
    """
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 5), lambda i: F.substring(c, i, 6)))

    def within(inner: DataFrame, a: str, outer: DataFrame, b: str, least: int) -> DataFrame:
        pieces = outer.where(F.length(b) > 5).select(b, F.explode(grams(F.col(b))).alias("g"))
        often = pieces.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        own = inner.where(F.length(a) > least).select(a, F.explode(grams(F.col(a))).alias("g"))
        rarest = own.join(shuffled(often), "g", "left").groupBy(a).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("r")).where("r.n > 0").select(a, F.col("r.g").alias("g"))
        return rarest.join(shuffled(pieces), "g").select("y", "x")

    def thirds(c, length, shift):
        at = lambda k: F.floor(length * k / 3).cast("int")
        return F.array(*[F.concat_ws("|", length.cast("string"), F.lit(str(k)), F.substring(c, F.greatest(at(k) + 1 + shift, F.lit(1)), at(k + 1) - at(k))) for k in range(3)])

    part_y = ys.where(F.length("y") > 8).select("y", F.explode(thirds(F.col("y"), F.length("y"), F.lit(0))).alias("k"))
    # Two rows of steps and one expression: a text once for each other length and each shift, which keeps the generated code small.
    steps = F.sequence(F.lit(-2), F.lit(2))
    moved = xs.where(F.length("x") > 6).select("x", F.explode(steps).alias("d")).select("x", "d", F.explode(steps).alias("e"))
    part_x = moved.select("x", F.explode(thirds(F.col("x"), F.length("x") + F.col("d"), F.col("e"))).alias("k")).distinct()
    pairs = part_y.join(shuffled(part_x), "k").select("y", "x")
    return pairs.unionByName(within(ys, "y", xs, "x", 5)).unionByName(within(xs, "x", ys, "y", 12)).distinct()


def _hot_patterns(people: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """Counted level patterns of all pairs of people and candidates whose sets of forms ``groups`` (gp, gc) pairs.

    Levels of names are found once per pair of sets of forms, agreement of institutions once
    per pair of near texts; blocks of people and candidates then meet in Arrow tables, so no
    pair becomes a row.
    """
    p_groups = people.groupBy("gp").agg(F.first("forms").alias("pf"), F.count(F.lit(1)).alias("n_p"))
    c_groups = found.groupBy("gc").agg(F.first("forms").alias("cf"), F.count(F.lit(1)).alias("n_c"))
    levels = F.array_max(F.flatten(F.transform("pf", lambda a: F.transform(F.col("cf"), lambda b: name_level(a, b)))))
    named = materialize(groups.join(shuffled(p_groups), "gp").join(shuffled(c_groups), "gc").select("gp", "gc", levels.alias("name_level"), "n_p", "n_c"), "linkage-hot-names")
    blocks = small_side(named.groupBy("gc").agg(F.ceil(F.sum("n_p") / PEOPLE_BLOCK).alias("bp"), F.ceil(F.first("n_c") / FOUND_BLOCK).alias("bc")))
    people = shuffled(people).join(small_side(named.select("gp").distinct()), "gp", "left_semi")
    found = shuffled(found).join(blocks, "gc")
    xs = materialize(people.select(F.explode(F.concat("insts", "doctorate")).alias("x")).distinct(), "linkage-homes")
    ys = materialize(found.select(F.explode("insts").alias("y")).distinct(), "linkage-texts")
    alike, inside = alike_texts(F.col("x"), F.col("y")), inside_texts(F.col("x"), F.col("y"))
    code = lambda c: F.xxhash64(c)
    met = _near_texts(ys, xs).where(alike | inside).groupBy("y").agg(F.collect_set(F.when(alike, code("x"))).alias("alike"), F.collect_set(F.when(inside, code("x"))).alias("inside"))
    texts = found.select("insts").distinct().select("insts", F.explode("insts").alias("y")).join(shuffled(met), "y").groupBy("insts")
    texts = texts.agg(F.flatten(F.collect_list("alike")).alias("alike"), F.flatten(F.collect_list("inside")).alias("inside"))
    none = lambda c: F.coalesce(F.col(c), F.array().cast("array<bigint>")).alias(c)
    codes = lambda c: F.transform(c, code).alias(c)
    left = shuffled(shuffled(people).join(small_side(named.select("gp", "gc", "name_level")), "gp")).join(blocks, "gc").select(
        "gc", F.pmod(F.xxhash64("person_id"), F.col("bp")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("bc") - 1)).alias("j"), "person_id", "name_level", codes("insts"), codes("doctorate"), "counts", "indexes"
    )
    right = found.join(shuffled(texts), "insts", "left").select(
        "gc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bp") - 1)).alias("i"), F.pmod(F.xxhash64("candidate_id"), F.col("bc")).alias("j"),
        "candidate_id", (F.size("insts") == 0).alias("bare"), F.xxhash64("insts").alias("evidence"), none("alike"), none("inside"), "count", "h_index", report_level(F.col("reported")).alias("report_level"),
    )
    # A set number of partitions, since small blocks take long.
    spread = lambda df: df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * df.sparkSession.sparkContext.defaultParallelism), "gc", "i", "j").groupBy("gc", "i", "j")
    rows = spread(left).cogroup(spread(right)).applyInArrow(_block, BLOCK_ROW)
    rows = rows.groupBy("candidate_id", *LEVELS).agg(F.sum("n").alias("n"), F.max("person_id").alias("person_id"))
    return rows.withColumn("person_id", F.when(F.col("n") == 1, F.col("person_id")))


def compared_pairs(people: DataFrame, found: DataFrame) -> DataFrame:
    """Blocked pairs with their levels: person_id, candidate_id, the levels and n.

    ``people``: person_id, forms, insts, doctorate (arrays), counts (array of citation counts
    by source), indexes (array of h-indexes). ``found``: candidate_id, forms, insts, count,
    h_index, reported. Every array may be empty, every other value null.

    The passes pair distinct written names, however many records share one; records then meet
    through their names. Where two names would give more than HOT_PAIRS pairs, a candidate's
    people that agree with it alike are one row with their number n, and their person_id only
    where they are one. Other rows are one pair, n = 1. Every blocked pair counts in exactly one row.
    """
    # Only the named columns travel, so other columns of the tables cannot clash.
    people = people.select("person_id", "forms", "insts", "doctorate", "counts", "indexes").withColumn("gp", F.xxhash64(F.sort_array("forms")))
    found = found.select("candidate_id", "forms", "insts", "count", "h_index", "reported").withColumn("gc", F.xxhash64(F.sort_array("forms")))
    name = lambda f: F.xxhash64(f["f"], f["l"])
    of_p = people.select("person_id", "gp", F.explode("forms").alias("x")).select("person_id", "gp", "x", name(F.col("x")).alias("p")).dropDuplicates(["person_id", "p"])
    of_c = found.select("candidate_id", "gc", F.explode("forms").alias("x")).select("candidate_id", "gc", "x", name(F.col("x")).alias("c")).dropDuplicates(["candidate_id", "c"])
    names = lambda df, n: df.groupBy(n).agg(F.first("x").alias("x"), F.count(F.lit(1)).alias(f"n_{n}"))
    left = names(of_p, "p").select("p", "n_p", F.explode(blocking_keys(F.array("x"), True)).alias("k"))
    right = names(of_c, "c").select("c", "n_c", F.explode(blocking_keys(F.array("x"), False)).alias("k"))
    alike = materialize(left.join(shuffled(right), "k").select("p", "c", "n_p", "n_c").distinct(), "linkage-names")
    few = F.col("n_p") * F.col("n_c") <= HOT_PAIRS
    hot = alike.where(~few).select("p", "c")
    some_hot = not hot.isEmpty()
    groups = ["gp", "gc"] if some_hot else []
    pairs = of_p.select("person_id", "p", "gp").join(shuffled(alike.where(few).select("p", "c")), "p").join(shuffled(of_c.select("candidate_id", "c", "gc")), "c").select("person_id", "candidate_id", *groups)
    if some_hot:
        hot = shuffled(of_p.select("gp", "p").distinct()).join(small_side(hot), "p").join(shuffled(of_c.select("gc", "c").distinct()), "c").select("gp", "gc").distinct()
        hot = materialize(hot, "linkage-hot")
        # A pair that also meets through a rarer name counts in its block alone.
        pairs = shuffled(pairs).join(small_side(hot), ["gp", "gc"], "left_anti").select("person_id", "candidate_id")
    pairs = pairs.distinct()
    both = pairs.join(shuffled(people.drop("gp").withColumnsRenamed({"forms": "pf", "insts": "pi"})), "person_id")
    both = both.join(shuffled(found.drop("gc").withColumnsRenamed({"forms": "cf", "insts": "ci"})), "candidate_id")
    levels = F.array_max(F.flatten(F.transform("pf", lambda a: F.transform(F.col("cf"), lambda b: name_level(a, b)))))
    ratios = F.when(F.col("count").isNotNull(), F.transform("counts", lambda x: (F.col("count") + 1.0) / (x + 1.0))).otherwise(
        F.when(F.col("h_index").isNotNull(), F.transform("indexes", lambda x: (F.col("h_index") + 0.5) / (x + 0.5))).otherwise(F.array().cast("array<double>"))
    )
    rows = both.select(
        "person_id",
        "candidate_id",
        levels.alias("name_level"),
        institution_level(F.col("pi"), F.col("doctorate"), F.col("ci")).alias("inst_level"),
        count_level(ratios).alias("count_level"),
        report_level(F.col("reported")).alias("report_level"),
        F.lit(1).cast("long").alias("n"),
    )
    return rows.unionByName(_hot_patterns(people, found, hot)) if some_hot else rows


def link(people: DataFrame, found: DataFrame, threshold: float = 0.5) -> DataFrame:
    """At most one person per candidate: person_id, candidate_id, the levels and confidence.

    Confidence is the posterior odds of the pair against those of the candidate's other pairs
    and of no match. A tie between two people leaves both below one half, so no match; a
    ``threshold`` below one half would allow several people and is an error. Empty tables give
    an empty result.
    """
    if threshold < 0.5:
        raise ValueError("a threshold below one half would match a candidate with several people")
    pairs = materialize(compared_pairs(people, found), "linkage-pairs")
    # A candidate weighs one in all, however many pairs it has, so one very common name cannot set the model.
    share = F.col("c") / F.sum("c").over(Window.partitionBy("candidate_id"))
    weights = pairs.groupBy("candidate_id", *LEVELS).agg(F.sum("n").alias("c")).withColumn("share", share)
    rows = weights.groupBy(*LEVELS).agg(F.sum("share").alias("count")).orderBy(*LEVELS).collect()  # at most the product of the level counts
    if not rows:
        return pairs.drop("n").withColumn("confidence", F.lit(0.0))
    model = fit(np.array([[r[f] for f in LEVELS] for r in rows]), np.array([r["count"] for r in rows], float))
    odds = F.lit(model.prior / (1 - model.prior))
    for f in LEVELS:
        odds = odds * F.get(F.array(*[F.lit(float(x)) for x in model.m[f] / model.u[f]]), F.col(f))
    # Partial sums by candidate fold before the shuffle; only pairs with some weight of their own are ranked.
    scored = pairs.withColumn("odds", odds)
    total = scored.groupBy("candidate_id").agg(F.sum(F.col("n") * F.col("odds")).alias("all_odds"))
    # No pair reaches the threshold whose odds do not: a bound that loses nothing.
    best = scored.where((F.col("n") == 1) & (F.col("odds") >= 0.999 * threshold / (1 - threshold + 1e-12))).join(shuffled(total), "candidate_id").withColumn("confidence", F.col("odds") / (1 + F.col("all_odds")))
    # At most one person of a candidate gets half of its odds.
    return best.where((F.col("confidence") >= threshold) & (F.col("confidence") > 0.5 - 1e-12)).select("person_id", "candidate_id", *LEVELS, "confidence")
