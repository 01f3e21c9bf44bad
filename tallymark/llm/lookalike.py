"""One form for texts that look the same but differ in their characters.

Look-alike letters, full-width forms, spaces, hyphens and characters that show nothing are
mapped in the JVM; a joiner, variation selector or tag that changes what is drawn stays, as do
bold, slanted, raised and circled forms; composed and combining accents are left to Unicode collation, which is sensitive to
accents and case and so keeps apart whatever a reader can tell apart. Texts are grouped under
that collation in SQL, each class takes a canonical member, and the class is joined back.

Most texts have no such twin. A coarse hash that is equal for all texts of a class finds the
few texts with one, so only their characters are compared and moved.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.session import materialize, small_side, spread_join

# Letters of other scripts drawn like Latin ones (public confusable-character data), those that differ only in a detail left out.
CYRILLIC = ("АВЕЅІЈКМНОРСТХҮӀԚԜаеорсухіѕјһԁԛԝ", "ABESIJKMHOPCTXYIQWaeopcyxisjhdqw")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿοϲϳ", "ABEZHIKMNOPTYXCJocj")
ARMENIAN = ("Օօհ", "Ooh")
LISU = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
HYPHENS = "‐‑"
# Characters that canonical equivalence sends to ASCII, and blanks drawn like a space.
SINGLETONS = {";": ";", "`": "`", "K": "K"}
SPACES = [0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x2800, 0x3000, 0x3164, 0xFFA0]
#: Characters made of others that are drawn just like them: Latin ligatures and digraphs, Roman numerals, plain sans-serif and monospace letters and digits.
COMPOUNDS = [range(0xFB00, 0xFB05), range(0x132, 0x134), range(0x1C4, 0x1CD), range(0x1F1, 0x1F4), range(0x2160, 0x2180), range(0x1D5A0, 0x1D5D4), range(0x1D670, 0x1D6A4), range(0x1D7E2, 0x1D7EC), range(0x1D7F6, 0x1D800)]

# Characters that show nothing wherever they stand: controls but tab and line ends, soft hyphen, zero-width and word-joining
# marks, marks of direction but the one that turns letters round, invisible operators, fillers inside syllables.
_ALWAYS = "[\\x00-\\x08\\x0E-\\x1F\\x7F-\\x84\\x86-\\x9F\\xAD\\x{34F}\\x{61C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180E}\\x{200B}\\x{200E}\\x{200F}\\x{202A}-\\x{202D}\\x{2060}-\\x{206F}\\x{FEFF}\\x{E0001}]"
# The flag stands written out in each look-behind, because only then does the engine step back over whole characters beyond U+FFFF.
# Joiners show nothing but after a letter of a script whose letters they shape, or inside a sequence of symbols.
_JOINER = "(?<![🏴\\p{So}\\p{Sk}\\x{FE0F}\\x{E007F}[\\p{L}\\p{M}&&[^\\p{IsLatin}\\p{IsGreek}\\p{IsCyrillic}\\p{IsArmenian}\\p{IsGeorgian}\\p{IsHebrew}\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsHangul}\\p{IsInherited}\\p{IsCommon}]]])[\\x{200C}\\x{200D}]"
# Variation selectors choose a shape only for symbols, keycaps, ideographs and the scripts that have variants; tags only spell out a flag.
_VARIANT = "(?<![🏴\\p{So}\\p{Sm}\\p{IsHan}\\p{IsMongolian}\\p{IsMyanmar}0-9#*])[\\x{FE00}-\\x{FE0F}\\x{180B}-\\x{180D}\\x{180F}\\x{E0100}-\\x{E01EF}]"
_TAGS = "(?<![🏴\\x{E0020}-\\x{E007F}])[\\x{E0020}-\\x{E007F}]+"
#: Where they stay, these characters are seen, but collation gives most of them no weight; for comparison each stands for itself as a private character.
_SEEN = [0x200C, 0x200D, 0x202E, *range(0x600, 0x606), 0x6DD, 0x70F, 0x8E2, *range(0xFFF9, 0xFFFC), *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0020, 0xE0080), *range(0xE0100, 0xE01F0)]
WEIGHED = ("".join(map(chr, _SEEN)), "".join(chr(0x10E000 + i) for i in range(len(_SEEN))))
INVISIBLE = "|".join([_ALWAYS, _JOINER, _VARIANT, _TAGS])
#: The characters that the last three patterns may take away.
_CONDITIONAL = "[\\x{180B}-\\x{180D}\\x{180F}\\x{200C}\\x{200D}\\x{FE00}-\\x{FE0F}\\x{E0020}-\\x{E007F}\\x{E0100}-\\x{E01EF}]"
#: Plain ASCII text.
PLAIN = r"[\x09-\x0D\x20-\x7E]+"


def _rule_table() -> dict[str, str]:
    """Single-character map: the fixed look-alikes, their accented forms, full-width forms and spaces, all by rule."""
    base = {**{a: b for pair in (CYRILLIC, GREEK, ARMENIAN, LISU) for a, b in zip(*pair)}, **dict.fromkeys(HYPHENS, "-"), **SINGLETONS}
    out = dict(base)
    for code in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0] in base:
            whole = unicodedata.normalize("NFC", base[parts[0]] + parts[1:])
            if len(whole) == 1:
                out[chr(code)] = whole
    for code in range(0xFF01, 0xFF5F):
        out[chr(code)] = chr(code - 0xFEE0)
    for code in SPACES:
        out[chr(code)] = " "
    for chars in COMPOUNDS:
        for code in chars:
            whole = unicodedata.normalize("NFKC", chr(code))
            if len(whole) == 1:
                out[chr(code)] = whole
    return out


RULES = _rule_table()
#: Characters drawn like several others: compounds, and accented look-alikes without a single composed form. Applied before the single-character map.
SEVERAL = {chr(code): whole for chars in COMPOUNDS for code in chars if len(whole := unicodedata.normalize("NFKC", chr(code))) > 1}
SEVERAL |= {
    chr(code): unicodedata.normalize("NFC", RULES[p[0]] + p[1:])
    for code in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]
    if len(p := unicodedata.normalize("NFD", chr(code))) > 1 and p[0] in RULES and chr(code) not in RULES
}


def _ranges(chars: list[str]) -> str:
    """A short character class of ranges that covers the characters, and a few between them."""
    codes = sorted(map(ord, chars))
    cuts = [0, *(i for i in range(1, len(codes)) if codes[i] - codes[i - 1] > 64), len(codes)]
    return "[" + "".join(f"\\x{{{codes[a]:X}}}-\\x{{{codes[b - 1]:X}}}" for a, b in zip(cuts, cuts[1:])) + "]"


def with_mapped(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the text with look-alikes mapped and what shows nothing gone; accents stay as they are written.

    What a text needs is read off its characters beyond ASCII alone, so most texts pass through
    untouched. Each step is a projection of its own, since it uses the one before several times.
    """
    special = F.regexp_replace(F.col(text), PLAIN, "")
    named = df.withColumn("_special", special)
    has = lambda pattern: F.col("_special").rlike(pattern)
    named = named.select(*df.columns, has(_ALWAYS).alias("_a"), has(_CONDITIONAL).alias("_b"), has(_ranges(list(SEVERAL))).alias("_s"), has(_ranges(list(RULES))).alias("_r"))
    clean = F.when(F.col("_b"), F.regexp_replace(text, INVISIBLE, "")).when(F.col("_a"), F.regexp_replace(text, _ALWAYS, "")).otherwise(F.col(text))
    named = named.withColumn(out, clean)
    several = F.col(out)
    for a, b in SEVERAL.items():
        several = F.replace(several, F.lit(a), F.lit(b))
    named = named.withColumn(out, F.when(F.col("_s"), several).otherwise(F.col(out)))
    named = named.withColumn(out, F.when(F.col("_r"), F.translate(out, "".join(RULES), "".join(RULES.values()))).otherwise(F.col(out)))
    return named.select(*[c for c in df.columns if c != out], out)


@F.pandas_udf(T.StringType())
def composed(text: pd.Series) -> pd.Series:
    """Canonical composition, for the collation compares marks in the order in which they stand."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def coarse(mapped_text: Column) -> Column:
    """Hash of the plain ASCII characters that carry no combining mark: equal for canonically equivalent texts."""
    bare = F.when(mapped_text.rlike("\\p{M}"), F.regexp_replace(mapped_text, "(?s).\\p{M}+", "")).otherwise(mapped_text)
    return F.xxhash64(F.when(mapped_text.rlike("[^\\x00-\\x7F]"), F.regexp_replace(bare, "[^\\x00-\\x7F]+", "")).otherwise(mapped_text))


def lookalike_classes(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Classes of texts that look the same.

    Returns (members, canonical). members has one row per document with a non-null text:
    doc_id, _h (128-bit hash of the string as it is), class_id (the smallest doc_id whose text
    looks the same) and canonical_id (the document whose text is the class's form). canonical
    has the strings of classes with more than one string: class_id, canonical_id,
    canonical_text. The form is the member that needs no mapping, else the smallest doc_id.
    Empty texts are a class of their own; copies fold before anything is compared.
    """
    docs = df.where(f"`{doc_id}` is not null and `{text}` is not null").select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
    forms = with_mapped(docs.select("_id", F.md5("_t").alias("_h"), "_t"), "_t", "_m")
    slim = materialize(forms.select("_id", "_h", coarse(F.col("_m")).alias("_c")), "lookalike-slim")
    strings = slim.groupBy("_c", "_h").agg(F.min("_id").alias("_rep"))
    twins = strings.groupBy("_c").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select("_c")
    chosen = materialize(strings.join(twins, "_c", "left_semi"), "lookalike-chosen")
    # Only strings that share their coarse hash with another string are read again, each once.
    texts = with_mapped(docs.join(small_side(chosen), docs["_id"] == chosen["_rep"]).select("_c", "_h", "_rep", "_t"), "_t", "_m").withColumn("_m", composed("_m"))
    texts = materialize(texts.withColumn("_plain", (F.col("_t") == F.col("_m")).cast("int")), "lookalike-texts")
    keyed = texts.withColumn("_u", F.collate(F.translate("_m", *WEIGHED), "UNICODE"))
    classes = keyed.groupBy("_c", "_u").agg(
        F.min("_rep").alias("class_id"), F.max(F.struct(F.col("_plain"), (-F.col("_rep")).alias("_neg"))).alias("_best"), F.count(F.lit(1)).alias("_k")
    )
    found = materialize(
        keyed.join(classes.where("_k > 1"), ["_c", "_u"]).select("_h", "_rep", "class_id", (-F.col("_best._neg")).alias("canonical_id")),
        "lookalike-classes",
    )
    own = slim.groupBy("_h").agg(F.min("_id").alias("_own"), F.count(F.lit(1)).alias("_n"))
    own = materialize(own.join(found.select("_h", "class_id", "canonical_id"), "_h", "left"), "lookalike-own")
    # A text with very many copies joins where its documents are.
    members = spread_join(slim.select("_id", "_h"), own, "_h", "_n").select(
        F.col("_id").alias(doc_id), "_h", F.coalesce("class_id", "_own").alias("class_id"), F.coalesce("canonical_id", "_own").alias("canonical_id")
    )
    forms = found.where("_rep = canonical_id").select("class_id", "canonical_id").distinct()
    canonical = texts.select("_rep", F.col("_t").alias("canonical_text")).join(forms, texts["_rep"] == forms["canonical_id"]).select("class_id", "canonical_id", "canonical_text")
    return members, canonical


def lookalike_pairs(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id_a, doc_id_b), smaller first, of documents whose texts look the same but are not the same string.

    Works on the distinct strings of a class: these are paired first, and each pair of strings
    then gives the pairs of its documents, so nothing is compared that is no result.
    """
    members, canonical = lookalike_classes(df, doc_id, text)
    mixed = members.join(small_side(canonical.select("class_id").distinct()), "class_id", "left_semi")
    mixed = materialize(mixed.select(F.col(doc_id).alias("_id"), "_h", "class_id"), "lookalike-mixed")
    strings = mixed.select("class_id", "_h").distinct()
    pairs = strings.withColumnRenamed("_h", "_ha").join(strings.withColumnRenamed("_h", "_hb"), "class_id").where("_ha < _hb").select("_ha", "_hb")
    a = pairs.join(mixed.select(F.col("_h").alias("_ha"), F.col("_id").alias("_a")), "_ha")
    both = a.join(mixed.select(F.col("_h").alias("_hb"), F.col("_id").alias("_b")), "_hb")
    return both.select(F.least("_a", "_b").alias("doc_id_a"), F.greatest("_a", "_b").alias("doc_id_b"))


def unified(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: doc_id, class_id, canonical_id, is_changed and the unified text.

    The text of a class with several strings is its canonical member's; any other text stays
    as it is. A null text stays null, with null class.
    """
    members, canonical = lookalike_classes(df, doc_id, text)
    forms = canonical.select("class_id", "canonical_text")
    return (
        df.select(doc_id, F.col(text).alias("_t"))
        .join(members.select(doc_id, "class_id", "canonical_id"), doc_id, "left")
        .join(small_side(forms), "class_id", "left")
        .select(doc_id, "class_id", "canonical_id", (~F.coalesce("canonical_text", "_t").eqNullSafe(F.col("_t"))).alias("is_changed"), F.coalesce("canonical_text", "_t").alias("text"))
    )
