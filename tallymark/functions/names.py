"""Folding of names to plain letters, as JVM-side columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_table() -> dict[str, str]:
    """Lower-case Latin letters with accents to their base letter, by canonical decomposition."""
    out = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        low = chr(code).lower()
        base = unicodedata.normalize("NFKD", low)[:1]
        if low != base and "a" <= base <= "z" and len(low) == 1:
            out[low] = base
    return out


LATIN = _latin_table()
# Latin letters without a decomposition that a plain alphabet writes as one letter.
STROKED = {"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ı": "i"}


def plain(c: Column, stroked: bool = True) -> Column:
    """Lower case without accents; with ``stroked`` also the letters that have no decomposition."""
    table = {**LATIN, **STROKED} if stroked else LATIN
    low = F.regexp_replace(F.lower(c), r"\p{M}+", "")
    out = F.translate(low, "".join(table), "".join(table.values()))
    return F.replace(F.replace(out, F.lit("ß"), F.lit("ss")), F.lit("æ"), F.lit("ae")) if stroked else out


def norm_name(c: Column) -> Column:
    """Plain lower-case words of a name: accents go, everything but a to z is a separator."""
    return F.trim(F.regexp_replace(plain(c, stroked=False), "[^a-z]+", " "))
