"""Every registered query with SQL against DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import duck, same

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


def test_registry():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_against_sql(spark, sf, name):
    ok, said = same(QUERIES[name](spark, sf), duck(sf), ORACLE[name])
    assert ok, said


#: Keys that are unique in the result of a query without SQL.
KEYS = {
    "jaro_winkler_pairs": ["person_id", "candidate_id"], "name_similarity_pairs": ["person_id", "candidate_id"], "page_links": ["doc_id", "place"], "p7_found": ["candidate_id"], "p7_confidence": ["candidate_id"],
    "p8_fill": ["spec_id"], "p9_mixture": ["doc_id", "source"], "p9_shares": ["source"],
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_rows_without_sql(spark, sf, name):
    """What has no SQL gives rows, once per key; its values are held against loops in the tests of the operator."""
    out = QUERIES[name](spark, sf)
    rows = out.collect()
    assert rows
    keys = KEYS.get(name, out.columns)
    if name in KEYS:
        assert len({tuple(r[k] for k in keys) for r in rows}) == len(rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
