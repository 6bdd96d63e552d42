"""Chains with lists far longer than a chunk, against their SQL with the same chunk size; plans that read tables once."""

import os

import pytest
from oracle_check import check, connection

from recordloom.catalog import ORACLES, QUERIES, chains
from recordloom.operators import skew

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables absent")
SQL = {
    "vendor_sets": chains.vendor_sets_sql,
    "vendor_name_lists": chains.vendor_name_lists_sql,
    "entity_mapping": chains.entity_mapping_sql,
    "mapping_json_roundtrip": chains.entity_mapping_sql,
    "mapped_owners": lambda most: ORACLES["mapped_owners"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_short_chunks(spark, monkeypatch, name):
    monkeypatch.setattr(skew, "MAX_ITEMS", 3)
    _, rows, problem, _ = check(spark, connection(FOLDER), name, FOLDER, QUERIES, {name: SQL[name](3)})
    assert problem is None, problem
    assert rows > 0


@pytest.mark.parametrize(("name", "scans"), [("mapping_totals", 4), ("bom_expansion", 3), ("vendor_distribution", 3)])
def test_tables_are_read_once(spark, name, scans):
    found = QUERIES[name](spark, FOLDER)
    found.collect()
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Scan parquet") <= scans
