"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from texlode.queries.library import QUERIES
from texlode.queries.oracle import ORACLE

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "labels", "pages")
# One or more per family; the driver compares all of them.
CHOSEN = (
    "scan_tex", "file_categories", "strip_comments", "clean_inline", "sanitized_docs", "strip_latex",
    "doc_segments", "inline_equations", "eq_env_counts", "sub_equations", "meq_dict", "inline_dict",
    "enumerated_docs", "resume_ids", "read_eq_tsv", "equation_objects", "eq_doc_tsv", "coverage",
    "mse_status", "label_refs", "package_top50", "eqs_by_category", "rejects_summary", "brace_groups",
    "expand_inputs", "macro_deps", "expand_macros", "macro_outcomes", "macro_defs", "unmatched_equations",
    "tex_xhtml_join", "stream_eq_keys", "stream_eq_ids",
    "resume_inline_ids", "resume_meq_ids", "stream_environments", "stream_inline_ids", "stream_meq_ids",
    "scan_folder", "scan_submissions", "read_eq_json_files", "rejects_table",
    "inline_segments", "write_inline_tsv", "write_texts", "write_categories", "quarantine_submissions",
    "quarantine_docs",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)
    assert got and got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
