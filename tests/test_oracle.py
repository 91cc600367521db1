"""Registered queries against their SQL at the smallest scale.

A cross-section runs by default; ``PARITY=all`` runs every query.
"""

import os

import pytest

import __spark_entry__ as entry
from leadtide.plans import catalog
from tests.parity import DATA, connect, differences

FOLDER = f"{DATA}/sf0.001"
SECTION = [
    "s4_batch_ingest", "k1_insert_unseen", "k3_upsert_large_batch", "k8_set_target",
    "k12_summary_json", "k13_constraints", "p1_normalise", "p13_recent", "p20_invalid_scores",
    "j1_posting_tech_pairs", "j2_keyword_match", "j2_document_match_default_config",
    "j2_keyword_match_untidy_config", "j2_keyword_match_untidy_config_long", "k3_upsert_ledger",
    "s4_lines_accepted_and_refused", "j3_weeks_without_tech", "j4_matched_weight_many_targets", "a4_filtered_count_distinct",
    "a26_tech_share", "a27_histogram_all_weeks", "w1_previous_row", "o3_top_leads", "u1_union_all",
    "f20_posting_key", "f25_percent_text", "c1_upsert", "c2_clean_postings", "c3_company_stats",
    "c3_document_stats", "c8_lead_scores", "c14_warehouse_report", "q_all_checks",
]
NAMES = sorted(catalog.QUERIES) if os.environ.get("PARITY") == "all" else SECTION


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
