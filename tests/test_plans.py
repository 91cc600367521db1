"""The physical plans: what must and must not be in them."""

import re

import pytest

from leadtide.operators.clean import clean_postings
from leadtide.operators.detect import tech_matches
from leadtide.operators.report import score_histogram
from leadtide.operators.score import lead_scores, with_matched_weight
from leadtide.operators.stats import company_stats
from leadtide.plans import queries_quality, queries_relational, queries_table
from leadtide.plans.catalog import Base
from leadtide.schemas import CLEANED_JOBS, RAW_JOBS
from leadtide.sources.bindings import part_config
from leadtide.sources.tables import read_table, refresh_table
from tests.helpers import cleaned, plan, raw, stats

PYTHON = ["PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "FlatMapGroups"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name, df in [
        ("raw_jobs", raw(spark, {}, {"company": "b"})),
        ("cleaned_jobs", cleaned(spark, {"description": "widget"})),
        ("company_stats", stats(spark, ("a", 1, 3, "Widget"))),
    ]:
        refresh_table(df, str(folder / name), name)
    return {n: read_table(spark, str(folder / n), n)
            for n in ("raw_jobs", "cleaned_jobs", "company_stats")}


def no_python_no_cross(text):
    assert not any(node in text for node in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedup_is_one_shuffle_with_partial_aggregation(tables):
    text = plan(clean_postings(tables["raw_jobs"]))
    no_python_no_cross(text)
    assert text.count("Exchange") == 1 and "partial_min" in text and "Window" not in text


def test_stats_read_few_columns_and_test_keywords_once(spark, tables):
    text = plan(company_stats(tables["cleaned_jobs"], part_config(spark)))
    no_python_no_cross(text)
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert not any(c in read for c in ("url", "source", "location", "job_id", "first_seen"))
    assert "PushedFilters: [IsNotNull(posting_date)]" in text
    assert text.count("Exchange") == 2 and text.count("Scan parquet") == 1
    assert text.count("lambdafunction(exists") <= 1 and "Join" not in text


def test_matching_does_not_shuffle_and_tests_once(spark, tables):
    text = plan(tech_matches(tables["cleaned_jobs"], part_config(spark)).select("job_id", "tech_name"))
    no_python_no_cross(text)
    assert "Exchange" not in text and text.count("lambdafunction(exists") == 1


def test_long_configs_are_joined_without_python(spark, tables):
    found = tech_matches(tables["cleaned_jobs"], part_config(spark), max_techs=0).select("job_id", "tech_name")
    text = plan(found)
    no_python_no_cross(text)
    assert "hashpartitioning(_key" in text
    weights = with_matched_weight(tables["company_stats"], part_config(spark), max_targets=0)
    no_python_no_cross(plan(weights))


def test_scores_have_no_global_window(spark, tables):
    text = plan(lead_scores(tables["company_stats"], part_config(spark)))
    no_python_no_cross(text)
    # single partitions hold one partial row per task: they sit under a scalar subquery
    for at in [m.start() for m in re.finditer("SinglePartition", text)]:
        assert "partial_" in text[at:].split("\n")[1]
    assert "hashpartitioning(company_normalized" in text


def test_histogram_counts_before_it_joins(tables, spark):
    from tests.helpers import leads

    text = plan(score_histogram(leads(spark, 1.0)))
    assert "partial_count" in text and "CartesianProduct" not in text


def test_declared_schemas(tables):
    assert tables["raw_jobs"].schema.names == RAW_JOBS.names
    assert tables["cleaned_jobs"].schema.names == CLEANED_JOBS.names


def test_cleaning_sorts_and_shuffles_narrow_rows(tables):
    """The key goes as 128 bits, the texts of a row as one."""
    shuffled = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(clean_postings(tables["raw_jobs"])))
    assert [re.sub(r"#\d+", "", s) for s in shuffled] == [f"_key, {shuffled[0].split(', ')[1]}"]


def test_full_refresh_cleans_once_for_both_runs(spark, monkeypatch, tables):
    seen = []
    monkeypatch.setattr(queries_table, "refresh_table", lambda df, path, name: seen.append(plan(df)))
    base = Base(spark, "")
    base.postings = tables["raw_jobs"]
    monkeypatch.setattr(queries_table, "read_table", lambda *_: None)
    queries_table.k6(base)
    assert len(seen) == 2 and not any("Aggregate" in text for text in seen)


def test_long_target_lists_meet_stored_statistics(spark, tables):
    base = Base(spark, "")
    base.postings = tables["raw_jobs"]
    assert "title_normalized" not in plan(queries_relational.j4_untidy_many(base)) and "stored_stats" in base.__dict__


def test_statistics_shuffle_one_company_name_and_no_title(spark, tables):
    text = re.sub(r"#\d+L?", "", plan(company_stats(tables["cleaned_jobs"], part_config(spark))))
    assert text.count("Exchange") == 2 and "named" in text
    assert "matched_company" not in text and "all_company" not in text


def test_validity_of_all_weeks_scores_once(spark, tables):
    base = Base(spark, "")
    base.postings = tables["raw_jobs"]
    text = plan(queries_quality.q6_all(base))
    assert "Window" not in text and "Scan parquet" in text
