import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from leadtide.operators.detect import _needed, read_techs, tech_matches, with_techs
from leadtide.operators.stats import company_stats
from leadtide.sources.config import tech_config
from tests.helpers import cleaned

TECHS = [
    ("Python", ["python"], "l", True, 1.0),
    ("Go", ["golang", "go "], "l", False, 0.6),
    ("JavaScript", ["javascript", "js "], "l", False, 0.5),
    ("Java", ["java"], "l", True, 0.5),
]
SMALL, LARGE = {}, {"max_techs": 0}


def by_week(df):
    return {(r.company_normalized, str(r.week_start)): r for r in df.collect()}


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_weeks_without_date_and_without_tech(spark, limits):
    jobs = cleaned(
        spark,
        {"title": "Dev", "description": "Python here"},
        {"title": "Cook"},
        {"title": "Gone", "posting_date": None, "description": "python"},
        {"title": "Sr. Cook", "posting_date": date(2024, 1, 10)},
        {"title": "Senior Cook", "posting_date": date(2024, 1, 10), "location": None},
    )
    got = by_week(company_stats(jobs, tech_config(spark, TECHS), detail=True, **limits))
    first, second = got["acme", "2024-01-01"], got["acme", "2024-01-08"]
    assert (first.jobs_posted, first.tech_stack, first.mid_count) == (1, "Python", 1)
    assert (second.jobs_posted, second.tech_stack, second.tech_array) == (2, "", [])
    # without any technology the narrow classes count, so "Sr." is Mid-Level
    assert (second.senior_count, second.mid_count, second.locations) == (1, 1, ["Toronto"])
    assert len(got) == 2


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_wide_classes_and_one_row_per_spelling_group(spark, limits):
    jobs = cleaned(
        spark,
        {"title": "Sr. Python", "company": "Acme"},
        {"title": "Sr. Python", "company": "ACME", "location": "Paris"},
        {"title": "Principal Python", "company": "acme", "location": None},
    )
    row, = company_stats(jobs, tech_config(spark, TECHS), detail=True, **limits).collect()
    assert (row.company, row.jobs_posted, row.senior_count, row.lead_count) == ("ACME", 2, 1, 1)
    assert row.locations == ["Paris", "Toronto"]


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_keywords_match_inside_words_and_in_title(spark, limits):
    jobs = cleaned(
        spark,
        {"job_id": "1", "title": "GOLANG dev"},
        {"job_id": "2", "title": "x", "description": "Django developer"},  # holds "go "
        {"job_id": "3", "title": "x", "description": "JavaScript"},  # holds "java"
        {"job_id": "4", "title": "x", "description": None},
    )
    got = {r.job_id: r.techs for r in with_techs(jobs, tech_config(spark, TECHS), **limits).collect()}
    assert got == {"1": ["Go"], "2": ["Go"], "3": ["Java", "JavaScript"], "4": []}


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_empty_and_null_keywords(spark, limits):
    config = tech_config(spark, [
        ("None", None, "x", True, 1.0), ("Empty", [], "x", True, 1.0),
        ("Holes", [None, "cook"], "x", True, 1.0), ("All", [""], "x", True, 1.0),
    ])
    jobs = cleaned(spark, {"title": "Cook"}, {"title": "Dev"})
    got = {r.title: r.techs for r in with_techs(jobs, config, **limits).collect()}
    assert got == {"Cook": ["All", "Holes"], "Dev": ["All"]}


def test_empty_config_reports_nothing(spark):
    assert company_stats(cleaned(spark, {}), tech_config(spark, [])).count() == 0


def test_needless_keywords_are_dropped(spark):
    assert _needed(["reactjs", "react", "react.js", None, "vue"]) == ("vue", "react")
    assert not read_techs(tech_config(spark), max_keywords=5).small
    assert not read_techs(tech_config(spark), max_chars=50).small
    assert not read_techs(tech_config(spark, [("A", ["x" * 99], "l", True, 1.0)]), max_chars=50).small


def test_more_than_one_mask(spark):
    techs = [(f"T{i:03}", [f"k{i:03}"], "x", False, 1.0) for i in range(150)]
    jobs = cleaned(spark, {"description": "K000 k061 K062 k124 k149"})
    row, = company_stats(jobs, tech_config(spark, techs)).collect()
    assert row.tech_stack == "T000,T061,T062,T124,T149"


def brute_stats(rows, techs):
    """Company-week -> (jobs, stack, places), the plain way."""
    groups = defaultdict(list)
    for r in rows:
        if r.posting_date is None:
            continue
        week = r.posting_date - timedelta(days=r.posting_date.weekday())
        found = {
            name for name, words, *_ in techs
            if any(w in r.title.lower() or w in (r.description or "").lower() for w in words)
        }
        groups[r.company_normalized, str(week)].append((r, found))
    out = {}
    for key, members in groups.items():
        hits = [m for m in members if m[1]] or members
        out[key] = (
            len({m[0].title for m in hits}),
            ",".join(sorted(set().union(*[m[1] for m in hits]))),
            sorted({m[0].location for m in hits if m[0].location is not None}),
            min(m[0].company for m in hits),
        )
    return out


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_against_brute_force_with_one_hot_company(spark, limits):
    rng = random.Random(3)
    pieces = ["python", "Go ", "java", "script", "JS ", "golang", "é", "cook", "x", "𝄞"]
    rows = [
        {
            "company": rng.choice(["hot", " HOT", "hot", rng.choice("abcdef")]),
            "title": " ".join(rng.choices(pieces + ["Senior", "Lead"], k=2)),
            "description": rng.choice([None, "", " ".join(rng.choices(pieces, k=4))]),
            "location": rng.choice([None, "A", "B", "C"]),
            "posting_date": rng.choice([None] + [date(2024, 1, d) for d in range(1, 28)]),
        }
        for _ in range(500)
    ]
    jobs = cleaned(spark, *rows)
    want = brute_stats(jobs.collect(), TECHS)
    got = company_stats(jobs.repartition(7), tech_config(spark, TECHS), detail=True, **limits).collect()
    assert len(got) == len(want)
    assert {
        (r.company_normalized, str(r.week_start)):
            (r.jobs_posted, r.tech_stack, r.locations, r.company) for r in got
    } == want
    for r in got:
        assert r.senior_count + r.junior_count + r.lead_count + r.mid_count == r.jobs_posted
        assert ",".join(r.tech_array) == r.tech_stack


def test_matches_of_both_plans_agree_on_documents(spark):
    from leadtide.sources.bindings import document_config, documents

    docs = documents(spark, "/root/testdata/sf0.001")
    config = document_config(spark)
    a = tech_matches(docs, config).select("job_id", "tech_name")
    b = tech_matches(docs, config, max_techs=0).select("job_id", "tech_name")
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert a.agg(F.count("*")).first()[0] > 0


def test_untidy_configs_give_one_answer(spark):
    rows = [("A", ["x", None], "l", True, 1.0), (None, ["y"], "l", True, 1.0), ("A", ["z"], "l", True, None), ("B", None, "l", True, 1.0), ("C", [""], "l", True, 1.0)]
    config = spark.createDataFrame(rows, "tech_name string, keywords array<string>, category string, is_target boolean, score_weight double")
    jobs = cleaned(spark, {"description": "Z"}, {"description": "x z"}, {"description": None, "title": "y"})
    for limits in (SMALL, LARGE):
        got = sorted((r.job_id, r.techs) for r in with_techs(jobs, config, **limits).collect())
        assert [t for _, t in got] == [["A", "C"], ["A", "C"], ["C"]]


def test_long_configs_stay_tables(spark):
    techs = read_techs(tech_config(spark), max_techs=0)
    assert not techs.small and techs.rows == []
    assert company_stats(cleaned(spark, {}), tech_config(spark), max_techs=0).count() == 1


@pytest.mark.parametrize("limits", [SMALL, LARGE])
def test_company_of_a_week_is_the_smallest_that_names_a_technology(spark, limits):
    jobs = cleaned(
        spark,
        {"job_id": "1", "company": "Acme", "company_normalized": "a", "title": "x", "description": "none"},
        {"job_id": "2", "company": "aCME", "company_normalized": "a", "title": "y", "description": "java"},
        {"job_id": "3", "company": "?", "company_normalized": "a", "title": "z", "description": "java"},
        {"job_id": "4", "company": "B", "company_normalized": "b", "title": "x", "description": "none"},
        {"job_id": "5", "company": "?", "company_normalized": "b", "title": "?", "description": "none"},
    )
    jobs = jobs.withColumns({name: F.nullif(name, F.lit("?")) for name in ("company", "title")})
    rows = company_stats(jobs, tech_config(spark, TECHS), **limits).collect()
    assert sorted((r.company_normalized, r.company, r.jobs_posted) for r in rows) == [("a", "aCME", 2), ("b", "B", 1)]
