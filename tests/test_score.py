import pytest

from leadtide.operators.quality import minimum_leads, scores_valid, targets_configured
from leadtide.operators.score import lead_scores, score_all_weeks
from leadtide.sources.config import tech_config
from tests.helpers import stats

NO_TARGET = [("Java", ["java"], "l", False, 0.5)]


def one(spark, rows, config=None, **options):
    df = lead_scores(stats(spark, *rows), config or tech_config(spark), **options)
    return {r.company: r for r in df.collect()}


def test_single_week_has_full_velocity(spark):
    row = one(spark, [("a", 1, 4, "Python,React")])["a"]
    assert (row.jobs_last_week, row.velocity_score, row.volume_score) == (0, 100.0, 100.0)
    assert (row.tech_match_score, row.composite_score) == (71.43, 90.0)
    assert row.score_metadata == "Python,React"


def test_velocity_may_be_negative_and_is_capped(spark):
    rows = one(spark, [("down", 1, 7, ""), ("down", 8, 3, ""), ("up", 1, 2, ""), ("up", 8, 10, "")])
    assert (rows["down"].velocity_score, rows["up"].velocity_score) == (-57.14, 100.0)
    assert rows["down"].volume_score == 30.0
    df = lead_scores(stats(spark, ("down", 1, 7, ""), ("down", 8, 3, "")), tech_config(spark))
    check = scores_valid(df).first()
    assert (check.passed, check.severity, check.measured, check.note) == (False, "ERROR", 1, "down")


def test_previous_row_not_previous_week(spark):
    assert one(spark, [("a", 1, 4, ""), ("a", 15, 5, "")])["a"].jobs_last_week == 4


def test_only_the_newest_week_but_the_maximum_of_all(spark):
    rows = one(spark, [("old", 1, 50, ""), ("a", 8, 5, "")])
    assert set(rows) == {"a"} and rows["a"].volume_score == 10.0


@pytest.mark.parametrize("max_targets", [0, 250])
def test_names_match_as_substrings_unless_exact(spark, max_targets):
    config = tech_config(spark, [("Java", ["java"], "l", True, 2.0), ("C", ["c"], "l", True, 2.0)])
    rows = [("a", 1, 1, "JavaScript")]
    assert one(spark, rows, config, max_targets=max_targets)["a"].tech_match_score == 50.0
    assert one(spark, rows, config, max_targets=max_targets, exact=True)["a"].tech_match_score == 0.0


@pytest.mark.parametrize("max_targets", [0, 250])
def test_no_target_scores_nothing(spark, max_targets):
    config = tech_config(spark, NO_TARGET)
    assert one(spark, [("a", 1, 1, "Java")], config, max_targets=max_targets) == {}
    check = targets_configured(config).first()
    assert (check.passed, check.severity, check.measured) == (False, "ERROR", 0)


def test_zero_weights(spark):
    config = tech_config(spark, [("Java", ["java"], "l", True, 0.0)])
    assert one(spark, [("a", 1, 1, "Java")], config)["a"].tech_match_score == 0.0


def test_ranges(spark):
    rows = [(c, d, (ord(c) * d) % 9 + 1, "Python" if d % 2 else "") for c in "abcdef" for d in (1, 8, 15)]
    for r in score_all_weeks(stats(spark, *rows), tech_config(spark)).collect():
        assert r.velocity_score <= 100 and 0 <= r.tech_match_score <= 100
        assert 0 < r.volume_score <= 100


def test_minimum_leads(spark):
    df = lead_scores(stats(spark, *[(c, 1, 1, "") for c in "abcd"]), tech_config(spark))
    check = minimum_leads(df).first()
    assert (check.passed, check.severity, check.measured, check.limit) == (False, "WARN", 4, 5)
