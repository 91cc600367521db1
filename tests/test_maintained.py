"""Tables kept up batch by batch equal those computed from all rows."""

import glob
import os
from datetime import datetime

from leadtide.operators.clean import clean_postings
from leadtide.operators.score import lead_scores
from leadtide.operators.stats import company_stats
from leadtide.sources.config import tech_config
from leadtide.sources.ledger import current, seed, take_in
from leadtide.sources.maintained import (
    cleaned_jobs, company_state, maintained_leads, take_in_cleaned, take_in_scores, take_in_stats, weekly_stats,
)
from tests.helpers import batch, plan, raw
from datetime import date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(spark, folder, config):
    whole = clean_postings(current(spark, folder))
    kept = cleaned_jobs(spark, folder)
    assert kept.columns == whole.columns and rows(kept) == rows(whole)
    stats = company_stats(whole, config)
    assert rows(weekly_stats(spark, folder)) == rows(stats)
    assert rows(maintained_leads(spark, folder, config)) == rows(lead_scores(stats, config))
    weeks = {}
    for r in stats.collect():
        weeks.setdefault(r.company_normalized, []).append((r.week_start, r.jobs_posted))
    held = {r.company_normalized: [tuple(w) for w in r.newest] for r in company_state(spark, folder).collect() if r.newest}
    assert held == {company: sorted(w, reverse=True)[:2] for company, w in weeks.items()}


def begin(spark, folder, config):
    table = raw(
        spark,
        {"job_id": "a", "description": "python"},
        {"job_id": "b", "company": " ACME ", "first_scraped_at": datetime(2024, 1, 6), "last_scraped_at": datetime(2024, 1, 8)},
        {"job_id": "c", "company": "Beta", "title": "Cook", "location": None},
        {"job_id": "d", "company": "Beta", "title": "Baker", "posting_date": date(2024, 1, 10), "location": ""},
        {"job_id": "e", "company": "Gone", "title": "Smith", "posting_date": date(2024, 2, 7)},
        {"job_id": "f", "company": "Undated", "title": "Smith", "posting_date": None, "first_scraped_at": None},
    )
    seed(table, folder, 8)
    up(spark, folder, 0, config)


def up(spark, folder, number, config):
    take_in_cleaned(spark, folder, number)
    take_in_scores(spark, folder, number, take_in_stats(spark, folder, number, config))


def files(folder):
    return {os.path.basename(w): sorted(os.listdir(w)) for w in glob.glob(f"{folder}/weekly/stats/week_start=*")}


def test_batches_equal_the_whole(spark, tmp_path):
    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    begin(spark, folder, config)
    same(spark, folder, config)
    before = files(folder)

    new = batch(
        spark,
        # a key whose kept row is replaced, as an earlier scrape comes late, and moves to another week
        {"job_id": "z", "company": "Gone", "title": "Smith", "location": "Toronto", "description": "golang",
         "posting_date": date(2024, 1, 4), "scraped_at": datetime(2024, 1, 1)},
        {"job_id": "a", "scraped_at": datetime(2024, 1, 20)},  # seen again
        {"job_id": "n", "company": "New", "title": "react dev", "posting_date": date(2024, 1, 4)},
        {"job_id": "g", "company": "undated", "title": "smith", "location": "Toronto", "scraped_at": datetime(2024, 1, 2)},
    )
    for _ in range(2):  # the second time as after a failure
        take_in(new, folder, 1)
        up(spark, folder, 1, config)
        same(spark, folder, config)
    after = files(folder)
    assert after["week_start=2024-01-08"] == before["week_start=2024-01-08"]  # untouched
    assert after["week_start=2024-01-01"] != before["week_start=2024-01-01"]
    assert "week_start=2024-02-05" not in after  # no row is left

    # a sighting that goes back shortens the span of its key
    take_in(batch(spark, {"job_id": "a", "scraped_at": datetime(2024, 1, 7)}), folder, 2)
    up(spark, folder, 2, config)
    same(spark, folder, config)
    assert files(folder) == after  # no statistic depends on it

    # a batch without records, then another config, taken in twice, and one that detects nothing
    take_in(batch(spark, {"job_id": "a"}).limit(0), folder, 3)
    up(spark, folder, 3, config)
    same(spark, folder, config)
    other = tech_config(spark, [("Smithing", ["smith"], "craft", True, 1.0)])
    for _ in range(2):
        take_in(batch(spark, {"job_id": "h", "title": "Smith", "company": "Beta"}), folder, 4)
        up(spark, folder, 4, other)
        same(spark, folder, other)
    take_in(batch(spark, {"job_id": "i", "title": "Smith", "company": "Beta"}), folder, 5)
    up(spark, folder, 5, other.limit(0))
    same(spark, folder, other.limit(0))


def test_a_lost_attempt_with_another_batch(spark, tmp_path):
    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    begin(spark, folder, config)
    for day in (11, 18):  # the week of the first attempt loses its row again
        rows_of_week = {"job_id": "x", "company": "Ex", "posting_date": date(2024, 3, day)}
        take_in(batch(spark, rows_of_week), folder, 1)
        up(spark, folder, 1, config)
        same(spark, folder, config)


def test_an_older_week_moves_up_when_a_newer_one_goes(spark, tmp_path):
    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    seed(raw(spark, *[{"title": t, "posting_date": date(2024, 1, day), "description": "python"}
                      for t, day in (("one", 3), ("two", 10), ("three", 17), ("four", 24))]), folder, 4)
    up(spark, folder, 0, config)
    same(spark, folder, config)
    # an earlier scrape of the newest title has an older date; then of the next one too
    for number, (title, day) in enumerate((("four", 2), ("three", 4)), 1):
        moved = {"job_id": f"m{number}", "title": title, "location": "Toronto", "description": "python",
                 "posting_date": date(2024, 1, day), "scraped_at": datetime(2024, 1, 1)}
        take_in(batch(spark, moved), folder, number)
        up(spark, folder, number, config)
        same(spark, folder, config)


def test_scores_read_one_week(spark, tmp_path):
    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    begin(spark, folder, config)
    scans = plan(maintained_leads(spark, folder, config)).split("PartitionFilters: ")[1:]
    assert any("week_start" in s.split("PushedFilters")[0] and "= 2024-02-05" in s for s in scans)


def test_held_rows_are_not_shuffled(spark, tmp_path):
    from leadtide.sources.maintained import cleaned_rows

    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    begin(spark, folder, config)
    assert "Exchange hashpartitioning" not in plan(cleaned_rows(spark, folder, 1, [0, 3]))


def test_a_batch_is_shuffled_once(spark, tmp_path, monkeypatch):
    """One shuffle brings the changed postings to the buckets of their keys; the stored batch needs none."""
    from leadtide.sources import ledger, maintained

    folder, config = str(tmp_path / "ledger"), tech_config(spark)
    begin(spark, folder, config)
    plans = {}

    def noted(rows, folder, name, number, buckets):
        plans[name] = plan(rows.repartition(buckets, ledger.KEYED_BY[name])).split("Initial Plan")[-1]
        written(rows, folder, name, number, buckets)

    written = ledger._replace
    monkeypatch.setattr(ledger, "_replace", noted)
    monkeypatch.setattr(maintained, "_replace", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be sent
    try:
        take_in(batch(spark, {"job_id": "a"}, {"job_id": "z", "company": "Beta"}), folder, 1)
        take_in_cleaned(spark, folder, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {name: text.count("Exchange") for name, text in plans.items()} == {"sightings": 0, "postings": 0, "cleaned": 1}
    assert rows(cleaned_jobs(spark, folder)) == rows(clean_postings(current(spark, folder)))
