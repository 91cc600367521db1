"""Postings by day of sighting, and the bitmap index of technology lists."""

import os
from datetime import date, datetime

import pytest

from leadtide.operators import report, stackindex
from leadtide.sources import daily, ledger
from tests.helpers import batch, plan, raw, stats

STACKS = ["Gear,GearBox", "Gear", "", "Go, C++", "Bolt,Gear,Widget", None, "Widget", "GearBox,Widget"] * 5


def ids(df):
    return sorted(r.job_id for r in df.collect())


def seen(spark):
    return raw(spark, *[
        {"job_id": str(d), "last_scraped_at": datetime(2024, 1, d, 7) if d else None} for d in (0, 1, 2, 2, 9, 10, 20)
    ])


def test_recent_days(spark, tmp_path):
    path = str(tmp_path / "days")
    daily.write_by_day(seen(spark), path)
    assert daily.days(spark, path) == [date(2024, 1, d) for d in (20, 10, 9, 2, 1)]
    table = daily.read_by_day(spark, path)
    rows = daily.recent(table, daily.newest_sighting(spark, path), 11)
    assert ids(rows) == ["10", "20", "9"]
    scans = plan(rows).split("PartitionFilters: ")[1:]
    assert any("last_day" in s.split("PushedFilters")[0] for s in scans)


@pytest.mark.parametrize("n", [1, 2, 4, 6, 7, 9])
def test_last_seen_takes_the_newest(spark, tmp_path, n):
    path = str(tmp_path / "days")
    table = seen(spark)
    daily.write_by_day(table, path)
    found = [r.job_id for r in daily.last_seen(spark, path, n).collect()]
    assert found == [r.job_id for r in report.recent_postings(table, n).collect()]


def test_last_seen_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "days")
    daily.write_by_day(seen(spark).limit(0), path)
    assert daily.days(spark, path) == [] and daily.last_seen(spark, path).count() == 0
    assert daily.recent(daily.read_by_day(spark, path), daily.newest_sighting(spark, path), 9).count() == 0


def test_a_batch_moves_postings_to_their_day(spark, tmp_path):
    path, folder = str(tmp_path / "days"), str(tmp_path / "ledger")
    ledger.seed(seen(spark).dropDuplicates(["job_id"]), folder, 4)
    daily.write_by_day(ledger.current(spark, folder), path)
    still = sorted(os.listdir(f"{path}/last_day=2024-01-10"))
    scraped = [("0", 21), ("20", 21), ("2", 9), ("new", 1)]
    for _ in range(2):  # the second time as after a failure
        ledger.take_in(batch(spark, *[{"job_id": j, "scraped_at": datetime(2024, 1, d)} for j, d in scraped]), folder, 1)
        daily.take_in_days(spark, folder, path, 1)
        table = daily.read_by_day(spark, path)
        have = sorted(map(tuple, table.select("job_id", "last_day", "last_scraped_at").collect()), key=repr)
        now = ledger.current(spark, folder).selectExpr("job_id", "to_date(last_scraped_at)", "last_scraped_at").collect()
        assert have == sorted(map(tuple, now), key=repr)
        assert daily.days(spark, path) == [date(2024, 1, d) for d in (21, 10, 9, 1)]
    assert sorted(os.listdir(f"{path}/last_day=2024-01-10")) == still  # not touched


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    table = stats(spark, *[(f"c{i}", 1 + i % 28, i, s) for i, s in enumerate(STACKS)]).repartition(3)
    stackindex.build_index(table, folder)
    return folder, table


@pytest.mark.parametrize(
    "techs", [[], ["Gear"], ["GearB"], ["Gear", "Widget"], ["Gear", "Box"], ["absent"], ["Gear", "absent"], ["", "Go"],
              ["Gear,Widget"], ["x,"], [" C++"], ["Gear", "Gear"]]
)
def test_index_finds_what_the_lists_name(spark, index, techs):
    folder, table = index
    want = sorted(map(tuple, table.where(report.has_techs(techs)).collect()), key=repr)
    have = stackindex.search(stackindex.indexed_rows(spark, folder), folder, techs)
    assert have.columns == table.columns and sorted(map(tuple, have.collect()), key=repr) == want
    assert stackindex.hit_count(spark, folder, techs).first()[0] == len(want)


def test_index_counts(spark, index):
    folder, table = index
    want = dict(map(tuple, report.tech_distribution(table).collect()))
    assert dict(map(tuple, stackindex.tech_counts(spark, folder).collect())) == want


def test_index_of_several_blocks(spark, tmp_path):
    """Blocks begin and end at multiples of 32,768 numbers."""
    folder = str(tmp_path)
    rows = spark.range(100_000, numPartitions=1).selectExpr("id", "if(id % 32768 IN (0, 1, 32767), 'A', 'B') AS tech_stack")
    stackindex.build_index(rows, folder)
    found = stackindex.search(stackindex.indexed_rows(spark, folder), folder, ["A"]).collect()
    assert sorted(r.id for r in found) == [i for i in range(100_000) if i % 32768 in (0, 1, 32767)]
    assert stackindex.hit_count(spark, folder, ["B"]).first()[0] == 100_000 - len(found)
