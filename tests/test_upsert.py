import pytest
from pyspark.sql import functions as F

from leadtide.operators.upsert import (
    ingest_accounting, insert_or_ignore, is_small, new_postings, one_per_job, split_batch, upsert_postings,
)
from leadtide.sources.batches import read_batch, rejected, typed
from leadtide.sources.config import add_techs, set_target, tech_config
from leadtide.sources.tables import save_bucketed
from tests.helpers import JAN, batch, plan, raw


def rows(df):
    return {r.job_id: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("limit", [0, 1000])
def test_insert_new_touch_known(spark, limit):
    table = raw(spark, {"job_id": "a", "title": "Old"}, {"job_id": "z"})
    new = batch(spark, {"job_id": "a", "title": "New"}, {"job_id": "b"})
    got = rows(upsert_postings(table, new, limit))
    assert set(got) == {"a", "b", "z"}
    assert (got["a"]["title"], got["a"]["first_scraped_at"], got["a"]["last_scraped_at"]) == (
        "Old", JAN(5), JAN(9),
    )
    assert got["b"]["first_scraped_at"] == got["b"]["last_scraped_at"] == JAN(9)
    assert got["z"]["last_scraped_at"] == JAN(5)


@pytest.mark.parametrize("limit", [0, 1000])
def test_same_batch_twice_changes_nothing(spark, limit):
    table = raw(spark, {"job_id": "a"})
    new = batch(spark, {"job_id": "a"}, {"job_id": "b"})
    once = upsert_postings(table, new, limit)
    assert rows(upsert_postings(once, new, limit)) == rows(once)
    assert tuple(ingest_accounting(once, new).first()) == (2, 0, 2)
    assert new_postings(once, new, limit).count() == 0


@pytest.mark.parametrize("limit", [0, 1000])
def test_repeats_inside_a_batch_are_one_row(spark, limit):
    new = batch(
        spark,
        {"job_id": "a", "title": "second", "scraped_at": JAN(8)},
        {"job_id": "a", "title": "first", "scraped_at": JAN(7)},
    )
    got = rows(upsert_postings(raw(spark).where("false"), new, limit))
    assert (got["a"]["title"], got["a"]["first_scraped_at"], got["a"]["last_scraped_at"]) == (
        "first", JAN(7), JAN(8),
    )
    assert tuple(ingest_accounting(raw(spark).where("false"), new).first()) == (2, 1, 0)


def test_both_plans_agree(spark):
    table = raw(spark, *[{"job_id": str(i), "title": f"t{i}"} for i in range(0, 60, 2)])
    new = batch(spark, *[{"job_id": str(i % 40), "title": f"n{i}", "scraped_at": JAN(6 + i % 5)}
                         for i in range(90)])
    assert rows(upsert_postings(table, new, 0)) == rows(upsert_postings(table, new, 1000))


def test_insert_or_ignore_drops_conflicts(spark):
    table = raw(spark, {"job_id": "a", "title": "Old"})
    more = raw(spark, {"job_id": "a"}, {"job_id": "b", "title": "Y"}, {"job_id": "b", "title": "X"})
    got = rows(insert_or_ignore(table, more, ["job_id"], ["first_scraped_at"]))
    assert (got["a"]["title"], got["b"]["title"], len(got)) == ("Old", "X", 2)


def test_split_and_empty_batch(spark):
    table = raw(spark, {"job_id": "a"})
    new = batch(spark, {"job_id": "a"}, {"job_id": "b"})
    assert {r.job_id: r.status for r in split_batch(table, new).collect()} == {
        "a": "existing", "b": "new",
    }
    nothing = new.where("false")
    assert tuple(ingest_accounting(table, nothing).first()) == (0, 0, 0)
    assert rows(upsert_postings(table, nothing)) == rows(table)


def test_small_batch_leaves_the_table_in_place(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, *[{} for _ in range(20)]).write.parquet(path)
    table = spark.read.parquet(path)
    new = batch(spark, {"job_id": "3"}, {"job_id": "99"})
    text = plan(upsert_postings(table, new))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_bucketed_table_is_not_shuffled(spark):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    save_bucketed(raw(spark, *[{} for _ in range(50)]), "raw_bucketed", "job_id", buckets)
    try:
        text = plan(upsert_postings(spark.table("raw_bucketed"), batch(spark, {"job_id": "1"}), 0))
        table_side = text[text.index("FullOuter"):text.index("raw_bucketed")]
        assert "Bucketed: true" in text and "Exchange" not in table_side
    finally:
        spark.sql("DROP TABLE raw_bucketed")


def test_batch_records_are_typed_or_rejected(spark, tmp_path):
    lines = [
        '{"job_id":"a","company":"c","title":"t","source":"s","scraped_at":"2024-01-05T10:00:00.123456",'
        '"posting_date":"2024-01-03","extra":1}',
        '{"job_id":"b","company":"c","title":"t","source":"s","scraped_at":"2024-01-05T10:00:00",'
        '"posting_date":"soon"}',
        '{"job_id":"c","title":"t","source":"s","scraped_at":"2024-01-05T10:00:00"}',
        '{"job_id":"d","company":"c","title":"t","source":"s","scraped_at":"never"}',
    ]
    (tmp_path / "batch.json").write_text("\n".join(lines))
    records = read_batch(spark, str(tmp_path))
    good = {r.job_id: r for r in typed(records).collect()}
    assert set(good) == {"a", "b"}
    assert (good["a"].scraped_at.microsecond, str(good["a"].posting_date)) == (123456, "2024-01-03")
    assert good["b"].posting_date is None and good["a"].location is None
    assert {r.job_id for r in rejected(records).collect()} == {"c", "d"}


def test_config_edits(spark):
    config = tech_config(spark)
    assert config.count() == 16
    seeded = insert_or_ignore(config, tech_config(spark), ["tech_name"], ["score_weight"])
    assert seeded.count() == 16
    assert set_target(config, "Go").where("is_target").count() == 4
    grown = add_techs(config, tech_config(spark, [("Zig", ["zig"], "language", None, None),
                                                  ("Go", ["x"], "language", True, 9.0)]))
    rows_ = {r.tech_name: r for r in grown.collect()}
    assert len(rows_) == 17 and rows_["Go"].score_weight == 0.6
    assert (rows_["Zig"].is_target, rows_["Zig"].score_weight) == (False, 1.0)


def test_keyed_result_is_that_of_the_join(spark):
    """Also for keys that the table holds twice or that are NULL, and for scrapes without a time."""
    table = raw(spark, {"job_id": "a"}, {"job_id": "a", "title": "Twin"}, {"job_id": "z"}, {"job_id": "y"}, {"job_id": "?"})
    new = batch(
        spark, {"job_id": "a", "title": "New"}, {"job_id": "b"}, {"job_id": "b", "title": "B"}, {"job_id": "?"},
        {"job_id": "y", "scraped_at": None}, {"job_id": "c", "scraped_at": None},
    )
    key = F.expr("nullif(job_id, '?')")
    table, new = table.withColumn("job_id", key), new.withColumn("job_id", key)
    joined, keyed = upsert_postings(table, new, 0), upsert_postings(table, new, 0, keyed=True)
    assert keyed.columns == joined.columns and keyed.dtypes == joined.dtypes
    assert sorted(map(repr, keyed.collect())) == sorted(map(repr, joined.collect()))
    assert keyed.count() == 8
    nothing = new.where("false")
    assert sorted(map(repr, upsert_postings(table, nothing, 0, keyed=True).collect())) == sorted(map(repr, table.collect()))


def test_keyed_result_is_not_shuffled_for_the_next_step(spark):
    table = one_per_job(batch(spark, {"job_id": "a"}, {"job_id": "z"}))
    new = batch(spark, {"job_id": "a"}, {"job_id": "b"})

    def shuffles(keyed):
        twice = upsert_postings(upsert_postings(table, new, 0, keyed=keyed), new, 0)
        return plan(twice).count("Exchange hashpartitioning(job_id")

    assert shuffles(True) == shuffles(False) - 1


def test_a_limit_of_zero_reads_nothing(spark):
    unreadable = batch(spark, {"job_id": "a"}).withColumn("job_id", F.expr("raise_error('read')").cast("string"))
    assert not is_small(unreadable, 0)
    assert is_small(batch(spark, {"job_id": "a"}), 1) and not is_small(batch(spark, {"job_id": "a"}, {"job_id": "b"}), 1)
