import json

import pytest
from pyspark.sql import functions as F

from leadtide.operators.upsert import one_per_job
from leadtide.operators.report import scores_overview
from leadtide.plans.pipeline import run
from leadtide.schemas import COMPANY_STATS, RAW_JOBS
from leadtide.sources.batches import read_batch, read_lines, typed
from leadtide.sources.config import tech_config
from leadtide.sources.ledger import bucket_of, current, fold, known_of, seed, take_in
from leadtide.sources.tables import read_csv, read_table, refresh_table, require_unique
from leadtide.plans.queries_table import FEED, SUMMARY
from leadtide.streaming.ingest import arriving, upsert_arriving
from tests.helpers import plan, raw


def record(job_id, day, **fields):
    return json.dumps({
        "job_id": job_id, "company": "Acme", "title": "Dev", "source": "t",
        "scraped_at": f"2024-01-{day:02}T10:00:00", "posting_date": f"2024-01-{day:02}", **fields,
    })


FIRST = [
    record("a", 2, description="Python and React"),
    record("b", 3, company=" ACME ", description="python"),  # same posting as a
    record("c", 3, company="Beta", title="Sr. Cook"),
]
SECOND = [
    record("a", 9, title="ignored"),
    record("d", 10, title="Go dev", description="golang"),
    record("e", 10, company="Beta", title="TypeScript dev", location="Paris, FR"),
]


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))
    return str(folder / name)


def test_two_runs(spark, tmp_path):
    config = tech_config(spark)
    out = str(tmp_path / "out")
    one = typed(read_batch(spark, write(tmp_path / "in", "1.json", FIRST)))
    two = typed(read_batch(spark, write(tmp_path / "in", "2.json", SECOND)))
    run(spark, one, config, out, "v1")
    paths = run(spark, two, config, out, "v2", previous="v1")

    raw = {r.job_id: r for r in current(spark, paths["ledger"]).collect()}
    assert set(raw) == set("abcde") and raw["a"].title == "Dev"
    assert (raw["a"].first_scraped_at.day, raw["a"].last_scraped_at.day) == (2, 9)
    assert read_table(spark, paths["cleaned_jobs"], "cleaned_jobs").count() == 4
    stats = {
        (r.company_normalized, str(r.week_start)): (r.jobs_posted, r.tech_stack)
        for r in read_table(spark, paths["company_stats"], "company_stats").collect()
    }
    assert stats == {
        ("acme", "2024-01-01"): (1, "Python,React"), ("acme", "2024-01-08"): (1, "Go"),
        ("beta", "2024-01-01"): (1, ""), ("beta", "2024-01-08"): (1, "TypeScript"),
    }
    feed = {r.company: r for r in read_csv(spark, paths["lead_scores_path"], FEED).collect()}
    assert feed["Beta"].tech_match_score == 28.57 and feed["Acme"].velocity_score == 0.0
    summary = spark.read.schema(SUMMARY).json(paths["summary_path"]).first()
    assert (summary.total_companies, summary.latest_week) == (2, "2024-01-08")
    assert summary.generated_at == "2024-01-10T10:00:00"
    checks = {r.check: r.passed for r in spark.read.parquet(paths["checks"]).collect()}
    assert len(checks) == 6 and checks["targets_configured"] and not checks["minimum_leads"]


def test_lines_refused_and_runs_repeated(spark, tmp_path):
    config, out = tech_config(spark), str(tmp_path / "out")
    first = read_lines(spark, write(tmp_path / "in", "1.json", [*FIRST, "{broken", "", record("f", 9, title=None)]))
    run(spark, first, config, out, "v1")
    second = read_lines(spark, write(tmp_path / "in", "2.json", SECOND))
    for _ in range(2):  # the second time as after a failure
        paths = run(spark, second, config, out, "v2", previous="v1")
    refusals = spark.read.parquet(f"{out}/v1/refusals")
    assert sorted(r.reason for r in refusals.collect()) == ["missing: title", "not a JSON record"]
    assert spark.read.parquet(paths["refusals"]).count() == 0
    assert tuple(spark.read.parquet(f"{out}/v1/ingest").first()) == (3, 3, 0)
    assert tuple(spark.read.parquet(paths["ingest"]).first()) == (3, 2, 1)
    assert sorted(r.job_id for r in current(spark, paths["ledger"]).collect()) == list("abcde")
    assert sorted(r.job_id for r in current(spark, paths["ledger"], before=2).collect()) == list("abc")


def test_accounts_come_with_the_tables(spark, tmp_path):
    one = typed(read_batch(spark, write(tmp_path / "in", "1.json", FIRST)))
    paths = run(spark, one, tech_config(spark), str(tmp_path / "out"), "v1")
    assert tuple(spark.read.parquet(paths["dedup_accounting"]).first()) == (3, 2, 1, "33.3%")
    leads = read_table(spark, paths["lead_scores"], "lead_scores")
    assert spark.read.parquet(paths["scores_overview"]).first() == scores_overview(leads).first()
    none = run(spark, one, tech_config(spark, [("A", ["zzz"], "l", False, 1.0)]), str(tmp_path / "none"), "v1")
    assert read_table(spark, none["lead_scores"], "lead_scores").count() == 0
    assert spark.read.parquet(none["scores_overview"]).first()["total_companies_scored"] == 0


def test_nothing_is_published_with_a_broken_key(spark, tmp_path):
    config, out = tech_config(spark), str(tmp_path / "out")
    one = typed(read_batch(spark, write(tmp_path / "in", "1.json", FIRST)))
    two = typed(read_batch(spark, write(tmp_path / "in", "2.json", SECOND)))
    paths = run(spark, one, config, out, "v1")
    before = sorted(map(tuple, read_table(spark, paths["cleaned_jobs"], "cleaned_jobs").collect()))
    for version, previous in (("v2", "v1"), ("v1", None)):  # a new version, and one that is there
        with pytest.raises(ValueError, match="tech_config has 2 rows of one key"):
            run(spark, two, config.union(config.limit(1)), out, version, previous=previous)
    assert not (tmp_path / "out" / "v2" / "cleaned_jobs").exists()
    assert sorted(map(tuple, read_table(spark, paths["cleaned_jobs"], "cleaned_jobs").collect())) == before
    paths = run(spark, one, config, out, "v1")
    run(spark, two, config, out, "v2", previous="v1")
    assert sorted(r.job_id for r in current(spark, paths["ledger"]).collect()) == list("abcde")


def test_weekly_partitions_are_pruned(spark, tmp_path):
    one = typed(read_batch(spark, write(tmp_path / "in", "1.json", FIRST + SECOND[1:])))
    paths = run(spark, one, tech_config(spark), str(tmp_path / "out"), "v1")
    stats = read_table(spark, paths["company_stats"], "company_stats")
    assert {f.name: f.dataType for f in stats.schema} == {f.name: f.dataType for f in COMPANY_STATS}
    week = stats.where("week_start = date'2024-01-08'")
    text = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week_start" in text and week.count() == 2


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_stream_goes_on_from_a_ledger(spark, tmp_path):
    inbox, ledger, mark = tmp_path / "in", tmp_path / "ledger", str(tmp_path / "mark")
    refusals = str(tmp_path / "refusals")
    old = typed(read_batch(spark, write(tmp_path / "old", "0.json", [record("c", 1, company="Beta", title="Sr. Cook")])))
    seed(one_per_job(old), str(ledger))

    def arrive():
        upsert_arriving(arriving(spark, str(inbox)), str(ledger), refusals, mark).awaitTermination(120)

    write(inbox, "1.json", FIRST)
    arrive()
    write(inbox, "2.json", [*SECOND, "{broken", record("f", 9, title=None)])
    arrive()
    table = current(spark, str(ledger))
    got = {r.job_id: r for r in table.collect()}
    assert set(got) == set("abcde") and got["a"].title == "Dev"
    assert (got["a"].first_scraped_at.day, got["a"].last_scraped_at.day) == (2, 9)
    assert (got["c"].first_scraped_at.day, got["c"].last_scraped_at.day) == (1, 3)
    assert table.schema.names == RAW_JOBS.names
    assert {r.reason for r in spark.read.parquet(refusals).collect()} == {"not a JSON record", "missing: title"}
    fold(spark, str(ledger), str(tmp_path / "folded"))
    assert sorted(map(tuple, current(spark, str(tmp_path / "folded")).collect())) == sorted(map(tuple, table.collect()))


def test_a_batch_writes_what_it_brings(spark, tmp_path):
    table = spark.range(50_000).selectExpr(
        "string(id) AS job_id", "sha2(string(id), 256) AS company", "'t' AS title", "'s' AS source",
        "timestamp_ntz'2024-01-01' AS scraped_at",
    ).selectExpr("*", "string(null) AS description", "string(null) AS location", "date(null) AS posting_date", "string(null) AS url")
    take_in(table, str(tmp_path / "ledger"), 1)
    before = size_of(tmp_path / "ledger")
    take_in(table.where("job_id IN ('7', '8')").unionByName(table.limit(1).selectExpr("'new' AS job_id", *table.columns[1:])),
            str(tmp_path / "ledger"), 2)
    assert size_of(tmp_path / "ledger") - before < before / 20
    assert current(spark, str(tmp_path / "ledger")).count() == 50_001


def test_the_ledger_is_not_shuffled_and_read_where_touched(spark, tmp_path):
    table = spark.range(3000).selectExpr("string(id) AS job_id").selectExpr(
        "job_id", *[f"'x' AS {c}" for c in ("company", "title", "description", "location")], "date'2024-01-01' AS posting_date",
        "'u' AS url", "'s' AS source", "timestamp_ntz'2024-01-01' AS first_scraped_at", "timestamp_ntz'2024-01-01' AS last_scraped_at",
    )
    folder = str(tmp_path / "ledger")
    seed(table, folder, buckets=16)
    batch = table.where("job_id IN ('7', '8')").unionByName(table.limit(1).withColumn("job_id", F.lit("new")))
    touched = {r[0] for r in batch.select(bucket_of(16)).collect()}
    marked = known_of(batch, folder, 1)
    assert {r.job_id: r.known for r in marked.collect()} == {"7": True, "8": True, "new": False}
    text, scan = "", ""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to be sent
    try:
        text, whole = plan(known_of(batch, folder, 1)), plan(current(spark, folder))
        scan = next(line for line in text.split("\n") if "FileScan" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in scan and "PartitionFilters" in scan and f"InMemoryFileIndex({len(touched)} paths)" in scan
    assert "Exchange" not in text[: text.index(scan)] and "Exchange" not in whole


def test_constraints_stop_the_run(spark, tmp_path):
    bad = raw(spark, {"job_id": "1"}).withColumn("company", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="company is NULL"):
        refresh_table(bad, str(tmp_path / "t"), "raw_jobs")
    with pytest.raises(ValueError, match="2 rows of one key"):
        require_unique(raw(spark, {"job_id": "1"}, {"job_id": "1"}), "raw_jobs")
