from pyspark.sql import functions as F

from leadtide.operators import report
from leadtide.operators.quality import anything_scored, batch_present, config_present, constraint_report
from leadtide.sources.config import tech_config
from leadtide.sources.tables import lead_feed
from tests.helpers import JAN, leads, raw, stats


def test_summary_of_nothing(spark):
    row = report.lead_summary(leads(spark, 1.0).where("false")).first()
    assert (row.total_companies, row.hot_leads, row.warm_leads, row.cold_leads) == (0, 0, 0, 0)
    assert (row.avg_composite_score, row.latest_week) == (0.0, "N/A")
    overview = report.scores_overview(leads(spark, 1.0).where("false")).first()
    assert (overview.top_lead_company, overview.top_lead_score) == ("None", 0.0)


def test_bands_add_up(spark):
    df = leads(spark, 49.99, 50.0, 79.99, 80.0, 100.0)
    row = report.lead_summary(df).first()
    assert (row.hot_leads, row.warm_leads, row.cold_leads) == (2, 2, 1)
    overview = report.scores_overview(df).first()
    assert (overview.top_lead_company, overview.top_lead_score) == ("C04", 100.0)


def test_histogram_is_whole(spark):
    df = report.score_histogram(leads(spark, 100.0, -5.0, 3.0, 52.0))
    counts = {r.bin: r.leads for r in df.collect()}
    assert len(counts) == 20 and sum(counts.values()) == 4
    assert (counts[19], counts[0], counts[10]) == (1, 2, 1)


def test_ties_are_ordered_by_company(spark):
    rows = report.ranked_leads(leads(spark, *[5.0] * 12)).orderBy("rank").collect()
    assert [r.company for r in rows] == [f"C{i:02}" for i in range(10)]
    assert [r["rank"] for r in rows] == list(range(1, 11))


def test_components_are_long(spark):
    rows = report.score_components(leads(spark, 5.0, 6.0)).collect()
    assert len(rows) == 6 and {r.component for r in rows} == set(report.COMPONENTS)


def test_distribution_trims_and_skips_empty(spark):
    df = stats(spark, ("a", 1, 1, "Go, Rust"), ("b", 1, 1, "Rust"), ("c", 1, 1, ""))
    assert {r.tech: r.company_count for r in report.tech_distribution(df).collect()} == {
        "Go": 1, "Rust": 2,
    }
    assert report.stats_overview(df).first().technologies_detected == 2


def test_summary_document(spark):
    df = stats(spark, ("a", 1, 1, "Go,Rust"), ("b", 1, 1, "Rust"))
    as_of = F.lit(JAN(9)).cast("timestamp_ntz")
    row = report.summary_document(leads(spark, 90.0), df, as_of).withColumn(
        "tech_distribution", F.to_json("tech_distribution")
    ).first()
    assert row.generated_at == "2024-01-09T00:00:00" and row.latest_week == "2024-01-08"
    assert row.tech_distribution == '{"Rust":2,"Go":1}'


def test_search(spark):
    feed = lead_feed(leads(spark, 40.0, 60.0))
    assert report.search_leads(feed).count() == 1
    assert report.search_leads(feed, 0, 0, ["Pyth"]).count() == 2
    assert report.search_leads(feed, 0, 0, ["^P.*n$"], regex=True).count() == 2
    assert report.search_leads(feed, 0, 2).count() == 0


def test_recent(spark):
    df = raw(spark, {"last_scraped_at": JAN(1)}, {"last_scraped_at": JAN(8)}, {"last_scraped_at": JAN(2)})
    as_of = F.lit(JAN(9)).cast("timestamp_ntz")
    assert report.recent_count(df, as_of, 7).first()[0] == 2
    assert [r.job_id for r in report.recent_postings(df, 2).collect()] == ["1", "2"]
    lines = report.warehouse_report(df).collect()
    assert [(r.section, r.value) for r in lines][:2] == [("total", 3), ("range", None)]
    assert len(lines) == 2 + 1 + 3


def test_guards(spark):
    nothing = leads(spark, 1.0).where("false")
    assert anything_scored(nothing).first().severity == "WARN"
    assert config_present(tech_config(spark, [])).first().severity == "ERROR"
    assert batch_present(raw(spark, {})).first().passed


def test_constraints(spark):
    df = raw(spark, {"job_id": "a"}, {"job_id": "a"}, {"job_id": "b"})
    got = {(r.constraint, r["columns"]): r.violations for r in constraint_report(df, "raw_jobs").collect()}
    assert got["primary_key", "job_id"] == 1 and got["not_null", "title"] == 0


def test_exports_are_single_files_in_order(spark, tmp_path):
    import csv

    from leadtide.sources.tables import read_csv, write_csv, write_json

    path = str(tmp_path / "out" / "rows.csv")
    rows = spark.range(5000).repartition(7).selectExpr("id", "concat(' a,\"', id, '\"') AS name", "if(id = 3, null, '') AS gap")
    for _ in range(2):  # the second time replaces the first
        write_csv(rows.orderBy("id"), path)
    with open(path, newline="") as file:
        got = list(csv.reader(file))
    assert got[0] == ["id", "name", "gap"] and [r[0] for r in got[1:]] == [str(i) for i in range(5000)]
    assert got[8][1] == ' a,"7"'
    back = read_csv(spark, path, "id long, name string, gap string")
    assert back.count() == 5000 and back.where("id = 7").first().name == ' a,"7"'
    assert [f.name for f in (tmp_path / "out").iterdir() if not f.name.startswith(".")] == ["rows.csv"]
    write_csv(rows.limit(0), path)
    assert open(path).read() == "id,name,gap\n"
    write_json(spark.range(1), str(tmp_path / "one.json"))
    assert open(tmp_path / "one.json").read() == '{"id":0}\n'
