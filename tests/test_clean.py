import random
from datetime import date, datetime
from itertools import product

from pyspark.sql import functions as F

from leadtide.functions.text import packed, unpacked
from leadtide.operators.clean import FIRST_ORDER, clean_postings, dedup_accounting
from leadtide.operators.quality import deduplication_effective, no_null_companies
from tests.helpers import JAN, raw


def test_spelling_variants_are_one_row(spark):
    rows = clean_postings(raw(spark, {"company": "  ACME\t"}, {"company": "acme"})).collect()
    assert [(r.company_normalized, r.company) for r in rows] == [("acme", "  ACME\t")]


def test_location_is_part_of_the_key(spark):
    cleaned = clean_postings(raw(spark, {"location": "Toronto"}, {"location": None}))
    assert cleaned.count() == 2
    check = deduplication_effective(cleaned).first()
    assert (check.passed, check.severity, check.measured, check.note) == (
        False, "ERROR", 1, "acme|engineer|2",
    )
    assert clean_postings(raw(spark, {"location": ""}, {"location": None})).count() == 1


def test_separator_in_text_does_not_collide(spark):
    rows = raw(spark, {"company": "a|b", "title": "c"}, {"company": "a", "title": "b|c"})
    assert clean_postings(rows).count() == 2


def test_tie_keeps_lower_id_and_spans_the_group(spark):
    rows = raw(
        spark,
        {"job_id": "b", "first_scraped_at": JAN(2), "last_scraped_at": JAN(3)},
        {"job_id": "a", "first_scraped_at": JAN(2), "last_scraped_at": JAN(2)},
        {"job_id": "c", "first_scraped_at": JAN(1), "last_scraped_at": JAN(9), "location": "x"},
    )
    kept = {r.location: r for r in clean_postings(rows).collect()}
    assert kept["Toronto"].job_id == "a"
    assert (kept["Toronto"].first_seen, kept["Toronto"].last_seen) == (JAN(2), JAN(3))


def test_against_brute_force_with_one_hot_key(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.4
        rows.append({
            "job_id": f"{rng.randrange(400)}",
            "company": "HOT " if hot else rng.choice(["x", " X", "y", "Y\t"]),
            "title": "dev" if hot else rng.choice(["Dev", "Ops", "dev "]),
            "location": None if hot else rng.choice([None, "", "A"]),
            "description": rng.choice([None, "p", "q"]),
            "first_scraped_at": rng.choice([None, JAN(1), JAN(2)]),
            "last_scraped_at": rng.choice([JAN(3), JAN(4)]),
            "posting_date": date(2024, 1, rng.randrange(1, 20)),
        })
    df = raw(spark, *rows)
    groups = {}
    for r in df.collect():
        key = (r.company.strip().lower(), r.title.strip().lower(), r.location or "")
        groups.setdefault(key, []).append(r)

    def order(r):
        return [(r[c] is not None, r[c] if r[c] is not None else datetime.min if c.endswith("_at") else "")
                for c in FIRST_ORDER]

    want = set()
    for (company, title, _), members in groups.items():
        first = min(members, key=order)
        firsts = [m.first_scraped_at for m in members if m.first_scraped_at]
        want.add((company, title, first.job_id, first.company, first.description, first.location,
                  min(firsts) if firsts else None, max(m.last_scraped_at for m in members)))
    have = {
        (r.company_normalized, r.title_normalized, r.job_id, r.company, r.description, r.location,
         r.first_seen, r.last_seen)
        for r in clean_postings(df.repartition(5)).collect()
    }
    assert have == want


def test_accounting_also_on_empty_input(spark):
    df = raw(spark, {}, {}, {"title": "Other"})
    got = dedup_accounting(df, clean_postings(df)).first()
    assert tuple(got) == (3, 2, 1, "33.3%")
    empty = df.where("false")
    assert tuple(dedup_accounting(empty, clean_postings(empty)).first()) == (0, 0, 0, "0.0%")


def test_null_company_check(spark):
    df = clean_postings(raw(spark, {"company": "  "}, {"company": "b"}))
    check = no_null_companies(df).first()
    assert (check.passed, check.measured, check.limit, check.note) == (False, 1, 2, "50.00%")


def test_packed_texts_come_back_and_compare_as_they_do_one_by_one(spark):
    texts = [None, "", "\0", "\1", "\2", "a", "a\0", "a\1", "\0\1", "\1\0", "\0\2", "\1\2", "\1\1", "ab", "é", "\uffff", "\U0001f600"]
    rows = spark.createDataFrame(list(product(texts, texts)), "a string, b string").withColumn("p", packed("a", "b"))
    back = rows.select("a", "b", *[c.alias(n) for c, n in zip(unpacked(F.col("p"), 2), "xy")])
    assert back.where("NOT (a <=> x AND b <=> y)").count() == 0
    one_by_one, at_once = ([r[:2] for r in rows.orderBy(*by).collect()] for by in (["a", "b"], ["p"]))
    assert one_by_one == at_once


def test_control_characters_and_nulls_do_not_mix_keys(spark):
    rows = raw(
        spark,
        {"company": "a\0", "title": "b"}, {"company": "a", "title": "\0b"}, {"company": "a\1\0", "title": "b"},
        {"company": "x", "title": "x\0", "location": None}, {"company": "x", "title": "x", "location": "\0"},
    )
    found = clean_postings(rows).collect()
    assert sorted((r.company, r.title) for r in found) == sorted((r.company, r.title) for r in rows.collect())
