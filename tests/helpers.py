"""Small fixtures."""

from __future__ import annotations

from datetime import date, datetime

from leadtide.schemas import CLEANED_JOBS, COMPANY_STATS, LEAD_SCORES, RAW_JOBS

JAN = lambda day: datetime(2024, 1, day)


def raw(spark, *rows):
    """Rows as dicts; the rest is filled in."""
    base = {
        "company": "acme", "title": "Engineer", "description": None, "location": "Toronto",
        "posting_date": date(2024, 1, 3), "url": None, "source": "t",
        "first_scraped_at": JAN(5), "last_scraped_at": JAN(5),
    }
    full = [{**base, "job_id": str(i), **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in RAW_JOBS.names) for r in full], RAW_JOBS)


def cleaned(spark, *rows):
    base = {
        "company": "acme", "title": "Engineer", "description": None, "location": "Toronto",
        "posting_date": date(2024, 1, 3), "url": None, "source": "t",
        "first_seen": JAN(5), "last_seen": JAN(5),
    }
    full = [{**base, "job_id": str(i), **row} for i, row in enumerate(rows)]
    for r in full:
        r.setdefault("company_normalized", r["company"].strip().lower())
        r.setdefault("title_normalized", (r["title"] or "").strip().lower())
    return spark.createDataFrame(
        [tuple(r[c] for c in CLEANED_JOBS.names) for r in full], CLEANED_JOBS
    )


def stats(spark, *rows):
    """Rows (company, week day of January 2024, jobs, stack)."""
    return spark.createDataFrame(
        [(c, c, date(2024, 1, day), jobs, stack) for c, day, jobs, stack in rows], COMPANY_STATS
    )


def leads(spark, *scores):
    return spark.createDataFrame(
        [
            (f"c{i:02}", f"C{i:02}", date(2024, 1, 8), 1, 0, 100.0, 50.0, 10.0, s, "Python")
            for i, s in enumerate(scores)
        ],
        LEAD_SCORES,
    )


def batch(spark, *rows):
    """Typed batch rows as dicts."""
    base = {
        "company": "acme", "title": "Engineer", "description": None, "location": None,
        "posting_date": date(2024, 1, 3), "url": None, "source": "t", "scraped_at": JAN(9),
    }
    names = ["job_id", *base]
    full = [{**base, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in names) for r in full],
        "job_id string, company string, title string, description string, location string, "
        "posting_date date, url string, source string, scraped_at timestamp_ntz",
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
