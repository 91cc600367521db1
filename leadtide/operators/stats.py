"""Weekly company statistics with config-driven technology detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.functions.dates import week_start
from leadtide.functions.text import packed
from leadtide.functions.titles import CLASSES, seniority, seniority_narrow
from leadtide.operators.detect import names_of_masks, read_techs, tech_masks, with_techs

GROUP = ["company_normalized", "week_start"]


def weekly_jobs(cleaned: DataFrame) -> DataFrame:
    """Postings that have a date, with the Monday of their week."""
    return cleaned.where(F.col("posting_date").isNotNull()).withColumn(
        "week_start", week_start("posting_date")
    )


def company_stats(
    cleaned: DataFrame, config: DataFrame, *, detail: bool = False, **limits
) -> DataFrame:
    """One row per company and week.

    Where any posting of the company-week names a technology, only the postings that
    name one count; otherwise all do.  ``detail`` adds the technology and location
    lists and the four seniority counts.

    Every posting becomes one narrow row per thing to be counted (its title; with
    ``detail`` its location).  The first aggregation makes these distinct and is keyed by
    the value too, so a company-week of any size spreads over many tasks; the second
    sees distinct values only.  The keyword test runs once, both cases come out of the
    same pass.
    """
    jobs = weekly_jobs(cleaned)
    techs = read_techs(config, **limits)
    if not techs.small:
        return stats_of_detected(with_techs(jobs, techs), detail=detail)
    columns = tech_masks(techs.rows)
    masks = [f"mask{i}" for i in range(len(columns))]
    found = F.lit(False)
    for name in masks:
        found = found | (F.col(name) != 0)
    rows = jobs.withColumns(dict(zip(masks, columns))).withColumn("matched", found)
    things = _things(detail)
    thing = F.explode(F.array(*things)) if detail else things[0]
    out = _rolled_up(rows, thing, detail, masks, names_of_masks(techs.rows, masks))
    # an empty config detects nothing and reports nothing
    return out if techs.rows else out.where(F.lit(False))


def _things(detail: bool) -> list[Column]:
    names = ["title", "location"] if detail else ["title"]
    return [F.struct(F.lit(name).alias("kind"), F.col(name).alias("value")) for name in names]


def stats_of_detected(jobs: DataFrame, *, detail: bool = False) -> DataFrame:
    """The same of weekly postings whose technologies are known (``techs``, sorted names)."""
    named = F.transform("techs", lambda t: F.struct(F.lit("tech").alias("kind"), t.alias("value")))
    thing = F.explode_outer(F.concat(F.array(*_things(detail)), named))  # never empty; see tech_matches for the outer form
    return _rolled_up(jobs.withColumn("matched", F.size("techs") > 0), thing, detail, [], F.array_sort("tech_list"))


def _rolled_up(rows: DataFrame, thing: Column, detail: bool, masks: list[str], tech_array: Column) -> DataFrame:
    """Both aggregations; technologies come as bits of ``masks``, or as things.

    Both sort and spill what they are given.  So where only titles are counted, 128 bits stand for the
    group and its title, and of company names one travels: the smallest of the postings that name a
    technology, or of all, with its rank before it.
    """
    counted = bool(masks) and not detail  # only how many values there are is asked
    rank = F.when(F.col("matched"), F.lit(0)).otherwise(F.lit(2)) + F.col("company").isNull().cast("int")
    narrow = rows.select(
        *GROUP, F.struct(rank.cast("tinyint").alias("rank"), "company").alias("who"), *masks, thing.alias("thing")
    ).select(*GROUP, "who", *masks, "thing.kind", "thing.value")
    # in both groupings a hash comes first, so that sort-based aggregation sorts by a number
    if counted:
        bits = F.unhex(F.md5(packed("company_normalized", F.col("week_start").cast("string"), "value")))
        keys = [bits.alias("_hash"), *GROUP, F.isnotnull("value").alias("named")]
    else:
        keys = [F.xxhash64(*GROUP, "kind", "value").alias("_hash"), *GROUP, "kind", "value"]
    per_value = narrow.groupBy(*keys).agg(F.min("who").alias("who"), *[F.bit_or(m).alias(m) for m in masks])
    per_value = per_value.withColumn("matched", F.col("who.rank") < 2)

    is_title = F.col("named") if counted else (F.col("kind") == "title") & F.col("value").isNotNull()
    is_hit = is_title & F.col("matched")
    counts = [
        F.count_if(is_title).alias("all_jobs"),
        F.count_if(is_hit).alias("hit_jobs"),
    ]
    lists = []
    if detail:
        for at, name in enumerate(CLASSES):
            counts.append(
                F.count_if(is_title & (seniority_narrow(F.col("value")) == name)).alias(f"all_{at}")
            )
            counts.append(
                F.count_if(is_hit & (seniority(F.col("value")) == name)).alias(f"hit_{at}")
            )
        place = F.when(F.col("kind") == "location", F.col("value"))
        lists += [
            F.collect_list(place).alias("all_places"),
            F.collect_list(F.when(F.col("matched"), place)).alias("hit_places"),
        ]
    if not masks:
        lists.append(
            F.collect_list(F.when(F.col("kind") == "tech", F.col("value"))).alias("tech_list")
        )
    grouped = per_value.groupBy(F.xxhash64(*GROUP).alias("_hash"), *GROUP).agg(
        F.min("who").alias("who"),
        *[F.bit_or(m).alias(m) for m in masks],
        *counts,
        *lists,
    )

    def choose(name: str):
        return F.when(F.col("who.rank") < 2, F.col(f"hit_{name}")).otherwise(F.col(f"all_{name}"))

    return grouped.select(
        "company_normalized",
        F.col("who.company").alias("company"),
        "week_start",
        choose("jobs").cast("int").alias("jobs_posted"),
        F.array_join(tech_array, ",").alias("tech_stack"),
        *(
            [
                tech_array.alias("tech_array"),
                F.array_sort(choose("places")).alias("locations"),
                choose("0").alias("senior_count"),
                choose("1").alias("junior_count"),
                choose("2").alias("lead_count"),
                choose("3").alias("mid_count"),
            ]
            if detail
            else []
        ),
    )
