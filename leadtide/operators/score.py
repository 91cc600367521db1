"""Lead scores: hiring velocity, weighted technology match, volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadtide.functions import scores
from leadtide.operators.detect import MAX_TECHS, constant
from leadtide.operators.gramindex import substring_hits, text_key, with_found
from leadtide.sources.tables import store


def target_techs(config: DataFrame) -> DataFrame:
    return config.where("is_target").select("tech_name", "score_weight")


def read_targets(config: DataFrame, max_targets: int = MAX_TECHS) -> list[tuple[str, float | None]] | None:
    """(name, weight) of all target rows in a total order, or None where they are too many to fold into
    a plan.  Rows without a name are none; every row of a name counts.  Runs a job."""
    rows = target_techs(config).where(F.col("tech_name").isNotNull()).limit(max_targets + 1).collect()
    if len(rows) > max_targets:
        return None
    return sorted(((n, w) for n, w in rows), key=lambda r: (r[0], r[1] is None, r[1] or 0.0))


def with_previous(stats: DataFrame) -> DataFrame:
    """Add the job count of the company's previous row (not of the previous calendar week).

    A company has one row a week, so a window partition holds some hundreds of rows at most.
    """
    by_company = Window.partitionBy("company_normalized").orderBy("week_start")
    return stats.withColumn("jobs_last_week", F.lag("jobs_posted", 1).over(by_company))


def _has_tech(stack: Column, name: Column, exact: bool) -> Column:
    return F.array_contains(F.split(stack, ","), name) if exact else F.contains(stack, name)


def with_matched_weight(
    stats: DataFrame, config: DataFrame, *, exact: bool = False, max_targets: int = MAX_TECHS
) -> DataFrame:
    """Add the summed weight of targets named in ``tech_stack`` and the largest possible sum.

    Names match as substrings; ``exact`` compares whole list entries.
    """
    zero = F.lit(0.0)
    targets = read_targets(config, max_targets)
    if targets is None:
        return _weights_by_stack(stats, config, exact)
    known = [w for _, w in targets if w is not None]
    possible = F.lit(sum(known) if known else None).cast("double")
    weighted = constant(
        [{"name": n, "weight": w} for n, w in targets], "array<struct<name:string,weight:double>>"
    )
    matched = F.aggregate(
        F.filter(weighted, lambda t: _has_tech(F.col("tech_stack"), t["name"], exact)),
        zero,
        lambda total, t: total + F.coalesce(t.weight, zero),
    )
    return stats.withColumns({"matched_weight": matched, "possible_weight": possible})


def _weights_by_stack(stats: DataFrame, config: DataFrame, exact: bool) -> DataFrame:
    """The same for any number of targets: each different technology list is weighed once.

    The lists meet the targets by an index of grams, or, if exact, by their entries; the weights of
    a list are added up in the order of the names.
    """
    targets = target_techs(config).where(F.col("tech_name").isNotNull())
    possible = targets.agg(F.sum("score_weight")).scalar()
    key = text_key(F.col("tech_stack"))
    stacks = stats.where(F.col("tech_stack").isNotNull()).select(key.alias("key"), "tech_stack").distinct()
    what = F.struct("tech_name", F.isnull("score_weight").alias("none"), "score_weight", "times")
    known = targets.groupBy("tech_name", "score_weight").agg(F.count("*").alias("times"))
    needles = known.select(F.col("tech_name").alias("needle"), what.alias("what"))
    if exact:  # an entry may stand in a large part of all lists
        salts = F.explode(F.sequence(F.lit(0), F.lit(15)))
        entries = stacks.select("key", F.explode(F.array_distinct(F.split("tech_stack", ","))).alias("needle"))
        entries = entries.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(16)).cast("int"))
        found = entries.join(needles.withColumn("salt", salts), ["needle", "salt"]).groupBy("key").agg(
            F.collect_list("what").alias("found")
        )
    else:
        found = substring_hits(store(stacks.select("key", F.array("tech_stack").alias("parts")), "texts"), needles)
    one = F.coalesce("matched_weight", F.array().cast(found.schema["found"].dataType))
    # a row of the config that is repeated counts each time
    weights = F.flatten(F.transform(F.array_sort(one), lambda t: F.array_repeat(t["score_weight"], t["times"].cast("int"))))
    matched = F.aggregate(weights, F.lit(0.0), lambda total, w: total + F.coalesce(w, F.lit(0.0)))
    every = with_found(stats, key, found, "matched_weight", stats.columns)
    return every.withColumns({"matched_weight": matched, "possible_weight": possible.cast("double")})


def score_all_weeks(
    stats: DataFrame, config: DataFrame, *, exact: bool = False, max_targets: int = MAX_TECHS
) -> DataFrame:
    """Unrounded scores for every company-week.

    ``stats`` is read twice (rows, largest count); pass a stored table.  The largest count
    is a scalar subquery: a window over everything would put all rows into one task.
    """
    return _scored(with_previous(stats), stats, config, exact, max_targets)


def _scored(
    rows: DataFrame, stats: DataFrame, config: DataFrame, exact: bool, max_targets: int
) -> DataFrame:
    """Scores of rows with ``jobs_last_week``; the largest count is that of ``stats``."""
    most = stats.agg(F.max("jobs_posted")).scalar()
    rows = with_matched_weight(rows, config, exact=exact, max_targets=max_targets).withColumn("most", most)
    jobs = F.col("jobs_posted")
    return rows.select(
        "company_normalized",
        "company",
        "week_start",
        jobs.alias("jobs_this_week"),
        F.coalesce("jobs_last_week", F.lit(0)).alias("jobs_last_week"),
        scores.velocity(jobs, F.col("jobs_last_week")).alias("velocity_score"),
        scores.tech_match(F.col("matched_weight"), F.col("possible_weight")).alias(
            "tech_match_score"
        ),
        scores.volume(jobs, F.col("most")).alias("volume_score"),
        "tech_stack",
    )


def latest_week(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Rows of the newest week; ``source`` is a cheaper place to look that week up."""
    newest = (df if source is None else source).agg(F.max("week_start")).scalar()
    return df.where(F.col("week_start") == newest)


def lead_scores(
    stats: DataFrame, config: DataFrame, *, exact: bool = False, max_targets: int = MAX_TECHS
) -> DataFrame:
    """Rounded scores of the newest week; no rows when no technology is a target.

    Of earlier weeks only the newest row of each company counts; it is found by an aggregation
    that combines before the shuffle.  Weights are computed for the newest week alone.
    """
    newest = stats.agg(F.max("week_start")).scalar()
    before = (
        stats.where(F.col("week_start") < newest).groupBy("company_normalized")
        .agg(F.max_by("jobs_posted", "week_start").alias("jobs_last_week"))
    )
    rows = latest_week(stats).join(before, "company_normalized", "left")
    return leads_of_week(rows, stats, config, exact=exact, max_targets=max_targets)


def leads_of_week(
    rows: DataFrame, counts: DataFrame, config: DataFrame, *, exact: bool = False, max_targets: int = MAX_TECHS
) -> DataFrame:
    """Rounded scores of the rows of one week, which have ``jobs_last_week``; ``counts`` has the
    ``jobs_posted`` whose largest is full volume."""
    scored = _scored(rows, counts, config, exact, max_targets)
    total = scores.composite(
        F.col("velocity_score"), F.col("tech_match_score"), F.col("volume_score")
    )
    any_target = target_techs(config).agg(F.count("*") > 0).scalar()
    return scored.where(any_target).select(
        "company_normalized",
        "company",
        "week_start",
        "jobs_this_week",
        "jobs_last_week",
        scores.round_to(F.col("velocity_score")).alias("velocity_score"),
        scores.round_to(F.col("tech_match_score")).alias("tech_match_score"),
        scores.round_to(F.col("volume_score")).alias("volume_score"),
        scores.round_to(total).alias("composite_score"),
        F.col("tech_stack").alias("score_metadata"),
    )
