"""Score arithmetic: rounding, guarded ratios, the three scores, bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Score weights and band edges.
VELOCITY_WEIGHT = 0.4
TECH_MATCH_WEIGHT = 0.35
VOLUME_WEIGHT = 0.25
HOT = 80
WARM = 50


def round_to(value: Column, digits: int = 2) -> Column:
    """Round half up, once, on the shortest decimal that stands for the double: 1.005 becomes 1.01.

    From 1e15 on a double has at most two decimals and stays as it is, as do NaN and the infinities.
    """
    exact = value.cast("string").cast("decimal(38,20)")
    return F.when(F.abs(value) >= 1e15, value.cast("double")).otherwise(F.round(exact, digits).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Percentage; a zero whole counts as one."""
    return part.cast("double") / F.greatest(whole, F.lit(1)) * 100


def velocity(current: Column, previous: Column) -> Column:
    """Growth in percent over the previous row, at most 100; 100 without a previous row."""
    growth = (current - previous).cast("double") / previous * 100
    return F.when(previous.isNull() | (previous == 0), F.lit(100.0)).otherwise(
        F.least(growth, F.lit(100.0))
    )


def tech_match(matched: Column, possible: Column) -> Column:
    return F.when(possible == 0, F.lit(0.0)).otherwise(matched / possible * 100)


def volume(jobs: Column, most: Column) -> Column:
    # a largest count of zero has no ratio, and ANSI division would raise
    return F.try_divide(jobs.cast("double"), most) * 100


def composite(velocity_score: Column, tech_score: Column, volume_score: Column) -> Column:
    return (
        velocity_score * VELOCITY_WEIGHT
        + tech_score * TECH_MATCH_WEIGHT
        + volume_score * VOLUME_WEIGHT
    )


def band(score: Column) -> Column:
    return F.when(score >= HOT, "hot").when(score >= WARM, "warm").otherwise("cold")


def histogram_bin(score: Column, bins: int = 20) -> Column:
    """Equal bins over 0..100; what lies outside goes to the edge bins."""
    width = 100.0 / bins
    return F.greatest(F.lit(0), F.least(F.floor(score / width), F.lit(bins - 1))).cast("int")
