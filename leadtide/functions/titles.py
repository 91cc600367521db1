"""Seniority classes read off a title."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Class words, tried in this order.
WIDE = {"Senior": ["senior", "sr."], "Junior": ["junior", "jr."], "Lead": ["lead", "principal"]}
NARROW = {"Senior": ["senior"], "Junior": ["junior"], "Lead": ["lead"]}
CLASSES = ["Senior", "Junior", "Lead", "Mid-Level"]


def _classify(title: Column, words: dict[str, list[str]]) -> Column:
    lowered = F.lower(title)
    result = None
    for name, stems in words.items():
        hit = F.lit(False)
        for stem in stems:
            hit = hit | F.contains(lowered, F.lit(stem))
        result = F.when(hit, name) if result is None else result.when(hit, name)
    return result.otherwise("Mid-Level")


def seniority(title: Column) -> Column:
    """Class of a posting in which some technology was found."""
    return _classify(title, WIDE)


def seniority_narrow(title: Column) -> Column:
    """Class used for company-weeks without any technology: fewer stems."""
    return _classify(title, NARROW)
