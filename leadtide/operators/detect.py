"""Keyword detection: which technologies of a config table a posting names.

A technology is found when one of its keywords is a substring of the lower-cased title or
description.  Rows of the config without a name are left out, rows of one name are one
technology with the keywords of all.  A short config is read while the plan is built and
folded into it: postings are tested where they lie, in one pass, with no join and no shuffle.
A long one is never read by the driver: it is a table, joined by an index of grams
(``gramindex``).  Both test the same condition.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.operators.gramindex import HOT_ROWS, substring_hits, text_key, with_found
from leadtide.sources.tables import store

# What is folded into a plan; more is joined as a table.
MAX_TECHS = 250
MAX_KEYWORDS = 2_000
MAX_KEYWORD_CHARS = 100_000

MASK_BITS = 62  # technologies per BIGINT mask


@dataclass(frozen=True)
class Tech:
    name: str
    keywords: tuple[str, ...]


@dataclass(frozen=True)
class Techs:
    """The canonical config: rows ordered by name where it is folded into plans, else the table."""

    rows: list[Tech]
    small: bool
    table: DataFrame


def _needed(keywords: Iterable[str | None]) -> tuple[str, ...]:
    """Drop keywords that contain another one: the shorter one finds all they find."""
    kept: list[str] = []
    for word in sorted({k for k in keywords if k is not None}, key=lambda k: (len(k), k)):
        if not any(short in word for short in kept):
            kept.append(word)
    return tuple(kept)


def _canonical(rows) -> list[Tech]:
    words: dict[str, set[str]] = {}
    for name, keywords in rows:
        if name is not None:
            words.setdefault(name, set()).update(k for k in keywords or [] if k is not None)
    return [Tech(name, _needed(words[name])) for name in sorted(words)]


def read_techs(
    config: DataFrame,
    max_techs: int = MAX_TECHS,
    max_keywords: int = MAX_KEYWORDS,
    max_chars: int = MAX_KEYWORD_CHARS,
) -> Techs:
    """Read the config up to the limits (runs a job), which choose the plan only."""
    words = F.coalesce("keywords", F.array().cast("array<string>"))
    chars = F.aggregate(words, F.lit(0), lambda n, k: n + F.coalesce(F.length(k), F.lit(0)))
    within = (F.size(words) <= max_keywords) & (chars <= max_chars)
    rows = (
        config.select("tech_name", F.when(within, words).alias("keywords"), chars.alias("chars"))
        .limit(max_techs + 1)
        .collect()
    )
    small = (
        len(rows) <= max_techs
        and all(r["keywords"] is not None for r in rows)
        and sum(len(r["keywords"]) for r in rows) <= max_keywords
        and sum(r["chars"] for r in rows) <= max_chars
    )
    known = _canonical((r["tech_name"], r["keywords"]) for r in rows) if small else []
    return Techs(known, small, config)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    The one-element array binds it to a lambda variable; a plain column would be inlined
    by the optimizer and evaluated again for every keyword.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _with_texts(title, description, body) -> Column:
    """``body`` over the two lowered texts, NULL taken as empty."""
    texts = F.struct(
        F.coalesce(F.lower(title), F.lit("")).alias("t"),
        F.coalesce(F.lower(description), F.lit("")).alias("d"),
    )
    return _bind(texts, body)


def _named_in(texts: Column, keywords: Column) -> Column:
    return F.exists(keywords, lambda k: F.contains(texts.t, k) | F.contains(texts.d, k))


def constant(values: list, ddl: str) -> Column:
    """A nested constant.  The optimizer folds the parse away, and building the column
    takes one call however many values there are."""
    return F.from_json(F.lit(json.dumps(values)), ddl)


def _chunks(techs: list[Tech]) -> list[list[Tech]]:
    return [techs[at : at + MASK_BITS] for at in range(0, len(techs), MASK_BITS)]


def _mask(techs: list[Tech], title, description) -> Column:
    specs = constant(
        [{"bit": 1 << bit, "keywords": t.keywords} for bit, t in enumerate(techs)],
        "array<struct<bit:bigint,keywords:array<string>>>",
    )

    def body(texts):
        return F.aggregate(
            specs,
            F.lit(0).cast("long"),
            lambda seen, t: F.when(
                _named_in(texts, t.keywords), seen.bitwiseOR(t.bit)
            ).otherwise(seen),
        )

    return _with_texts(title, description, body)


def tech_masks(techs: list[Tech], title="title", description="description") -> list[Column]:
    """One BIGINT per ``MASK_BITS`` technologies; bit i is set when technology i is found."""
    return [_mask(chunk, title, description) for chunk in _chunks(techs)]


def names_of_masks(techs: list[Tech], masks: list[str]) -> Column:
    """The names behind the set bits, in name order."""

    def names(chunk, mask):
        every = constant(
            [{"bit": 1 << bit, "name": t.name} for bit, t in enumerate(chunk)],
            "array<struct<bit:bigint,name:string>>",
        )
        found = F.filter(every, lambda n: n["bit"].bitwiseAND(mask) != 0)
        return F.transform(found, lambda n: n["name"])

    parts = [names(chunk, F.col(mask)) for chunk, mask in zip(_chunks(techs), masks)]
    return F.concat(F.array().cast("array<string>"), *parts)


def with_techs(
    jobs: DataFrame,
    config: DataFrame | Techs,
    *,
    title: str = "title",
    description: str = "description",
    **limits,
) -> DataFrame:
    """Add ``techs``, the sorted names found in each posting."""
    techs = config if isinstance(config, Techs) else read_techs(config, **limits)
    if not techs.small:
        return _sought(jobs, techs.table, title, description)
    specs = constant(
        [{"name": t.name, "keywords": t.keywords} for t in techs.rows],
        "array<struct<name:string,keywords:array<string>>>",
    )

    def body(texts):
        hits = F.filter(specs, lambda t: _named_in(texts, t.keywords))
        return F.transform(hits, lambda t: t["name"])

    return jobs.withColumn("techs", _with_texts(title, description, body))


def _sought(jobs: DataFrame, config: DataFrame, title: str, description: str) -> DataFrame:
    """``jobs`` with ``techs``; each different pair of texts is sought once."""
    parts = [F.coalesce(F.lower(c), F.lit("")) for c in (title, description)]
    texts = jobs.select(text_key(*parts).alias("key"), F.array(*parts).alias("parts"))
    texts = store(texts.groupBy("key").agg(F.min("parts").alias("parts"), F.count("*").alias("rows")), "texts")
    needles = config.where("tech_name IS NOT NULL").select(
        F.col("tech_name").alias("what"), F.explode("keywords").alias("needle")
    )
    found = substring_hits(texts.select("key", "parts"), needles)
    hot = texts.where(F.col("rows") > HOT_ROWS)
    every = with_found(jobs, text_key(*parts), found, "techs", jobs.columns, hot)
    none = F.array().cast("array<string>")
    return every.withColumn("techs", F.array_sort(F.coalesce("techs", none)))


def tech_matches(jobs: DataFrame, config: DataFrame, **options) -> DataFrame:
    """One row per posting and technology found in it.

    A plain ``explode`` makes the optimizer add a filter on the array, which repeats the
    keyword test; the outer form with a filter on its result does not.
    """
    return (
        with_techs(jobs, config, **options)
        .withColumn("tech_name", F.explode_outer("techs"))
        .drop("techs")
        .where(F.col("tech_name").isNotNull())
    )
