"""The index of grams against brute force."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from leadtide.operators import gramindex


def sought(spark, texts: list[list[str]], needles: list[tuple[str | None, str]]):
    rows = spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "key string, parts array<string>")
    table = spark.createDataFrame(needles, "needle string, what string")
    return {int(r.key): sorted(r.found) for r in gramindex.substring_hits(rows, table).collect()}


def expected(texts, needles):
    found = {i: sorted({w for n, w in needles if n is not None and any(n in p for p in t)}) for i, t in enumerate(texts)}
    return {i: f for i, f in found.items() if f}


@pytest.mark.parametrize("block", [6, 1 << 16])
def test_hits_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(gramindex, "BLOCK", block)  # a gram may lie across two blocks
    r = random.Random(2)
    letters = "abcé😀 .\n"
    texts = [["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(r.randint(1, 2))] for _ in range(60)]
    texts += [["".join(r.choices(letters, k=9)) + "abcab" * 4, ""]] * 20  # repeated texts
    needles = [("".join(r.choices(letters, k=n)), f"w{n}{k % 3}") for n in (1, 2, 3, 4, 5, 6, 7) for k in range(8)]
    needles += [("abcab", "hot"), ("bcabc", "hot"), ("abcababcab", "long"), (None, "null"), ("notthere", "none")]
    assert sought(spark, texts, needles) == expected(texts, needles)


def test_empty_needles_and_tables(spark):
    assert sought(spark, [["x"], [""]], [("", "all"), ("x", "x")]) == {0: ["all", "x"], 1: ["all"]}
    assert sought(spark, [["abcdefg"]], []) == {}
    assert sought(spark, [], [("abc", "x")]) == {}


def test_only_needles_longer_than_their_gram_are_tested(spark, monkeypatch):
    """A needle of five letters is its own gram; bytes that are no UTF-8 are not the replacement character."""
    texts = spark.createDataFrame([("k", [b"abcde abcdef", b"x\xffy"])], "key string, parts array<binary>")
    texts = texts.withColumn("parts", F.transform("parts", lambda p: p.cast("string")))
    needles = [("abcde", "short"), ("abcdef", "long"), ("\ufffd", "bytes"), ("zzzzz", "none")]
    found = gramindex.substring_hits(texts, spark.createDataFrame(needles, "needle string, what string"))
    assert sorted(found.first().found) == ["long", "short"]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"CASE WHEN \(NOT \(needle#\d+ = gram#\d+\)", text)


def test_every_row_of_a_text_gets_its_hits(spark):
    rows = spark.range(200).select("id", F.lit("same").alias("text"))
    found = spark.createDataFrame([(["w"],)], "found array<string>").withColumn("key", gramindex.text_key(F.lit("same")))
    every = gramindex.with_found(rows, gramindex.text_key(F.col("text")), found, "hits", ["id"])
    assert every.columns == ["id", "text", "hits"] and every.where("hits[0] = 'w'").count() == 200


@pytest.mark.parametrize("most", [-1, 500_000])
def test_few_and_many_needles_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(gramindex, "BROADCAST_NEEDLES", most)
    r = random.Random(3)
    texts = [["".join(r.choices("abc ", k=r.randint(0, 50))), "".join(r.choices("abc", k=7))] for _ in range(50)]
    short = [("".join(r.choices("abc", k=n)), f"w{k % 4}") for n in (2, 5) for k in range(12)]
    for needles in (short, [*short, ("abcabca", "long"), ("cabbac", "long")]):
        assert sought(spark, texts, needles) == expected(texts, needles)


def test_texts_do_not_move_for_needles_that_are_their_own_gram(spark):
    texts = spark.createDataFrame([("k", ["abcde"]), ("l", ["abcdefg"])], "key string, parts array<string>")
    kinds = "needle string, what string"
    for needle, moves in (("abcde", False), ("abcdef", True)):
        found = gramindex.substring_hits(texts, spark.createDataFrame([(needle, "w")], kinds))
        text = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("exists(parts" in text) == moves  # else they need not meet what was found
        assert "strategy=broadcast" in text  # what they give out is not dealt out by gram


def test_only_keys_of_many_rows_are_salted(spark):
    rows = spark.range(200).select("id", F.when(F.col("id") < 150, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    key = gramindex.text_key(F.col("text"))
    texts = rows.select("text", key.alias("key")).distinct()
    found = texts.select("key", F.array("text").alias("found"))
    every = gramindex.with_found(rows, key, found, "hits", ["id"], texts.where("text = 'hot'"))
    assert every.columns == ["id", "text", "hits"]
    assert sorted((r.id, r.hits) for r in every.collect()) == sorted((r.id, [r.text]) for r in rows.collect())
    made = every._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in made[made.index("explode"):].split("\n")[0]
