"""Mixing of sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.llm.common import restored, sheltered, stored

#: Digits of a hash that make a uniform number; 13 hexadecimal digits fit a double exactly.
_DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that the parts determine; nulls count as the empty string."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double") / float(16**_DIGITS)


def rates(docs: DataFrame, weights: DataFrame | None, total: Column | None = None) -> DataFrame:
    """(source, rate): how often a row of the source is to appear on average.

    ``weights`` has (source, weight); weights are relative, a source without one gets none
    of the mix, and without ``weights`` all sources weigh the same.  The mix is to have
    ``total`` rows, as many as ``docs`` unless given.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.col("source").alias("_source")).agg(F.max("weight").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "n", F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0)).alias("weight")
        )
    sums = weighed.agg(F.sum("weight").alias("_weights"), F.sum("n").alias("_rows"))
    return weighed.join(F.broadcast(sums)).select(  # one row
        "source",
        F.coalesce(
            F.try_divide(F.col("weight") * (total if total is not None else F.col("_rows")), F.col("_weights") * F.col("n")),
            F.lit(0.0),
        ).alias("rate"),
    )


def poisson(u: Column, rate: Column) -> Column:
    """The Poisson number of mean ``rate`` whose distribution function first exceeds u.

    The probabilities are added up in turn, each from the logarithm of the one before, which
    stays in range for any rate; there are about as many steps as the row gets copies.
    """
    start = F.struct((-rate).alias("log_p"), F.exp(-rate).alias("below"), F.lit(0).alias("k"))
    most = F.ceil(rate + 9 * F.sqrt(rate) + 30).cast("int")  # beyond, what is left is under 2 ** -53

    def step(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.ln(rate / k)
        more = u >= state["below"]
        return F.struct(
            log_p.alias("log_p"), (state["below"] + F.exp(log_p)).alias("below"),
            F.when(more, k).otherwise(state["k"]).alias("k"),
        )

    number = F.aggregate(F.sequence(F.lit(1), most), start, step)["k"]
    return F.when(rate > 0, number).otherwise(F.lit(0))


def mix(
    docs: DataFrame, weights: DataFrame | None = None, seed: int = 42, total: Column | None = None
) -> DataFrame:
    """The rows of ``docs``, each as often as its Poisson number says, in a global random order.

    Adds copy (1 and up) and mix_key, by which the rows are ordered; columns of those names
    are replaced.  The number of a row is drawn from its doc_id, text and the seed, so equal
    rows get equal numbers and a repeated run gives the same mix.  Null sources are a source.
    """
    docs = docs.drop("copy", "mix_key")
    # Written first, so that Spark knows its size when it chooses how to join.
    by_source = stored(rates(docs, weights, total), "source-rates").select(F.col("source").alias("_source"), "rate")
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    u = uniform(F.lit(seed), F.col("doc_id"), digest)
    used = ("doc_id", "text", "source")
    wide = sheltered(docs, *used)
    drawn = wide.withColumn("_u", u).join(by_source, F.col("source").eqNullSafe(F.col("_source")))
    names = [*used, "_rest"]
    times = drawn.select(*names, poisson(F.col("_u"), F.col("rate")).alias("_times")).where("_times > 0")
    copies = times.select(*names, F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy"))
    key = uniform(F.lit(seed + 1), F.col("doc_id"), digest, F.col("copy"))
    ordered = copies.select(*names, "copy", key.alias("mix_key")).orderBy("mix_key", "doc_id", "copy")
    return ordered.select(*restored(ordered, docs, *used), "copy", "mix_key")
