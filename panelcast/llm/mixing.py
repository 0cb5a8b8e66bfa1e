"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every document gets a Poisson number of copies whose mean is its source's
repetition rate; the number comes from inverting the Poisson distribution at a
hash of id and text, so that it is the same on every run and needs no state.
Rows that share both are numbered and draw apart. Copies are laid out in the
order of another hash; its digits are uniform, so the ranges of the shuffle are
cut without looking at the rows first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import whole_text
from panelcast.sources.spool import spool

PIECE = 8.0  # a mean above this is split into equal parts, drawn apart and added
STEPS = 60  # the chance of a larger number at mean 8 is below 2**-53


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) with 52 random bits, from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_at(u: Column, mean: Column) -> Column:
    """The smallest k whose cumulative Poisson probability reaches ``u``, for a mean up to ``PIECE``."""
    zero = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("below"), F.lit(0).alias("k"))

    def step(state: Column, j: Column) -> Column:
        p = state["p"] * mean / j
        return F.struct(p.alias("p"), (state["below"] + p).alias("below"), (state["k"] + (state["below"] < u).cast("int")).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zero, step, lambda state: state["k"])


def told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a string for each row: id, hash of the text, and a tie where rows share both.

    Only such rows are shuffled for it: equal ones are counted, each task its
    own first, and numbered as they are written out again.
    """
    text = F.md5(whole_text())
    named = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "__text": text})
    shared = spool(named.groupBy("__id", "__text").count().filter("count > 1").select("__id", "__text"))
    alone = named.withColumn("__key", F.concat_ws(":", "__id", "__text", F.lit("")))
    if not shared.isEmpty():
        rest = named.join(shared, ["__id", "__text"], "left_semi")
        whole = F.struct(*[F.col(f"`{c}`") for c in named.columns])
        counted = rest.groupBy(F.md5(F.to_json(whole)).alias("__row")).agg(F.any_value(whole).alias("__one"), F.count(F.lit(1)).alias("__n"))
        numbered = counted.withColumn("__tie", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))))
        key = F.concat_ws(":", "__one.__id", "__one.__text", "__row", F.col("__tie").cast("string"))
        alone = alone.join(shared, ["__id", "__text"], "left_anti").select(*docs.columns, "__key")
        alone = alone.unionByName(numbered.select(*[F.col(f"__one.`{c}`").alias(c) for c in docs.columns], key.alias("__key")))
    return alone.select(*docs.columns, "__key")


def copies(key: Column, mean: Column, seed: int) -> Column:
    """Poisson number of copies of the document ``key`` names."""
    parts = F.greatest(F.ceil(mean / F.lit(PIECE)), F.lit(1)).cast("int")
    draws = F.transform(F.sequence(F.lit(1), parts), lambda i: poisson_at(unit_hash(F.lit(str(seed)), key, i.cast("string")), mean / parts))
    return F.aggregate(draws, F.lit(0), lambda a, b: a + b)


def source_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, alpha: float = 0.5, epochs: float = 1.0
) -> DataFrame:
    """One row per source: ``mix_source, mix_rate``, how often its documents repeat on average.

    With ``weights`` a source's share of all bytes is its weight over their sum,
    a source without one gets 0. Otherwise shares follow bytes ** ``alpha``.
    ``epochs`` times the bytes of the input are aimed at.
    """
    sized = docs.groupBy(F.col("source").alias("mix_source")).agg(F.sum(F.octet_length(whole_text()) + 1).cast("double").alias("bytes"))
    if weights is None:
        weight = F.round(F.pow("bytes", F.lit(alpha)), 6)
    else:
        weight = F.lit(0.0)
        for source, w in weights.items():
            weight = F.when(F.col("mix_source").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    weighed = spool(sized.withColumn("weight", weight))  # one row per source
    totals = weighed.agg(F.sum("bytes").alias("all_bytes"), F.round(F.sum("weight"), 6).alias("all_weight"))
    rate = F.when(F.col("all_weight") > 0, F.lit(epochs) * F.col("all_bytes") * F.col("weight") / F.col("all_weight") / F.col("bytes"))
    return spool(weighed.join(F.broadcast(totals)).select("mix_source", F.round(F.coalesce(rate, F.lit(0.0)), 9).alias("mix_rate")))


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, alpha: float = 0.5, epochs: float = 1.0, seed: int = 17
) -> DataFrame:
    """All columns of ``docs`` and ``mix_copy`` (from 1), ``mix_copies``, ``mix_rate``, ``mix_key``; rows in order of the key.

    The rates, a row per source, meet the documents in a plain join, which
    Spark turns into a broadcast where the written table is small, and which
    otherwise is split where a source is hot. Null sources are a source; rows
    with null or repeated ids draw apart, also where their texts are equal;
    null texts weigh 1 byte, an empty table gives no rows. Columns of ``docs``
    with the names of the new ones are replaced.
    """
    added = ["mix_copy", "mix_copies", "mix_rate", "mix_key"]
    docs = docs.drop(*added)
    rates = source_rates(docs, weights, alpha, epochs).select(F.col("mix_source").alias("__mix_source"), "mix_rate")
    named = told_apart(docs)
    drawn = named.join(rates, named["source"].eqNullSafe(rates["__mix_source"])).withColumn("mix_copies", copies(F.col("__key"), F.col("mix_rate"), seed))
    repeated = drawn.filter("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    keyed = repeated.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit(f"{seed}-place"), "__key", F.col("mix_copy").cast("string"))))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.expr(f"CAST(CAST(CONV(SUBSTRING(mix_key, 1, 8), 16, 10) AS BIGINT) * {parts} DIV 4294967296 AS INT)")
    ranged = keyed.repartitionById(parts, place)
    return ranged.sortWithinPartitions("mix_key").select(*docs.columns, *added)
