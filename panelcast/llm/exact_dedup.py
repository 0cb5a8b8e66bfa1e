"""Exact duplicates: 128-bit content hashes, checked byte by byte.

Texts are equal when they are identical after deleting white space. Slim rows
(hashes, length, id) are grouped; texts themselves are shuffled only where two
rows share a hash, and then once per task and distinct text, whatever the
number of copies. Defined results: a null text is an empty one; empty texts
equal each other; of equal texts the longest original stays, then the smallest
id (null ids last), then, for repeated rows, any one of them; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import WHITE, one_row_each, whole_text
from panelcast.sources.spool import spool


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def squeezed(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, WHITE, "")


def exact_duplicates(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` and ``n_chars_whole``.

    ``hash_of`` makes the grouping hash of the squeezed text. Where it collides,
    the bytes tell the texts apart.
    """
    text = whole_text()
    hashes = [hash_of(squeezed(text)).alias("h"), F.unhex(F.sha2(squeezed(text), 256)).alias("sha")]
    slim = spool(
        docs.select("doc_id", *hashes, F.length(text).alias("chars"), F.monotonically_increasing_id().alias("row"))
    )
    shared = slim.groupBy("h").count().filter("count > 1").select("h")
    # The bytes of texts whose hash is shared. Two texts under one pair of hashes end the job.
    bytes_of = docs.select(*hashes, squeezed(text).alias("body")).join(shared, "h", "left_semi")
    distinct = bytes_of.groupBy("h", "sha", "body").agg(F.lit(1).alias("one"))
    message = F.lit("two texts share both content hashes")
    checked = (
        distinct.groupBy("h", "sha").count().withColumn("ok", F.when(F.col("count") > 1, F.raise_error(message)).otherwise(True))
    ).filter("ok IS NOT FALSE")
    best = F.min(F.struct((-F.col("chars")).alias("longest"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = (
        slim.join(shared, "h", "left_semi")
        .groupBy("h", "sha")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
        .join(checked.select("h", "sha"), ["h", "sha"])
    )
    return slim.join(groups, ["h", "sha"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("chars").cast("long").alias("n_chars_whole"),
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    decided = exact_duplicates(docs).select(
        F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"), F.col("n_chars_whole").alias("__chars"), "kept"
    )
    decided = spool(decided)
    chosen = decided.filter("kept").drop("kept")
    text = whole_text()
    rows = docs.withColumns({"__sha_own": F.unhex(F.sha2(squeezed(text), 256)), "__chars_own": F.length(text).cast("long")})
    same = (
        rows["doc_id"].eqNullSafe(chosen["__id"])
        & (rows["__sha_own"] == chosen["__sha"])
        & (rows["__chars_own"] == chosen["__chars"])
    )
    found = rows.join(chosen, same, "left_semi")
    repeated = decided.groupBy("__id", "__sha", "__chars").count().filter("count > 1")
    return settled(found, docs, {"doc_id": "__id", "__sha_own": "__sha", "__chars_own": "__chars"}, repeated.drop("count"))


def settled(found: DataFrame, docs: DataFrame, key: dict[str, str], repeated: DataFrame) -> DataFrame:
    """``found`` with one row for each key of ``repeated``; rows with other keys pass as they are.

    ``key`` names the columns of ``found`` and their counterparts in ``repeated``.
    """
    repeated = spool(repeated)
    if repeated.isEmpty():
        return found.select(docs.columns)
    same = F.lit(True)
    for mine, other in key.items():
        same = same & found[mine].eqNullSafe(repeated[other])
    alone = found.join(repeated, same, "left_anti")
    rest = found.join(repeated, same, "left_semi").withColumn("__key", F.struct(*key))
    return alone.select(docs.columns).unionByName(one_row_each(rest, "__key", "text").select(docs.columns))
