"""Exact dedup by a heavy-hitter split, in DataFrame operations only.

Each text is normalised and hashed once, map-side. Misra-Gries counters (`freqItems`) give a superset of the digests
that hold `SUPPORT` of the rows; their true counts are taken by a partial aggregate, and those that pass are broadcast:
at most 1/SUPPORT rows. Rows of such a digest are settled without a shuffle. Every other digest is rare, so an
ordinary shuffle of (row, id, digest) deals evenly.

Defined cases: a null text is the empty text; among equal texts the smallest doc_id stays, null ids last, and of
repeated rows with that id the first in the table; an empty table gives no rows. Other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import ROW, stored, whole_text, with_row, without_rows

SUPPORT = 0.001


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def decisions(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One light row per row of `docs`: row key, doc_id, text_sha256, keep_id, group_size, kept."""
    light = stored(
        with_row(docs.select("doc_id", "text")).select(ROW, "doc_id", F.sha2(normalised(whole_text()), 256).alias("text_sha256")), "digests"
    )
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    frequent = light.stat.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    winners = stored(
        light.join(F.broadcast(frequent), "text_sha256")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
        .filter(F.col("group_size") >= support * light.count()),
        "winners",
    )
    hot = light.join(F.broadcast(winners), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rare = (
        light.join(F.broadcast(winners), "text_sha256", "left_anti")
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("first", F.min(first).over(group))
    )
    return hot.unionByName(rare).select(
        ROW,
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"first.{ROW}")).alias("kept"),
        "text_sha256",
    )


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return decisions(docs, support).drop(ROW)


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """`docs`, a stored table, without the rows that are not kept."""
    dropped = stored(decisions(docs, support).filter("NOT kept").select(ROW), "dropped")
    return without_rows(docs, dropped)
