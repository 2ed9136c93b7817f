"""From link records to valid item rows."""

from __future__ import annotations

import json
import re
from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediabatch.functions.text import strip

ERROR_PREFIX = "ERROR:"


# -- item rows ---------------------------------------------------------------------------------


def normalize_items(items: DataFrame) -> DataFrame:
    """Strip creator and URL; a missing creator column counts as `unknown`."""
    creator = F.col("creator_name") if "creator_name" in items.columns else F.lit("unknown")
    return items.withColumns({"creator_name": strip(creator), "cover_url": strip(F.col("cover_url"))})


def _is_valid() -> Column:
    url = F.col("cover_url")
    ok = (url != "") & ~F.startswith(url, F.lit(ERROR_PREFIX)) & F.col("creator_name").isNotNull()
    return F.coalesce(ok, F.lit(False))


def valid_items(items: DataFrame) -> DataFrame:
    """Rows with a non-blank URL that is not an error marker."""
    return normalize_items(items).where(_is_valid())


def invalid_items(items: DataFrame) -> DataFrame:
    """The complement of `valid_items`, with the reason."""
    url = F.col("cover_url")
    reason = (
        F.when(F.col("creator_name").isNull() | url.isNull(), "missing cell")
        .when(url == "", "blank url")
        .otherwise("error url")
    )
    return normalize_items(items).where(~_is_valid()).withColumn("reason", reason)


def batchable_items(items: DataFrame) -> DataFrame:
    """The batching-side filter: any non-blank URL counts, error markers too; creators stay as they are."""
    return items.where(strip(F.col("cover_url")) != "")


def cap_per_creator(items: DataFrame, cap: int | None, keys=("creator_name",), order=("ord",)) -> DataFrame:
    """First `cap` rows per creator in file order; None or 0 keeps all.

    The `<= cap` filter on a row number lets Spark limit each group before the shuffle, so a hot
    creator sends at most `cap` rows per map task.
    """
    if not cap:
        return items
    w = Window.partitionBy(*keys).orderBy(*order)
    return items.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= cap).drop("_rank")


def with_positions(items: DataFrame, cap: int | None, keys=("creator_name",), order=("ord",)) -> DataFrame:
    """Rows with their unique `position`, cut to the first `cap` per creator where a cap is given.

    With a cap it is the place in file order. Without one it only sorts like file order: numbering a
    huge creator row by row would take one task, a range-partitioned sort does not.
    """
    if cap:
        w = Window.partitionBy(*keys).orderBy(*order)
        return items.withColumn("position", F.row_number().over(w).cast("long")).where(F.col("position") <= cap)
    return items.orderBy(*keys, *order).withColumn("position", F.monotonically_increasing_id())


# -- link records ------------------------------------------------------------------------------


def parse_date_filter(value, as_of: date) -> tuple[str | None, str | None]:
    """Date bounds of `last_N_days`, a (start, end) tuple or None; anything else means no filter."""
    if isinstance(value, tuple) and len(value) == 2:
        return value
    found = re.fullmatch(r"last_\s*([+-]?\d+)\s*(?:_.*)?_days", value) if isinstance(value, str) else None
    if not found:
        return None, None
    end = as_of.date() if isinstance(as_of, datetime) else as_of
    return (end - timedelta(days=int(found.group(1)))).isoformat(), end.isoformat()


def filter_links(
    links: DataFrame,
    date_filter=None,
    creator_filter: str | list[str] | None = None,
    as_of: date | None = None,
    ignore_case: bool = False,
    newest_first: bool = True,
) -> DataFrame:
    """Links in an inclusive time range and of the wanted creators, newest first.

    The range applies only with both ends; a date-only upper end means midnight. A string selects by
    substring pattern, a list by exact names. Bounds keep the column's own type, so that the
    comparison reaches the scan.
    """
    start, end = parse_date_filter(date_filter, as_of or date.today())
    if start and end:
        kind = links.schema["updated_at"].dataType
        links = links.where(F.col("updated_at").between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    name = F.col("creator_name")
    if isinstance(creator_filter, str) and creator_filter:
        pattern = f"%{creator_filter}%"
        links = links.where(name.ilike(pattern) if ignore_case else name.like(pattern))
    elif creator_filter:
        links = links.where(name.isin(list(creator_filter)))
    return links.orderBy(F.desc("updated_at")) if newest_first else links


@F.pandas_udf(T.ArrayType(T.StringType()))
def _decode_links(texts: pd.Series) -> pd.Series:
    """URLs of link texts that are not a plainly written list of strings."""

    def decode(text):
        if text is None:
            return None
        try:
            value = json.loads(text)
        except ValueError as problem:
            return [f"{ERROR_PREFIX} {problem}"]
        return [str(url) for url in value if url] if isinstance(value, list) else [str(value)]

    return texts.map(decode)


def link_urls(raw: Column) -> Column:
    """The URLs of a JSON list text.

    A list of strings written without surprises decodes in the JVM: its re-encoding must equal the
    text. Everything else (numbers, nesting, escapes, malformed text) goes to a small decoder.
    """
    listed = F.from_json(raw, "array<string>")
    compact = F.replace(raw, F.lit('", "'), F.lit('","'))
    plain = F.coalesce(F.to_json(listed) == compact, F.lit(False))
    empty = F.coalesce(raw, F.lit("")) == ""
    odd = _decode_links(F.when(~plain & ~empty, raw))
    return (
        F.when(empty, F.array(F.lit("")))
        .when(plain, F.filter(listed, lambda u: u.isNotNull() & (u != "")))
        .otherwise(odd)
    )


def explode_links(links: DataFrame) -> DataFrame:
    """One item row per URL; a record without links gives one blank row, an empty list none."""
    kind = links.schema["updated_at"].dataType.typeName()
    moment = F.col("updated_at")
    if kind.startswith("timestamp"):
        moment = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    return links.select(
        F.coalesce("creator_name", F.lit("")).alias("creator_name"),
        F.explode(link_urls(F.col("cover_urls"))).alias("cover_url"),
        F.coalesce(moment.cast("string"), F.lit("")).alias("updated_at"),
    )


def seen_creators(*earlier: DataFrame) -> DataFrame:
    """Distinct creators of earlier extracts."""
    names = [df.select("creator_name") for df in earlier]
    out = names[0]
    for df in names[1:]:
        out = out.unionByName(df)
    return out.where(F.col("creator_name").isNotNull()).distinct()


def remove_seen(items: DataFrame, *earlier: DataFrame) -> DataFrame:
    """Rows of creators that no earlier extract holds; exact names, own duplicates kept."""
    rows = items.where(F.col("creator_name").isNotNull())
    return rows.join(seen_creators(*earlier), "creator_name", "left_anti") if earlier else rows
