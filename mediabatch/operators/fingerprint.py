"""Counts, content hashes, output names and content comparison per creator."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.functions.hashing import check_algorithm, collage_file, collage_key, digest
from mediabatch.functions.text import blank_to_null, canonical_json, json_quote, normalized_name
from mediabatch.operators.ingest import cap_per_creator

CREATOR = ("creator_name",)


# -- counts and lists --------------------------------------------------------------------------


def creator_counts(items: DataFrame, with_total: bool = False) -> DataFrame:
    """Images per creator; `with_total` adds the grand total as the row without a creator."""
    n = F.count(F.lit(1)).alias("image_count")
    if not with_total:
        return items.groupBy("creator_name").agg(n)
    return items.rollup("creator_name").agg(n, F.grouping("creator_name").alias("is_total"))


def creators_by_size(items: DataFrame) -> DataFrame:
    """Creators with the most images first, ties by first appearance."""
    return (
        items.groupBy("creator_name")
        .agg(F.count(F.lit(1)).alias("image_count"), F.min("ord").alias("first_ord"))
        .orderBy(F.desc("image_count"), F.asc("first_ord"))
    )


def creator_urls(items: DataFrame, cap: int) -> DataFrame:
    """The first `cap` URLs of each creator as one ordered list.

    The list is bounded by `cap`; an unlimited list is the long form itself (rows with `ord`).
    """
    if not cap:
        raise ValueError("a list per creator needs a cap; use the rows themselves for unlimited lists")
    pairs = F.array_sort(F.collect_list(F.struct("ord", "cover_url")))
    return (
        cap_per_creator(items, cap)
        .groupBy("creator_name")
        .agg(pairs.alias("pairs"))
        .select("creator_name", F.transform("pairs", lambda p: p["cover_url"]).alias("urls"))
    )


# -- digest of a sorted list -------------------------------------------------------------------


def _stream_digests(keys: list[str], stats: list[str], algo: str):
    """Hash sorted fragments row by row; only the running digest is held."""
    columns = [*keys, "digest", *stats]

    def run(batches):
        current, state, first = None, None, True

        def closed():
            state[0].update(state[1])
            return [*current, state[0].hexdigest(), *state[2]]

        for pdf in batches:
            done = []
            for row in zip(pdf[keys].itertuples(index=False, name=None), pdf["head"], pdf["tail"], pdf["fragment"],
                           pdf["times"], pdf[stats].itertuples(index=False, name=None)):
                key, head, tail, fragment, times, values = row
                if key != current:
                    if state is not None:
                        done.append(closed())
                    current, first = key, True
                    state = (hashlib.new(algo, head.encode()), tail.encode(), values)
                if fragment is None:
                    continue
                text = fragment.encode()
                if first:
                    state[0].update(text)
                    times, first = times - 1, False
                block = b"," + text
                while times > 0:
                    step = min(times, 1024)
                    state[0].update(block * step)
                    times -= step
            if done:
                yield pd.DataFrame(done, columns=columns)
        if state is not None:
            yield pd.DataFrame([closed()], columns=columns)

    return run


def sorted_list_digest(
    entries: DataFrame, keys: list[str], stats: dict[str, Column], head: Column, tail: Column, algo: str = "sha256"
) -> DataFrame:
    """Digest of `head` + comma-joined fragments in sort order + `tail`, per group: (keys, digest, stats).

    `entries` has the keys and `sort_key`, `fragment`, `times`; a NULL fragment adds nothing. `stats` are
    aggregates over a group's entries that `head` and `tail` may read. The entries are read and shuffled
    once: statistics come from a window, Spark's spilling sort brings the fragments into order, and an
    incremental hash takes them one by one, so no group is ever held in memory. A digest is sequential
    by definition, so a group is one stream; cap the rows of a group where that matters.
    """
    group = Window.partitionBy(*keys)
    fields = ", ".join(f"`{k}` {entries.schema[k].dataType.simpleString()}" for k in keys)
    numbers = "".join(f", `{name}` LONG" for name in stats)
    return (
        entries.withColumns({name: column.over(group) for name, column in stats.items()})
        .withColumns({"head": head, "tail": tail})
        .sortWithinPartitions(*keys, "sort_key")
        .select(*keys, "head", "tail", "fragment", "times", *stats)
        .mapInPandas(_stream_digests(keys, list(stats), check_algorithm(algo)), f"{fields}, digest STRING{numbers}")
    )


def _url_entries(items: DataFrame, keys: list[str], url: str) -> DataFrame:
    """Distinct URLs with their multiplicity; equal rows are merged before the shuffle."""
    return (
        items.select(*keys, blank_to_null(F.col(url)).alias("sort_key"))
        .groupBy(*keys, "sort_key")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("fragment", json_quote(F.col("sort_key")))
    )


def _url_stats() -> dict[str, Column]:
    listed = F.when(F.col("sort_key").isNotNull(), F.col("times")).otherwise(F.lit(0))
    return {"url_count": F.sum(listed), "total_urls": F.sum("times")}


def _creator_head(creator: Column) -> Column:
    return F.concat(
        F.lit('{"creator_name":'), json_quote(normalized_name(creator)), F.lit(',"image_urls":[')
    )


def _creator_tail(metadata: dict | None) -> Column:
    text = canonical_json(metadata or {})
    return F.concat(F.lit(f'],"metadata":{text},"url_count":'), F.col("url_count").cast("string"), F.lit("}"))


def _capped_lists(items: DataFrame, keys: list[str], url: str, cap: int) -> DataFrame:
    """Creator groups cut to `cap` rows, with their sorted URL fragments. One shuffle."""
    text = blank_to_null(F.col(url))
    return (
        cap_per_creator(items, cap, keys)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(text)).alias("urls"), F.count(F.lit(1)).alias("total_urls"))
        .withColumn("url_count", F.size("urls").cast("long"))
    )


def _digest_of_urls(
    items: DataFrame, keys: list[str], url: str, head, tail: Column, algo: str, cap: int | None
) -> DataFrame:
    if cap:
        body = F.array_join(F.transform("urls", json_quote), ",")
        return _capped_lists(items, keys, url, cap).select(
            *keys, digest(F.concat(head, body, tail), algo).alias("digest"), "url_count", "total_urls"
        )
    entries = _url_entries(cap_per_creator(items, cap, keys), keys, url)
    return sorted_list_digest(entries, keys, _url_stats(), head, tail, algo)


def creator_hash(
    items: DataFrame,
    metadata: dict | None = None,
    algo: str = "sha256",
    cap: int | None = None,
    keys=CREATOR,
    url: str = "cover_url",
) -> DataFrame:
    """Content hash per creator: name, sorted URLs (duplicates kept), metadata and URL count.

    With a cap the whole computation is one shuffle of at most `cap` rows per creator and map task.
    """
    keys = list(keys)
    out = _digest_of_urls(
        items, keys, url, _creator_head(F.col(keys[-1])), _creator_tail(metadata), algo, cap
    )
    return out.withColumnRenamed("digest", "content_hash")


def daily_fingerprint(
    items: DataFrame,
    config: dict,
    as_of: datetime,
    algo: str = "sha256",
    cap: int | None = None,
    keys=CREATOR,
    url: str = "cover_url",
) -> DataFrame:
    """Hash of content, configuration and calendar day."""
    keys = list(keys)
    tail = F.lit(f'],"processing_config":{canonical_json(config)},"timestamp":"{as_of:%Y-%m-%d}"}}')
    out = _digest_of_urls(items, keys, url, _creator_head(F.col(keys[-1])), tail, algo, cap)
    return out.withColumnRenamed("digest", "fingerprint")


def url_set_hash(
    items: DataFrame, algo: str = "sha256", keys=CREATOR, url: str = "cover_url"
) -> DataFrame:
    """Order- and duplicate-free hash of a group's URLs."""
    keys = list(keys)
    entries = _url_entries(items, keys, url).withColumn("times", F.lit(1).cast("long"))
    head = F.concat(F.lit('{"count":'), F.col("url_count").cast("string"), F.lit(',"urls":['))
    stats = {"url_count": F.count("sort_key")}
    hashed = sorted_list_digest(entries, keys, stats, head, F.lit("]}"), algo)
    return hashed.withColumnRenamed("digest", "set_hash")


def batch_hash(
    rows: DataFrame,
    algo: str = "sha256",
    batch: str = "batch_id",
    creator: str = "creator_name",
    url: str = "cover_url",
) -> DataFrame:
    """Hash per batch over its creators' hashes (without metadata) and its URL total, blanks included."""
    creators = creator_hash(rows, None, algo, None, (batch, creator), url)
    entries = creators.select(
        batch,
        F.col(creator).alias("sort_key"),
        F.concat(json_quote(F.col(creator)), F.lit(':"'), "content_hash", F.lit('"')).alias("fragment"),
        F.lit(1).cast("long").alias("times"),
        "total_urls",
    )
    stats = {"creator_count": F.count(F.lit(1)), "total_urls": F.sum("total_urls")}
    head = F.concat(
        F.lit('{"creator_count":'), F.col("creator_count").cast("string"), F.lit(',"creator_hashes":{')
    )
    tail = F.concat(F.lit('},"total_urls":'), F.col("total_urls").cast("string"), F.lit("}"))
    hashed = sorted_list_digest(entries, [batch], stats, head, tail, algo)
    return hashed.withColumnRenamed("digest", "batch_hash")


# -- output names ------------------------------------------------------------------------------


def output_keys(hashes: DataFrame, prefix: str = "", extension: str = "jpg") -> DataFrame:
    """Deterministic file name and key of each creator's collage."""
    name, content = F.col("creator_name"), F.col("content_hash")
    return hashes.withColumns(
        {
            "file_name": collage_file(name, content, extension),
            "s3_key": collage_key(name, content, prefix, extension),
        }
    )


# -- comparison --------------------------------------------------------------------------------


def content_diff_urls(old: DataFrame, new: DataFrame, url: str = "cover_url") -> DataFrame:
    """Each URL of either side with its multiplicities and `change` (added, removed, common)."""

    def side(df, name):
        return (
            df.select("creator_name", blank_to_null(F.col(url)).alias("url"))
            .where(F.col("url").isNotNull())
            .groupBy("creator_name", "url")
            .agg(F.count(F.lit(1)).alias(name))
        )

    both = side(old, "old_times").join(side(new, "new_times"), ["creator_name", "url"], "full_outer")
    change = (
        F.when(F.col("old_times").isNull(), "added")
        .when(F.col("new_times").isNull(), "removed")
        .otherwise("common")
    )
    return both.withColumn("change", change)


def change_summary(added: Column, removed: Column, common: Column) -> Column:
    parts = F.concat_ws(
        " ",
        F.when(added > 0, F.concat(F.lit("+"), added.cast("string"))),
        F.when(removed > 0, F.concat(F.lit("-"), removed.cast("string"))),
        F.when(common > 0, F.concat(F.lit("="), common.cast("string"))),
    )
    return F.when((added == 0) & (removed == 0), "No changes").otherwise(parts)


def content_diff(
    old: DataFrame, new: DataFrame, url: str = "cover_url", with_hashes: bool = False, algo: str = "sha256"
) -> DataFrame:
    """Added, removed and common URL counts per creator of either side, and whether content changed.

    Equal hashes mean equal sorted lists, that is equal multiplicities of every URL; this is decided
    on the URL rows, so a huge creator is spread over the cluster. `with_hashes` adds both hashes.
    """
    urls = content_diff_urls(old, new, url)

    def n(kind):
        return F.count_if(F.col("change") == kind)

    differs = ~F.coalesce(F.col("old_times") == F.col("new_times"), F.lit(False))
    names = old.select("creator_name").union(new.select("creator_name")).distinct()
    counted = urls.groupBy("creator_name").agg(
        n("added").alias("added_count"),
        n("removed").alias("removed_count"),
        n("common").alias("common_count"),
        F.max(differs).alias("content_changed"),
    )
    zero = F.lit(0).cast("long")
    added, removed, common = (
        F.coalesce(F.col(c), zero) for c in ("added_count", "removed_count", "common_count")
    )
    out = names.join(counted, "creator_name", "left").select(
        "creator_name",
        F.coalesce("content_changed", F.lit(False)).alias("content_changed"),
        (common + removed).alias("old_count"),
        (common + added).alias("new_count"),
        added.alias("added_count"),
        removed.alias("removed_count"),
        common.alias("common_count"),
        change_summary(added, removed, common).alias("change_summary"),
    )
    if not with_hashes:
        return out
    # A creator absent from one side has the hash of an empty list there: one blank row stands for it.
    padded = names.withColumn(url, F.lit(""))
    for name, side in (("old_hash", old), ("new_hash", new)):
        rows = side.select("creator_name", url).unionByName(padded)
        hashes = creator_hash(rows, None, algo, None, url=url).select(
            "creator_name", F.col("content_hash").alias(name)
        )
        out = out.join(hashes, "creator_name")
    return out

