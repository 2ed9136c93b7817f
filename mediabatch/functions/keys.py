"""Expressions over storage keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content type by file ending.
CONTENT_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "bmp": "image/bmp",
    "webp": "image/webp",
    "csv": "text/csv",
    "json": "application/json",
}


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def creator_of_key(key: Column) -> Column:
    """Creator part of a collage key: its file name up to the first `_collage_`, else NULL."""
    name = file_name(key)
    return F.when(F.contains(name, F.lit("_collage_")), F.substring_index(name, "_collage_", 1))


def prefix_candidates(rest: Column) -> Column:
    """Every text `t` for which `rest` starts with `t` + `_collage_`.

    A name may itself contain the separator (and separators may share an underscore), so each
    occurrence is a possible end of the creator part.
    """
    parts = F.split(rest, "_(?=collage_)")
    n = F.size(parts)
    ends = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda i: F.array_join(F.slice(parts, 1, i), "_"))


def content_type(key: Column) -> Column:
    ending = F.lower(F.substring_index(key, ".", -1))
    out = F.lit("application/octet-stream")
    for suffix, kind in CONTENT_TYPES.items():
        out = F.when(ending == suffix, F.lit(kind)).otherwise(out)
    return out


def without_csv(key: Column) -> Column:
    return F.replace(key, F.lit(".csv"), F.lit(""))


def batch_file(batch_id: Column, as_of: Column) -> Column:
    """File name of a batch below its run's timestamp folder."""
    return F.format_string("%s/parallel_batch_%02d.csv", F.date_format(as_of, "yyyyMMdd_HHmmss"), batch_id + 1)


def trigger_prefix(key: Column) -> Column:
    """Output prefix of a file that arrived in the landing folder."""
    return F.concat(F.lit("s3-trigger/"), without_csv(key), F.lit("/"))


def run_batch_id(kind: str, as_of: Column, key: Column | None = None) -> Column:
    """Batch id of a run: `s3` and `s3_ref` carry the file key, `sqs_data` does not."""
    stamp = F.date_format(as_of, "yyyyMMdd_HHmmss")
    parts = [F.lit(kind)] + ([without_csv(key)] if key is not None else []) + [stamp]
    return F.concat_ws("_", *parts)
