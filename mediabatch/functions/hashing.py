"""Digests and the names derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediabatch.functions.text import legacy_safe_name, normalized_name, safe_name

# Hex length per algorithm.
HASH_LENGTHS = {"md5": 32, "sha1": 40, "sha256": 64}


def check_algorithm(algo: str) -> str:
    name = algo.lower()
    if name not in HASH_LENGTHS:
        raise ValueError(f"Unsupported hash algorithm: {algo}")
    return name


def digest(c: Column, algo: str = "sha256") -> Column:
    name = check_algorithm(algo)
    if name == "sha256":
        return F.sha2(c, 256)
    return F.sha1(c) if name == "sha1" else F.md5(c)


def name_bucket(creator: Column, algo: str = "sha256") -> Column:
    """Stable 32-bit number of a creator: the first four digest bytes, big-endian."""
    head = F.substring(digest(normalized_name(creator), algo), 1, 8)
    return F.conv(head, 16, 10).cast("long")


def valid_hash(c: Column, algo: str = "sha256") -> Column:
    size = HASH_LENGTHS[check_algorithm(algo)]
    return F.coalesce(c.rlike(f"^[0-9a-fA-F]{{{size}}}$"), F.lit(False))


def collage_file(creator: Column, content_hash: Column, extension: str = "jpg") -> Column:
    return F.concat(
        safe_name(creator), F.lit("_collage_"), F.substring(content_hash, 1, 12), F.lit(f".{extension}")
    )


def collage_dir(prefix: str) -> str:
    """Folder of a prefix's collages, with its trailing slash."""
    return f"{prefix.rstrip('/')}/collages/" if prefix else "collages/"


def collage_key(creator: Column, content_hash: Column, prefix: str = "", extension: str = "jpg") -> Column:
    return F.concat(F.lit(collage_dir(prefix)), collage_file(creator, content_hash, extension))


def legacy_collage_key(creator: Column, prefix: str, as_of: Column) -> Column:
    """Key used when deduplication is off: case kept, timestamp instead of a digest."""
    stamp = F.date_format(as_of, "yyyyMMdd_HHmmss")
    return F.concat(
        F.lit(f"{prefix}collages/"), legacy_safe_name(creator), F.lit("_collage_"), stamp, F.lit(".jpg")
    )
