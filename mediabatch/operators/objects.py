"""Operators over the listing of stored objects (s3_key, size_bytes, last_modified, content_type)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.functions.hashing import collage_dir
from mediabatch.functions.keys import creator_of_key, file_name, prefix_candidates
from mediabatch.functions.numbers import round2
from mediabatch.functions.text import safe_name
from mediabatch.operators.state import moment

KIB, MIB = 1024, 1024 * 1024

# Accepted size range of a collage in bytes, content types, age of the warning in days.
MIN_COLLAGE, MAX_COLLAGE = 50 * KIB, 50 * MIB
COLLAGE_TYPES = ("image/jpeg", "image/jpg")
AGE_WARNING_DAYS = 30

# Storage rules as (store, key prefix, {age in days: class}, expiry in days).
LIFECYCLE_RULES = (
    ("input", "csv-files/", {30: "STANDARD_IA", 90: "GLACIER", 365: "DEEP_ARCHIVE"}, None),
    ("input", "archived/failed/", {}, 90),
    ("output", "collages/", {90: "STANDARD_IA", 365: "GLACIER"}, None),
    ("output", "results/processing-summaries/", {}, 365),
    ("temp", "processing/", {}, 7),
    ("temp", "debug/", {}, 30),
    ("temp", "large-files/", {}, 3),
)


def in_collages(objects: DataFrame, prefix: str = "") -> DataFrame:
    return objects.where(F.startswith("s3_key", F.lit(collage_dir(prefix))))


def object_metadata(objects: DataFrame) -> DataFrame:
    """Listing with the file name and the creator part read from the key."""
    return objects.withColumns(
        {"file_name": file_name(F.col("s3_key")), "creator_from_key": creator_of_key(F.col("s3_key"))}
    )


def _owners(objects: DataFrame, prefix: str) -> DataFrame:
    """Every object with each safe name its key could belong to (see `prefix_candidates`)."""
    rest = F.substring(F.col("s3_key"), F.lit(len(collage_dir(prefix)) + 1), F.length("s3_key"))
    return in_collages(objects, prefix).select("*", F.explode(prefix_candidates(rest)).alias("safe"))


def collage_owners(objects: DataFrame, prefix: str = "") -> DataFrame:
    """Safe names that own at least one stored collage, with their number."""
    return _owners(objects, prefix).groupBy("safe").agg(F.count(F.lit(1)).alias("collages"))


def _nameless(named: DataFrame) -> DataFrame:
    """The creator that stands for all creators with an empty safe name; no row if there is none."""
    return named.where(F.col("safe") == "").groupBy("safe").agg(F.min("creator_name").alias("creator_name"))


def members(creators: DataFrame) -> DataFrame:
    """Per creator its safe name and `listed_as`, the creator under which `existing_for_creator` lists its collages."""
    named = creators.select("creator_name", safe_name(F.col("creator_name")).alias("safe")).distinct()
    shared = F.broadcast(_nameless(named).withColumnRenamed("creator_name", "shared"))  # at most one row
    return named.join(shared, "safe", "left").select(
        "creator_name", "safe", F.coalesce("shared", "creator_name").alias("listed_as")
    )


def existing_for_creator(
    creators: DataFrame, objects: DataFrame, prefix: str = "", page_size: int | None = None
) -> DataFrame:
    """Stored collages of each creator: keys that start with its safe name and the separator.

    The prefix match is an equality join on the possible names of each key. Creators without a letter or digit
    all have the empty safe name and share its keys: those are listed once, under the creator that `members`
    names for all of them, as creators times keys would grow with the square. With `page_size`, `page` numbers the listing pages that each
    creator's keys, in order, fall on; all of them are returned.
    """
    named = creators.select("creator_name", safe_name(F.col("creator_name")).alias("safe"))
    wanted = named.where(F.col("safe") != "").unionByName(_nameless(named))
    found = _owners(objects, prefix).join(wanted, "safe").drop("safe")
    if page_size is None:
        return found
    w = Window.partitionBy("creator_name").orderBy("s3_key")
    return found.withColumn("page", F.floor((F.row_number().over(w) - 1) / page_size).cast("int"))


def retention_plan(found: DataFrame, keep_latest: int = 1) -> DataFrame:
    """Mark each creator's newest collages `keep`, the others `delete`.

    Only the kept keys are ranked (Spark limits each group before its shuffle); the rest follow from
    a join on the unique (creator, key).
    """
    newest = Window.partitionBy("creator_name").orderBy(F.desc("last_modified"), F.asc("s3_key"))
    kept = (
        found.select("creator_name", "s3_key", "last_modified")
        .withColumn("_n", F.row_number().over(newest))
        .where(F.col("_n") <= keep_latest)
        .select("creator_name", "s3_key", F.lit("keep").alias("kept"))
    )
    return (
        found.join(kept, ["creator_name", "s3_key"], "left")
        .withColumn("action", F.coalesce("kept", F.lit("delete")))
        .drop("kept")
    )


def object_stats(objects: DataFrame, prefix: str = "") -> DataFrame:
    """One row: collages, creators, sizes in MB, size classes and collages per creator."""
    mb = F.col("size_bytes") / MIB
    # Distinct creators come from a first grouping by creator, which merges before the shuffle.
    per_creator = (
        in_collages(objects, prefix)
        .groupBy(creator_of_key(F.col("s3_key")).alias("creator"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("size_bytes").alias("bytes"),
            F.count_if(mb < 1).alias("small"),
            F.count_if((mb >= 1) & (mb < 10)).alias("medium"),
            F.count_if(mb >= 10).alias("large"),
        )
    )

    def total(name):
        return F.coalesce(F.sum(name), F.lit(0))

    one = per_creator.agg(
        total("n").alias("total_collages"),
        F.count("creator").alias("unique_creators"),
        total("bytes").alias("bytes"),
        total("small").alias("small"),
        total("medium").alias("medium"),
        total("large").alias("large"),
    )

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    n, creators, megabytes = F.col("total_collages"), F.col("unique_creators"), F.col("bytes") / MIB
    return one.select(
        "total_collages",
        "unique_creators",
        round2(megabytes).alias("total_size_mb"),
        round2(ratio(megabytes, n)).alias("average_size_mb"),
        "small",
        "medium",
        "large",
        round2(ratio(n, creators)).alias("collages_per_creator"),
    )


def object_integrity(objects: DataFrame, as_of: datetime) -> DataFrame:
    """Size, type and age checks per object; age only warns."""
    size, kind = F.col("size_bytes"), F.coalesce("content_type", F.lit(""))
    days = F.floor((F.unix_micros(moment(as_of)) - F.unix_micros(F.col("last_modified").cast("timestamp")))
                   / F.lit(86_400_000_000)).cast("long")
    size_text = size.cast("string")

    def check(name, passed, *message, warning=False):
        return F.struct(
            F.lit(name).alias("check"),
            F.lit(passed).alias("passed"),
            F.concat(*message).alias("message"),
            F.lit(warning).alias("warning"),
        )

    size_check = (
        F.when(size < MIN_COLLAGE, check("minimum_size", False, F.lit("File too small: "), size_text,
                                         F.lit(f" bytes (min: {MIN_COLLAGE})")))
        .when(size > MAX_COLLAGE, check("maximum_size", False, F.lit("File too large: "), size_text,
                                        F.lit(f" bytes (max: {MAX_COLLAGE})")))
        .otherwise(check("size_validation", True, F.lit("File size OK: "), size_text, F.lit(" bytes")))
    )
    type_ok = kind.isin(*COLLAGE_TYPES)
    type_check = F.when(type_ok, check("content_type", True, F.lit("Content type OK: "), kind)).otherwise(
        check("content_type", False, F.lit("Invalid content type: "), kind)
    )
    age_check = F.when(
        days > AGE_WARNING_DAYS,
        check("age_warning", True, F.lit("Collage is "), days.cast("string"), F.lit(" days old"), warning=True),
    )
    return objects.withColumns(
        {
            "checks": F.array_compact(F.array(size_check, type_check, age_check)),
            "valid": size.between(MIN_COLLAGE, MAX_COLLAGE) & type_ok,
            "age_days": days,
        }
    )


def lifecycle_tiers(objects: DataFrame, as_of: datetime) -> DataFrame:
    """Storage class and expiry of each object under the rules; `store` says which rule set applies."""
    days = F.datediff(F.lit(as_of.strftime("%Y-%m-%d")).cast("date"), F.col("last_modified").cast("date"))
    rule, tier, expired = F.lit(None).cast("string"), F.lit("STANDARD"), F.lit(False)
    for store, prefix, classes, expiry in LIFECYCLE_RULES:
        hit = (F.col("store") == store) & F.startswith("s3_key", F.lit(prefix))
        name = F.lit("STANDARD")
        for age in sorted(classes):
            name = F.when(days >= age, F.lit(classes[age])).otherwise(name)
        rule = F.when(hit, F.lit(f"{store}:{prefix}")).otherwise(rule)
        tier = F.when(hit, name).otherwise(tier)
        if expiry is not None:
            expired = F.when(hit, days >= expiry).otherwise(expired)
    return objects.withColumns({"age_days": days, "rule": rule, "tier": tier, "expired": expired})


def lifecycle_by_rules(objects: DataFrame, rules: DataFrame, as_of: datetime) -> DataFrame:
    """Storage class of each object under a table of rules (store, prefix, age_days, tier); adds age_days, rule and tier.

    The rules of the longest prefix that the key starts with apply, of those the one with the greatest age reached (ties: the
    last tier by name). An object no rule speaks of, or younger than its rules' ages, is STANDARD; a rule without store, prefix or
    age is none. Prefixes are met by an equality join: of each key only beginnings as long as some rule's prefix are tried. Objects
    are told apart by store and key.
    """
    days = F.datediff(F.lit(as_of.strftime("%Y-%m-%d")).cast("date"), F.col("last_modified").cast("date"))
    steps = F.sort_array(F.collect_set(F.struct("age_days", "tier")))
    by_prefix = rules.dropna(subset=["store", "prefix", "age_days"]).groupBy("store", "prefix").agg(steps.alias("steps"))
    lengths = by_prefix.groupBy("store").agg(F.collect_set(F.char_length("prefix")).alias("lengths"))
    # As many lengths as the longest prefix has characters, at most.
    begun = (
        objects.select("store", "s3_key")
        .join(lengths, "store")
        .select("store", "s3_key", F.explode(F.filter("lengths", lambda n: n <= F.char_length("s3_key"))).alias("length"))
        .withColumn("prefix", F.expr("substring(s3_key, 1, length)"))
    )
    longest = begun.join(by_prefix, ["store", "prefix"]).groupBy("store", "s3_key").agg(
        F.max_by(F.struct("prefix", "steps"), "length").alias("best")
    )
    found = objects.withColumn("age_days", days).join(longest, ["store", "s3_key"], "left")
    reached = F.filter("best.steps", lambda s: s["age_days"] <= F.col("age_days"))
    tier = F.coalesce(F.get(reached, F.size(reached) - 1)["tier"], F.lit("STANDARD"))
    return found.withColumns({"rule": F.col("best.prefix"), "tier": tier}).drop("best")
