"""Work messages: parsing, routing, configuration and embedded CSV."""

from __future__ import annotations

import csv
import io
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediabatch import schemas
from mediabatch.config import CONFIG_KEYS, DEFAULT_CONFIG, ProcessingConfig
from mediabatch.functions.keys import run_batch_id
from mediabatch.functions.text import canonical_json
from mediabatch.operators.state import moment

# Output prefix per message type when the message names none.
DEFAULT_PREFIXES = {"csv_s3": "sqs-trigger/", "csv_data": "sqs-data/"}

# Deliveries before a message is set aside; settings of a second chance.
MAX_RECEIVES = 3
RETRY_CONFIG = {"max_retries": 5, "timeout": 60, "max_workers": 4}

CSV_COLUMNS = ("creator_name", "cover_url", "updated_at")


# -- configuration -----------------------------------------------------------------------------


def config_keys(config: Column) -> Column:
    """Keys that a configuration text names, known or not."""
    return F.coalesce(F.json_object_keys(config), F.array().cast("array<string>"))


def merge_config(given: Column, named: Column, defaults: ProcessingConfig = DEFAULT_CONFIG) -> Column:
    """Defaults overlaid with the message's values.

    A limit named as null means no limit, an absent one the default; so presence is looked at too.
    """
    fields = []
    for key, value in defaults.as_dict().items():
        own = given[key]
        if key == "max_images_per_creator":
            merged = F.when(F.array_contains(named, key), own).otherwise(F.lit(value))
        else:
            merged = F.coalesce(own, F.lit(value))
        fields.append(merged.alias(key))
    return F.struct(*fields)


def unknown_keys(named: Column) -> Column:
    return F.array_except(named, F.array(*[F.lit(k) for k in CONFIG_KEYS]))


def ill_typed(text: Column, given: Column, named: Column) -> Column:
    """A message for each named setting whose value, other than null, is not of its type."""
    return F.array_compact(
        F.array(
            *[
                F.when(
                    F.array_contains(named, key) & given[key].isNull() & F.get_json_object(text, f"$.{key}").isNotNull(),
                    F.lit(f"{key} has the wrong type"),
                )
                for key in CONFIG_KEYS
            ]
        )
    )


def config_errors(config: Column) -> Column:
    """Validation messages of a merged configuration, empty when it is fine."""
    # What each broken rule is called.
    rules = [
        (config["rows"] <= 0, "rows must be positive"),
        (config["cols"] <= 0, "cols must be positive"),
        (~config["quality"].between(1, 100), "quality must be between 1 and 100"),
        (config["max_workers"] <= 0, "max_workers must be positive"),
        (config["max_workers"] > 20, "max_workers should not exceed 20"),
        (config["timeout"] <= 0, "timeout must be positive"),
        (config["timeout"] > 300, "timeout should not exceed 300 seconds"),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(text)) for broken, text in rules]))


# -- parsing and routing -----------------------------------------------------------------------


def parse_messages(messages: DataFrame, as_of: datetime, defaults: ProcessingConfig = DEFAULT_CONFIG) -> DataFrame:
    """Message bodies as columns, with the merged configuration, batch id and `reason`.

    `reason` is NULL for a message that can be processed; others are dead-letter candidates:
    unreadable body, unsupported type, unknown configuration keys, invalid configuration, missing
    payload.
    """
    # The body is decoded once. Each step makes one generated row per message: filters on what follows
    # cannot be pushed below the decoding, which would repeat it for every field they mention.
    options = {"columnNameOfCorruptRecord": "unreadable"}
    body = messages.select("*", F.inline(F.array(F.struct(F.from_json("body", schemas.MESSAGE, options).alias("m")))))
    text = F.col("m.processing_config")
    settings = F.struct(F.from_json(text, schemas.CONFIG).alias("given"), config_keys(text).alias("named"))
    typed = body.select("*", F.inline(F.array(settings)))
    parsed = typed.withColumn("ill_typed", ill_typed(text, F.col("given"), F.col("named"))).withColumn(
        "readable", F.col("m").isNotNull() & F.col("m.unreadable").isNull()
    )
    kind = F.col("m.processing_type")
    config = merge_config(F.col("given"), F.col("named"), defaults)
    prefix = F.coalesce(
        F.col("m.output_prefix"), *[F.when(kind == k, F.lit(p)) for k, p in DEFAULT_PREFIXES.items()]
    )
    now = moment(as_of)
    batch = F.when(kind == "csv_s3", run_batch_id("s3_ref", now, F.col("m.s3_key"))).when(
        kind == "csv_data", run_batch_id("sqs_data", now)
    )
    extra = [c for c in messages.columns if c not in ("body", "attempt")]
    shaped = parsed.select(
        *extra,
        "body",
        "readable",
        kind.alias("processing_type"),
        F.col("m.s3_bucket").alias("s3_bucket"),
        F.col("m.s3_key").alias("s3_key"),
        F.col("m.csv_data").alias("csv_data"),
        config.alias("config"),
        unknown_keys(F.col("named")).alias("unknown_keys"),
        F.concat(config_errors(config), F.coalesce("ill_typed", F.array().cast("array<string>"))).alias("config_errors"),
        prefix.alias("output_prefix"),
        batch.alias("batch_id"),
        F.coalesce(F.col("m.attempt").try_cast("int"), F.lit(0)).alias("attempt"),
    )
    reason = (
        F.when(~F.col("readable"), "malformed")
        .when(~F.coalesce(F.col("processing_type").isin(*DEFAULT_PREFIXES), F.lit(False)), "unsupported type")
        .when(F.size("unknown_keys") > 0, "unknown configuration key")
        .when(F.size("config_errors") > 0, "invalid configuration")
        .when((F.col("processing_type") == "csv_s3") & F.col("s3_key").isNull(), "missing payload")
        .when((F.col("processing_type") == "csv_data") & F.col("csv_data").isNull(), "missing payload")
    )
    return shaped.withColumn("reason", reason)


def accepted(parsed: DataFrame, kind: str | None = None) -> DataFrame:
    ok = parsed.where(F.col("reason").isNull())
    return ok if kind is None else ok.where(F.col("processing_type") == kind)


def rejected(parsed: DataFrame) -> DataFrame:
    """Dead-letter rows: body, type, reason and how often the message was delivered."""
    return parsed.where(F.col("reason").isNotNull()).select(
        "body", "processing_type", "reason", (F.col("attempt") + 1).alias("attempt")
    )


def retryable(dead: DataFrame) -> DataFrame:
    """Dead letters that have not used up their deliveries."""
    return dead.where(F.col("attempt") < MAX_RECEIVES)


# -- embedded CSV ------------------------------------------------------------------------------


LINE = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLUMNS] + [T.StructField("line", T.LongType())])


@F.pandas_udf(T.ArrayType(LINE))
def _quoted_lines(texts: pd.Series) -> pd.Series:
    """Lines of CSV texts with quoted cells."""

    def lines(text):
        if text is None:
            return None
        return [
            {
                "creator_name": row.get("creator_name") if "creator_name" in row else "unknown",
                "cover_url": row.get("cover_url", ""),
                "updated_at": row.get("updated_at", ""),
                "line": number,
            }
            for number, row in enumerate(csv.DictReader(io.StringIO(text)), 1)
        ]

    return texts.map(lines)


def _plain_lines(text: Column) -> Column:
    """Lines of CSV texts without quotes."""
    lines = F.filter(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n"), lambda line: line != "")
    header = F.split(F.get(lines, F.lit(0)), ",")

    def cell(row: Column, name: str, absent: str) -> Column:
        at = F.array_position(header, F.lit(name)).cast("int")
        return F.when(at == 0, F.lit(absent)).otherwise(F.get(F.split(row, ","), at - 1)).alias(name)

    rows = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.transform(
        rows,
        lambda row, i: F.struct(
            cell(row, "creator_name", "unknown"),
            cell(row, "cover_url", ""),
            cell(row, "updated_at", ""),
            (i + 1).cast("long").alias("line"),
        ),
    )


def message_items(messages: DataFrame, carry=("batch_id",), text: str = "csv_data") -> DataFrame:
    """Item rows of CSV texts; columns by header name, `line` keeps their order.

    Text without quotes is split by Spark; only text with quotes (cells may hold commas and line
    breaks) is handed to a CSV parser. A message's text is bounded by the transport.
    """
    body = F.col(text)
    quoted = F.contains(body, F.lit('"'))
    lines = F.when(quoted, _quoted_lines(F.when(quoted, body))).otherwise(_plain_lines(body))
    return messages.select(*carry, F.inline(lines))


# -- second chance -----------------------------------------------------------------------------


def _overlaid(fields: Column, changes: dict[str, Column]) -> Column:
    """A map of JSON values with some entries replaced or added."""
    kept = F.map_filter(fields, lambda key, _: ~key.isin(*changes))
    pairs = [part for name, value in changes.items() for part in (F.lit(name), value)]
    return F.map_concat(kept, F.create_map(*pairs))


def reprocess(dead: DataFrame, as_of: datetime, timeout: int | None = None) -> DataFrame:
    """Dead letters that are JSON objects, with relaxed settings as `new_body`.

    Retries, timeout, workers, timestamp, source and the delivery count are replaced, everything else
    is kept.
    """
    relaxed = {**RETRY_CONFIG, **({"timeout": timeout} if timeout else {})}
    objects = "map<string,variant>"

    def json_value(value):
        return F.parse_json(F.lit(canonical_json(value)))

    decoded = dead.select("*", F.inline(F.array(F.struct(F.try_parse_json("body").alias("_json")))))
    body = F.try_variant_get("_json", "$", objects)
    config = F.coalesce(F.try_variant_get("_json", "$.processing_config", objects), F.create_map().cast(objects))
    new_config = F.to_variant_object(_overlaid(config, {k: json_value(v) for k, v in relaxed.items()}))
    new_body = _overlaid(
        body,
        {
            "processing_config": new_config,
            "timestamp": json_value(as_of.isoformat()),
            "source": json_value("dlq_reprocess"),
            "attempt": F.parse_json(F.col("attempt").cast("string")),
        },
    )
    # Bodies that are no JSON object give no row.
    texts = F.array_compact(F.array(F.to_json(new_body)))
    return decoded.select(*dead.columns, F.explode(texts).alias("new_body"))
