"""Table schemas, as DDL."""

ITEMS = "creator_name STRING, cover_url STRING, updated_at STRING"

LINKS = "creator_name STRING, cover_urls STRING, updated_at TIMESTAMP"

CONFIG = (
    "STRUCT<group_by_creator: BOOLEAN, rows: INT, cols: INT, max_images_per_creator: INT,"
    " quality: INT, max_workers: INT, timeout: INT, max_retries: INT>"
)

# The configuration stays JSON text here and is decoded on its own; `unreadable` holds a body that is
# no JSON object. `attempt` counts earlier deliveries of a message that was sent again.
MESSAGE = (
    "processing_type STRING, s3_bucket STRING, s3_key STRING, csv_data STRING, processing_config STRING,"
    " output_prefix STRING, timestamp STRING, source STRING, attempt STRING, unreadable STRING"
)

OBJECTS = "s3_key STRING, size_bytes LONG, last_modified TIMESTAMP, content_type STRING"

# The state log is append-only: `version` orders rewrites of one (creator_name, processing_date) key.
STATE = (
    "creator_name STRING, processing_date DATE, status STRING, batch_id STRING, content_hash STRING,"
    " image_count LONG, processing_config STRING, created_at TIMESTAMP, updated_at TIMESTAMP, ttl LONG,"
    " lambda_request_id STRING, processing_duration_ms LONG, collage_s3_key STRING, error_message STRING,"
    " version LONG"
)

IMAGE = "STRUCT<origin: STRING, height: INT, width: INT, nChannels: INT, mode: INT, data: BINARY>"

FETCHED = "attempts INT, content_type STRING, bytes BINARY, error STRING, fetch_ms LONG"
