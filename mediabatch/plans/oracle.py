"""The same queries as SQL over the same tables, for checking results."""

from __future__ import annotations

CAP, BATCHES, TARGET = 12, 37, 100

# Report numbers round exact ties to the even digit (40.625 is 40.62): `round_even`, not `round`.

# Shared table expressions; each may use the ones above it.
PARTS: dict[str, str] = {
    "items": """
        SELECT c_name AS creator_name,
          CASE WHEN o_orderkey % 17 = 0 THEN 'ERROR: bad' WHEN o_orderkey % 13 = 0 THEN '  '
               ELSE 'https://img.example/' || o_orderkey || '.jpg' END AS cover_url,
          strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_at, o_orderkey AS ord
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "valid": "SELECT * FROM items WHERE trim(cover_url) <> '' AND cover_url NOT LIKE 'ERROR:%'",
    "batchable": "SELECT * FROM items WHERE trim(cover_url) <> ''",
    "capped": f"""
        SELECT * EXCLUDE (n) FROM (
          SELECT *, row_number() OVER (PARTITION BY creator_name ORDER BY ord) AS n FROM valid)
        WHERE n <= {CAP}""",
    "order_links": """
        SELECT c_name AS creator_name, '["https://img.example/' || o_orderkey || '.jpg"]' AS cover_urls,
          o_orderdate AS updated_at FROM orders JOIN customer ON o_custkey = c_custkey""",
    "link_items": """
        SELECT i.creator_name, o_custkey, o_orderkey // 5000 AS chunk, cover_url, o_orderdate
        FROM items i JOIN orders ON ord = o_orderkey""",
    "exploded": """
        SELECT creator_name, cover_url, strftime(moment, '%Y-%m-%d %H:%M:%S') AS updated_at, moment FROM (
          SELECT creator_name, o_custkey, cover_url,
            max(o_orderdate) OVER (PARTITION BY creator_name, chunk) AS moment FROM link_items)
        WHERE o_custkey % 11 <> 0 AND o_custkey % 19 <> 0 AND o_custkey % 23 <> 0
        UNION ALL
        SELECT creator_name, CASE WHEN o_custkey % 11 = 0 THEN ''
          ELSE 'ERROR: Expecting property name enclosed in double quotes: line 1 column 2 (char 1)' END,
          strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), max(o_orderdate)
        FROM link_items WHERE o_custkey % 11 = 0 OR o_custkey % 19 = 0
        GROUP BY creator_name, o_custkey, chunk""",
    "seen": "SELECT c_name AS creator_name FROM customer WHERE c_custkey % 5 = 0",
    "json_lists": """
        SELECT creator_name, count(*) AS total_urls, count(*) FILTER (trim(cover_url) <> '') AS url_count,
          coalesce(string_agg('"' || cover_url || '"', ',' ORDER BY cover_url)
            FILTER (trim(cover_url) <> ''), '') AS body
        FROM items GROUP BY creator_name""",
    "capped_lists": """
        SELECT creator_name, count(*) AS n, string_agg('"' || cover_url || '"', ',' ORDER BY cover_url) AS body
        FROM capped GROUP BY creator_name""",
    "capped_hash": f"""
        SELECT creator_name, n AS image_count, sha256('{{"creator_name":"' || lower(creator_name)
          || '","image_urls":[' || body || '],"metadata":{{"cols":7,"max_images":{CAP},"quality":95,"rows":5}},'
          || '"url_count":' || n || '}}') AS content_hash
        FROM capped_lists""",
    "names": """
        SELECT creator_name, image_count, content_hash,
          replace(lower(replace(creator_name, '#', '')), ' ', '_') || '_collage_' || substr(content_hash, 1, 12)
            || '.jpg' AS file_name
        FROM capped_hash""",
    "bucketed": f"""
        SELECT creator_name, count(*) AS image_count, min(ord) AS first_ord,
          CAST(('0x' || substr(sha256(lower(creator_name)), 1, 8))::BIGINT % {BATCHES} AS INTEGER) AS batch_id
        FROM items GROUP BY creator_name""",
    "sizes": f"""
        SELECT creator_name, count(*) AS image_count, min(ord) AS first_ord,
          CAST(('0x' || substr(sha256(lower(creator_name)), 1, 8))::BIGINT % {BATCHES} AS INTEGER) AS batch_id
        FROM batchable GROUP BY creator_name""",
    "log": """
        SELECT 'u' || user_id AS creator_name, CAST(ts AS DATE) AS processing_date,
          CASE WHEN event_type IN ('purchase', 'click', 'signup') THEN 'completed'
               WHEN event_type = 'error' THEN 'failed' ELSE 'processing' END AS status,
          'b' || (event_id % 50) AS batch_id, md5(props) AS content_hash,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS image_count, ts AS created_at, ts AS updated_at,
          CAST(floor(epoch(ts)) AS BIGINT) + 30 * 86400 AS ttl,
          CAST(floor(value * 10) AS BIGINT) AS processing_duration_ms,
          CASE WHEN event_type IN ('purchase', 'click', 'signup')
               THEN 'out/collages/u' || user_id || '_collage_' || substr(md5(props), 1, 12) || '.jpg'
               ELSE '' END AS collage_s3_key,
          CAST(NULL AS VARCHAR) AS error_message, event_id AS version
        FROM events""",
    "state": """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
          PARTITION BY creator_name, processing_date ORDER BY updated_at DESC, version DESC) AS n FROM log)
        WHERE n = 1""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY creator_name ORDER BY processing_date DESC) AS position
        FROM state""",
    "updates": """
        SELECT DISTINCT 'u' || user_id AS creator_name, DATE '2024-01-30' AS processing_date,
          CASE WHEN user_id % 3 = 0 THEN 'completed' ELSE 'failed' END AS new_status,
          CASE WHEN user_id % 3 = 0 THEN 'k' || user_id END AS new_key,
          CASE WHEN user_id % 3 = 0 THEN user_id * 10 ELSE 5 END AS new_ms,
          CASE WHEN user_id % 3 = 1 THEN 'boom' ELSE 'early' END AS new_error
        FROM events""",
    "stored": """
        SELECT s.creator_name, s.processing_date, coalesce(new_status, status) AS status, batch_id, content_hash,
          image_count, coalesce(new_ms, processing_duration_ms) AS processing_duration_ms,
          coalesce(new_key, collage_s3_key) AS collage_s3_key, coalesce(new_error, error_message) AS error_message,
          ttl, CASE WHEN u.creator_name IS NULL THEN version ELSE version + 1 END AS version, created_at,
          CASE WHEN u.creator_name IS NULL THEN updated_at ELSE TIMESTAMP '2024-01-31' END AS updated_at
        FROM (SELECT *, ttl > epoch(TIMESTAMP '2024-01-31') AS live FROM state) s
        LEFT JOIN updates u ON live AND s.creator_name = u.creator_name AND s.processing_date = u.processing_date""",
    "swept": """
        SELECT * REPLACE (CASE WHEN stuck THEN 'failed' ELSE status END AS status,
          CASE WHEN stuck THEN 'Processing timed out after 30 minutes' ELSE error_message END AS error_message,
          CASE WHEN stuck THEN version + 1 ELSE version END AS version,
          CASE WHEN stuck THEN TIMESTAMP '2024-01-31' ELSE updated_at END AS updated_at)
        FROM (SELECT *, status = 'processing' AND created_at < TIMESTAMP '2024-01-30 23:30:00'
            AND ttl > epoch(TIMESTAMP '2024-01-31') AS stuck FROM stored)""",
    "objects": """
        SELECT 'out/collages/' || replace(lower(replace(c_name, '#', '')), ' ', '_') || '_collage_'
            || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 12) || '.jpg' AS s3_key,
          CAST(floor(o_totalprice * CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 20 ELSE 200 END) AS BIGINT)
            AS size_bytes,
          o_orderdate AS last_modified,
          CASE WHEN o_orderkey % 29 = 0 THEN 'image/png' ELSE 'image/jpeg' END AS content_type,
          c_name AS creator_name
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "known": """
        SELECT s3_key, size_bytes FROM objects
        UNION ALL
        SELECT 'out/collages/' || file_name, 102396 + CAST(substr(creator_name, 10) AS BIGINT) % 8
        FROM names WHERE CAST(substr(creator_name, 10) AS BIGINT) % 3 = 0""",
    "owners": "SELECT DISTINCT split_part(split_part(s3_key, '/', 3), '_collage_', 1) AS safe FROM known",
    "skips": """
        SELECT n.creator_name, n.content_hash, n.image_count, 'out/collages/' || file_name AS s3_key,
          coalesce(size_bytes >= 102400, false) AS should_skip,
          CASE WHEN size_bytes < 102400 THEN 'Existing collage too small (' || size_bytes || ' bytes)'
               WHEN size_bytes IS NOT NULL THEN 'Identical collage already exists'
               WHEN o.safe IS NOT NULL THEN 'Creator has different content, will create new collage'
               ELSE 'No existing collages found' END AS skip_reason,
          size_bytes AS existing_bytes,
          size_bytes IS NULL AND o.safe IS NOT NULL AS content_has_changed
        FROM names n LEFT JOIN known k ON k.s3_key = 'out/collages/' || file_name
        LEFT JOIN owners o ON o.safe = split_part(file_name, '_collage_', 1)""",
    "dims": """
        SELECT 's' || l_suppkey AS creator_name, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
          40 + p_size * 20 AS width, 30 + CAST(floor(l_quantity) AS INTEGER) * 15 AS height, p_size,
          CAST(floor(l_quantity) AS INTEGER) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "usable": "SELECT * FROM dims WHERE width >= 50 AND height >= 50",
    "cells": """
        SELECT creator_name, count(*) AS images,
          least(greatest(CAST(trunc(avg(width)) AS INTEGER), 200), 800) AS cell_w,
          least(greatest(CAST(trunc(avg(height)) AS INTEGER), 200), 800) AS cell_h
        FROM usable GROUP BY creator_name""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY creator_name
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS i,
          count(*) OVER (PARTITION BY creator_name) AS n
        FROM usable""",
    "rasters": """
        SELECT *, row_number() OVER (PARTITION BY creator_name
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS i
        FROM (SELECT *, CASE WHEN l_linenumber % 4 = 0 THEN l_orderkey % 256 + l_linenumber * 30 + p_size * 5
            ELSE 3 * (l_orderkey % 256) END AS channels FROM dims)
        WHERE 46 + quantity % 10 >= 50""",
    "messages": """
        SELECT o_orderkey AS message_id, o_custkey AS c, o_orderkey % 5 AS kind, o_orderkey AS k,
          o_orderkey % 5 = 4 AND o_orderkey % 2 = 0 AS far FROM orders""",
    "routed": """
        SELECT *, CASE kind WHEN 0 THEN 'csv_s3' WHEN 1 THEN 'csv_data' WHEN 4 THEN 'csv_data'
            WHEN 2 THEN CASE WHEN k % 2 = 0 THEN 'zip_file' END END AS processing_type,
          CASE kind WHEN 2 THEN 'unsupported type' WHEN 3 THEN 'malformed'
            WHEN 4 THEN 'invalid configuration' END AS reason
        FROM messages""",
    "message_rows": """
        SELECT k AS message_id, 'c' || c AS creator_name, 'https://img.example/' || k || '.jpg' AS cover_url,
          '2001' AS updated_at, 1 AS line FROM messages WHERE kind = 1
        UNION ALL
        SELECT k, 'd', 'https://img.example/d' || k || '.jpg', NULL, 3 FROM messages WHERE kind = 1""",
    "results": """
        SELECT 'u' || user_id AS creator_name, strftime(ts, '%Y-%m-%d') AS day,
          CASE WHEN event_type IN ('purchase', 'click') THEN 'created' WHEN event_type = 'view' THEN 'skipped'
               ELSE 'failed' END AS outcome,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(floor(value * 10) AS BIGINT) AS download_ms,
          event_id % 7 AS save_ms
        FROM events""",
    "packing_order": """
        SELECT creator_name, image_count, row_number() OVER (ORDER BY image_count DESC, first_ord) AS r,
          ('0x' || substr(sha256(lower(creator_name)), 1, 8))::BIGINT AS bucket FROM sizes""",
    "next_fit": f"""
        SELECT r, 0::BIGINT AS batch_id, image_count AS filled FROM packing_order WHERE r = 1
        UNION ALL
        SELECT p.r, CASE WHEN filled + p.image_count > {TARGET} THEN batch_id + 1 ELSE batch_id END,
          CASE WHEN filled + p.image_count > {TARGET} THEN p.image_count ELSE filled + p.image_count END
        FROM next_fit f JOIN packing_order p ON p.r = f.r + 1""",
    "packed": f"""
        SELECT creator_name, image_count, batch_id FROM next_fit JOIN packing_order USING (r)""",
    "greedy": f"""
        SELECT 1::BIGINT AS r, [image_count] AS sizes, 1::BIGINT AS chosen FROM packing_order WHERE r = 1
        UNION ALL
        SELECT r, CASE WHEN chosen > len(opened) THEN list_append(opened, n)
            ELSE list_transform(opened, lambda s, i: CASE WHEN i = chosen THEN s + n ELSE s END) END, chosen
        FROM (
          SELECT r, n, opened, CAST(CASE
              WHEN opened[wanted] + n <= 1.5 * {TARGET} THEN wanted
              ELSE coalesce(list_min(list_transform(opened, lambda s, i:
                CASE WHEN s + n <= 2 * {TARGET} THEN abs({TARGET} - s - n) * 1000000 + i END)) % 1000000,
                len(opened) + 1) END AS BIGINT) AS chosen
          FROM (
            SELECT p.r, p.image_count AS n, p.bucket % (len(sizes) + 1) + 1 AS wanted,
              CASE WHEN p.bucket % (len(sizes) + 1) = len(sizes) THEN list_append(sizes, 0) ELSE sizes END AS opened
            FROM greedy g JOIN packing_order p ON p.r = g.r + 1))""",
    "shard_order": """
        SELECT creator_name, image_count, bucket, shard,
          row_number() OVER (PARTITION BY shard ORDER BY image_count DESC, first_ord) AS r
        FROM (SELECT *, ('0x' || substr(sha256(lower(creator_name)), 1, 8))::BIGINT AS bucket,
            ('0x' || substr(sha256(lower(creator_name)), 9, 8))::BIGINT % 3 AS shard FROM sizes)""",
    "sharded_greedy": f"""
        SELECT shard, 1::BIGINT AS r, [image_count] AS sizes, 1::BIGINT AS chosen FROM shard_order WHERE r = 1
        UNION ALL
        SELECT shard, r, CASE WHEN chosen > len(opened) THEN list_append(opened, n)
            ELSE list_transform(opened, lambda s, i: CASE WHEN i = chosen THEN s + n ELSE s END) END, chosen
        FROM (
          SELECT shard, r, n, opened, CAST(CASE
              WHEN fixed OR opened[wanted] + n <= 1.5 * {TARGET} THEN wanted
              ELSE coalesce(list_min(list_transform(opened, lambda s, i:
                CASE WHEN s + n <= 2 * {TARGET} THEN abs({TARGET} - s - n) * 1000000 + i END)) % 1000000,
                len(opened) + 1) END AS BIGINT) AS chosen
          FROM (
            SELECT *, CASE WHEN wanted > len(sizes) THEN list_concat(sizes, list_transform(range(wanted - len(sizes)),
                lambda x: 0::BIGINT)) ELSE sizes END AS opened
            FROM (
              SELECT p.shard, p.r, p.image_count AS n, sizes, false AS fixed, CAST(p.bucket % (len(sizes) + 1) + 1 AS BIGINT) AS wanted
              FROM sharded_greedy g JOIN shard_order p ON p.shard = g.shard AND p.r = g.r + 1)))""",
    "sticky_order": """
        SELECT creator_name, image_count, bucket, shard, before,
          row_number() OVER (PARTITION BY shard ORDER BY before IS NULL, image_count DESC, first_ord) AS r
        FROM (SELECT *, coalesce(before % 3, ('0x' || substr(sha256(lower(creator_name)), 9, 8))::BIGINT % 3) AS shard
          FROM (SELECT s.*, CAST(substr(e.creator_name, 10) AS BIGINT) % 40 AS before,
              ('0x' || substr(sha256(lower(s.creator_name)), 1, 8))::BIGINT AS bucket
            FROM sizes s LEFT JOIN seen e ON e.creator_name = s.creator_name))""",
    "sticky_greedy": f"""
        SELECT shard, 1::BIGINT AS r, list_append(list_transform(range(coalesce(before // 3, 0)), lambda x: 0::BIGINT), image_count) AS sizes, CAST(coalesce(before // 3, 0) + 1 AS BIGINT) AS chosen FROM sticky_order WHERE r = 1
        UNION ALL
        SELECT shard, r, CASE WHEN chosen > len(opened) THEN list_append(opened, n)
            ELSE list_transform(opened, lambda s, i: CASE WHEN i = chosen THEN s + n ELSE s END) END, chosen
        FROM (
          SELECT shard, r, n, opened, CAST(CASE
              WHEN fixed OR opened[wanted] + n <= 1.5 * {TARGET} THEN wanted
              ELSE coalesce(list_min(list_transform(opened, lambda s, i:
                CASE WHEN s + n <= 2 * {TARGET} THEN abs({TARGET} - s - n) * 1000000 + i END)) % 1000000,
                len(opened) + 1) END AS BIGINT) AS chosen
          FROM (
            SELECT *, CASE WHEN wanted > len(sizes) THEN list_concat(sizes, list_transform(range(wanted - len(sizes)),
                lambda x: 0::BIGINT)) ELSE sizes END AS opened
            FROM (
              SELECT p.shard, p.r, p.image_count AS n, sizes, before IS NOT NULL AS fixed, CAST(coalesce(p.before // 3, p.bucket % (len(sizes) + 1)) + 1 AS BIGINT) AS wanted
              FROM sticky_greedy g JOIN sticky_order p ON p.shard = g.shard AND p.r = g.r + 1)))""",
}

RECURSIVE = {"next_fit", "greedy", "sharded_greedy", "sticky_greedy"}


def _needs(text: str) -> list[str]:
    """Parts a text uses, directly or through others, in definition order."""
    found: set[str] = set()

    def visit(sql: str) -> None:
        words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in PARTS:
            if name in words and name not in found:
                found.add(name)
                visit(PARTS[name])

    visit(text)
    return [name for name in PARTS if name in found]


def _sql(final: str) -> str:
    names = _needs(final)
    keyword = "WITH RECURSIVE" if RECURSIVE & set(names) else "WITH"
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in names)
    return f"{keyword} {parts}\n{final}" if names else final


STATE_COLUMNS = """creator_name, strftime(processing_date, '%Y-%m-%d') AS processing_date, status, batch_id,
  content_hash, image_count, processing_duration_ms, collage_s3_key, error_message, ttl, version,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at"""

LINK_COLUMNS = "creator_name, cover_urls, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at"

LAYOUT = """l_orderkey, l_linenumber, l_partkey, CAST(i // 7 AS INTEGER) AS grid_row, CAST(i % 7 AS INTEGER) AS grid_col"""

FINAL: dict[str, str] = {
    "capped_fingerprints": """
        SELECT creator_name, image_count, content_hash, file_name, 'out/collages/' || file_name AS s3_key FROM names""",
    "valid_items": "SELECT creator_name, cover_url, updated_at, ord FROM valid",
    "invalid_items": """
        SELECT creator_name, trim(cover_url) AS cover_url, updated_at, ord,
          CASE WHEN trim(cover_url) = '' THEN 'blank url' ELSE 'error url' END AS reason
        FROM items WHERE trim(cover_url) = '' OR cover_url LIKE 'ERROR:%'""",
    "batchable_items": "SELECT * FROM batchable",
    "date_range_links": f"""
        SELECT {LINK_COLUMNS} FROM order_links
        WHERE updated_at BETWEEN TIMESTAMP '2001-07-03' AND TIMESTAMP '2001-08-02'""",
    "creator_like": f"SELECT {LINK_COLUMNS} FROM order_links WHERE creator_name LIKE '%0000012%'",
    "creator_like_any_case": f"""
        SELECT {LINK_COLUMNS} FROM order_links WHERE creator_name ILIKE '%CUSTOMER#00000001%'""",
    "creator_in": f"""
        SELECT {LINK_COLUMNS} FROM order_links
        WHERE creator_name IN ('Customer#000000003', 'Customer#000000010', 'Customer#000000077')
          AND updated_at BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'""",
    "explode_links": "SELECT creator_name, cover_url, updated_at FROM exploded",
    "remove_seen_creators": """
        SELECT * FROM items WHERE creator_name NOT IN (SELECT creator_name FROM seen)""",
    "cap_per_creator": "SELECT * FROM capped",
    "extract_items": """
        SELECT creator_name, cover_url, updated_at FROM exploded
        WHERE moment BETWEEN TIMESTAMP '2000-08-02' AND TIMESTAMP '2001-08-02'
          AND creator_name NOT IN (SELECT creator_name FROM seen)""",
    "csv_items_scan": """
        SELECT CASE ord % 3 WHEN 1 THEN creator_name || ', "x"' WHEN 2 THEN creator_name || chr(10) || 'y'
          ELSE creator_name END AS creator_name, cover_url, updated_at FROM items""",
    "csv_records_scan": """
        SELECT CASE WHEN ord % 3 = 2 THEN 'unknown'
                    WHEN ord % 2 = 0 THEN creator_name || ', "x"' || chr(10) || ord ELSE creator_name END AS creator_name,
          cover_url, CASE WHEN ord % 3 = 2 THEN '' ELSE updated_at END AS updated_at FROM items
        WHERE ord % 3 <> 2 OR trim(cover_url) <> ''""",
    "listed_files": """
        SELECT DISTINCT '20010802_000000/parallel_batch=' || printf('%02d', c.batch_id + 1) AS folder
        FROM batchable b JOIN bucketed c ON b.creator_name = c.creator_name""",
    "landing_rows": """
        SELECT creator_name, cover_url, '2001-08-02' AS dt, unnest(['s3', 'sqs']) AS trigger FROM items""",
    "creator_counts": """
        SELECT creator_name, count(*) AS image_count, CAST(grouping(creator_name) AS INTEGER) AS is_total
        FROM batchable GROUP BY ROLLUP (creator_name)""",
    "creators_by_size": """
        SELECT creator_name, count(*) AS image_count, min(ord) AS first_ord FROM valid GROUP BY creator_name""",
    "creator_urls": """
        SELECT creator_name, string_agg(cover_url, '|' ORDER BY ord) AS urls FROM capped GROUP BY creator_name""",
    "creator_hash": f"""
        SELECT creator_name, sha256('{{"creator_name":"' || lower(creator_name) || '","image_urls":[' || body
          || '],"metadata":{{"cols":7,"max_images":{CAP},"quality":95,"rows":5}},"url_count":' || url_count || '}}')
          AS content_hash, url_count, total_urls FROM json_lists""",
    "creator_hash_sha1": """
        SELECT creator_name, sha1('{"creator_name":"' || lower(creator_name) || '","image_urls":[' || body
          || '],"metadata":{},"url_count":' || url_count || '}') AS content_hash, url_count, total_urls
        FROM json_lists""",
    "url_set_hash": """
        SELECT creator_name, md5('{"count":' || count(url) || ',"urls":['
            || coalesce(string_agg('"' || url || '"', ',' ORDER BY url) FILTER (url IS NOT NULL), '') || ']}')
            AS set_hash, count(url) AS url_count
        FROM (SELECT DISTINCT creator_name, nullif(trim(cover_url), '') AS url FROM items) GROUP BY creator_name""",
    "batch_hash": """
        SELECT batch_id, sha256('{"creator_count":' || count(*) || ',"creator_hashes":{'
            || string_agg('"' || creator_name || '":"' || h || '"', ',' ORDER BY creator_name)
            || '},"total_urls":' || sum(total_urls) || '}') AS batch_hash,
          count(*) AS creator_count, CAST(sum(total_urls) AS BIGINT) AS total_urls
        FROM (SELECT creator_name, total_urls, sha256('{"creator_name":"' || lower(creator_name)
              || '","image_urls":[' || body || '],"metadata":{},"url_count":' || url_count || '}') AS h
            FROM json_lists) JOIN bucketed USING (creator_name)
        GROUP BY batch_id""",
    "daily_fingerprint": """
        SELECT creator_name, sha256('{"creator_name":"' || lower(creator_name) || '","image_urls":[' || body
          || '],"processing_config":{"cols":7,"rows":5},"timestamp":"2001-08-02"}') AS fingerprint
        FROM capped_lists""",
    "content_diff": """
        SELECT creator_name, content_changed, old_count, new_count, added_count, removed_count, common_count,
          CASE WHEN added_count = 0 AND removed_count = 0 THEN 'No changes' ELSE concat_ws(' ',
            CASE WHEN added_count > 0 THEN '+' || added_count END,
            CASE WHEN removed_count > 0 THEN '-' || removed_count END,
            CASE WHEN common_count > 0 THEN '=' || common_count END) END AS change_summary
        FROM (
          SELECT creator_name, coalesce(bool_or(o <> n) FILTER (url <> ''), false) AS content_changed,
            count(*) FILTER (url <> '' AND o > 0) AS old_count, count(*) FILTER (url <> '' AND n > 0) AS new_count,
            count(*) FILTER (url <> '' AND o = 0) AS added_count,
            count(*) FILTER (url <> '' AND n = 0) AS removed_count,
            count(*) FILTER (url <> '' AND o > 0 AND n > 0) AS common_count
          FROM (SELECT creator_name, trim(cover_url) AS url, count(*) FILTER (ord % 7 <> 0) AS o,
                  count(*) FILTER (ord % 5 <> 0) AS n
                FROM items WHERE ord % 7 <> 0 OR ord % 5 <> 0 GROUP BY ALL)
          GROUP BY creator_name)""",
    "content_diff_urls": """
        SELECT creator_name, trim(cover_url) AS url, nullif(count(*) FILTER (ord % 7 <> 0), 0) AS old_times,
          nullif(count(*) FILTER (ord % 5 <> 0), 0) AS new_times,
          CASE WHEN count(*) FILTER (ord % 7 <> 0) = 0 THEN 'added'
               WHEN count(*) FILTER (ord % 5 <> 0) = 0 THEN 'removed' ELSE 'common' END AS change
        FROM items WHERE (ord % 7 <> 0 OR ord % 5 <> 0) AND trim(cover_url) <> '' GROUP BY ALL""",
    "content_diff_hashes": """
        SELECT creator_name, coalesce(old_body, '') || ' ' <> coalesce(new_body, '') || ' ' AS content_changed,
          sha256('{"creator_name":"' || lower(creator_name) || '","image_urls":[' || coalesce(old_body, '')
            || '],"metadata":{},"url_count":' || old_n || '}') AS old_hash,
          sha256('{"creator_name":"' || lower(creator_name) || '","image_urls":[' || coalesce(new_body, '')
            || '],"metadata":{},"url_count":' || new_n || '}') AS new_hash
        FROM (
          SELECT creator_name,
            string_agg('"' || cover_url || '"', ',' ORDER BY cover_url)
              FILTER (ord % 7 <> 0 AND trim(cover_url) <> '') AS old_body,
            string_agg('"' || cover_url || '"', ',' ORDER BY cover_url)
              FILTER (ord % 5 <> 0 AND trim(cover_url) <> '') AS new_body,
            count(*) FILTER (ord % 7 <> 0 AND trim(cover_url) <> '') AS old_n,
            count(*) FILTER (ord % 5 <> 0 AND trim(cover_url) <> '') AS new_n
          FROM items WHERE ord % 7 <> 0 OR ord % 5 <> 0 GROUP BY creator_name)""",
    "output_names": """
        SELECT host AS creator_name, safe, safe || '_collage_' || substr(h, 1, 12) || '.png' AS file_name,
          'collages/' || safe || '_collage_' || substr(h, 1, 12) || '.png' AS s3_key,
          'out/collages/' || replace(host, '.', '') || '_collage_20010802_000000.jpg' AS legacy_key,
          safe AS creator_from_key, 'image/png' AS content_type,
          ('0x' || substr(sha256(lower(host)), 1, 8))::BIGINT AS bucket,
          true AS valid_md5, false AS valid_sha256
        FROM (
          SELECT host, lower(replace(host, '.', '')) AS safe, md5('{"creator_name":"' || lower(host)
            || '","image_urls":[' || string_agg('"' || url || '"', ',' ORDER BY url)
            || '],"metadata":{},"url_count":' || count(*) || '}') AS h
          FROM (SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, url FROM pages) GROUP BY host)""",
    "hash_batches": "SELECT creator_name, image_count, batch_id FROM sizes",
    "sticky_batches": f"""
        SELECT creator_name, image_count,
          CAST(CASE WHEN creator_name IN (SELECT creator_name FROM seen) THEN 99
            ELSE ('0x' || substr(md5(lower(creator_name)), 1, 8))::BIGINT % {BATCHES} END AS INTEGER) AS batch_id
        FROM sizes""",
    "next_fit_batches": "SELECT * FROM packed",
    "balanced_batches": """
        SELECT creator_name, image_count, dense_rank() OVER (ORDER BY chosen) - 1 AS batch_id
        FROM greedy JOIN packing_order USING (r)""",
    "sharded_batches": """
        SELECT creator_name, image_count, (dense_rank() OVER (PARTITION BY shard ORDER BY chosen) - 1) * 3 + shard AS batch_id
        FROM sharded_greedy JOIN shard_order USING (shard, r)""",
    "sticky_balanced_batches": """
        SELECT creator_name, image_count, (chosen - 1) * 3 + shard AS batch_id
        FROM sticky_greedy JOIN sticky_order USING (shard, r)""",
    "saved_assignment": "SELECT creator_name, image_count, batch_id FROM sizes",
    "batch_stats": """
        SELECT batch_id, count(*) AS creator_count, CAST(sum(image_count) AS BIGINT) AS image_total,
          max(image_count) AS largest_creator FROM sizes GROUP BY batch_id""",
    "batch_balance": f"""
        SELECT count(*) AS batches, CAST(sum(c) AS BIGINT) AS creators, CAST(sum(n) AS BIGINT) AS images,
          CAST(min(n) AS BIGINT) AS min_size, CAST(max(n) AS BIGINT) AS max_size,
          CAST(sum(n) AS DOUBLE) / count(*) AS avg_size,
          (max(n) - min(n)) / (CAST(sum(n) AS DOUBLE) / count(*)) AS balance_score,
          max(n) - min(n) > 0.5 * {TARGET} AS high_variance, CAST(max(n) AS DOUBLE) / 13 AS estimated_seconds
        FROM (SELECT batch_id, count(*) AS c, sum(image_count) AS n FROM packed GROUP BY batch_id)""",
    "duplicate_creators": """
        SELECT creator_name, min(ord % 5) AS first_batch, max(ord % 5) AS last_batch,
          count(DISTINCT ord % 5) AS batch_count
        FROM items GROUP BY creator_name HAVING count(DISTINCT ord % 5) > 1""",
    "assignment_issues": f"""
        SELECT * FROM (
          SELECT coalesce(a.creator_name, l.creator_name) AS creator_name, a.batch_id AS assigned_batch, listings,
            listed_batch,
            CASE WHEN a.batch_id IS NULL THEN 'listed without assignment'
                 WHEN listings IS NULL THEN 'assigned but not listed'
                 WHEN listings > 1 THEN 'listed more than once'
                 WHEN a.batch_id <> listed_batch THEN 'batches differ' END AS issue
          FROM (SELECT creator_name, batch_id FROM bucketed WHERE batch_id <> 5) a FULL JOIN (
            SELECT creator_name, count(*) AS listings, min(batch_id) AS listed_batch FROM (
              SELECT c_name AS creator_name, c_custkey, CASE WHEN c_custkey % 50 = 2 THEN 0 ELSE
                CAST(('0x' || substr(sha256(lower(c_name)), 1, 8))::BIGINT % {BATCHES} AS INTEGER) END AS batch_id,
                unnest(CASE WHEN c_custkey % 50 = 3 THEN [1, 2] ELSE [1] END)
              FROM customer WHERE c_custkey % 50 <> 1) GROUP BY creator_name) l
          ON a.creator_name = l.creator_name)
        WHERE issue IS NOT NULL""",
    "attach_batches": """
        SELECT b.creator_name, cover_url, updated_at, ord, batch_id
        FROM batchable b JOIN bucketed c ON b.creator_name = c.creator_name""",
    "batch_messages": """
        SELECT batch_id, part, count(*) AS image_count,
          '{"processing_type":"csv_data","csv_data":"creator_name,cover_url,updated_at\\n'
            || string_agg(creator_name || ',' || cover_url || ',' || updated_at, '\\n' ORDER BY creator_name, ord)
            || '","processing_config":'
            || '{"cols":7,"max_retries":3,"max_workers":8,"quality":95,"rows":5,"timeout":30}'
            || ',"output_prefix":"parallel_sqs_20010802_000000/","timestamp":"2001-08-02 00:00:00",'
            || '"source":"direct_data"}' AS body
        FROM (
          SELECT c.batch_id, b.creator_name, cover_url, updated_at, ord,
            (row_number() OVER (PARTITION BY c.batch_id ORDER BY b.creator_name, ord) - 1) // 400 AS part
          FROM batchable b JOIN bucketed c ON b.creator_name = c.creator_name)
        GROUP BY batch_id, part""",
    "batch_files": """
        SELECT printf('%02d', batch_id + 1) AS batch_file, count(*) AS rows, count(DISTINCT b.creator_name) AS creators
        FROM batchable b JOIN bucketed c ON b.creator_name = c.creator_name GROUP BY batch_id""",
    "suggested_sizes": """
        SELECT batch_id, CAST(sum(image_count) AS BIGINT) AS images, CASE WHEN sum(image_count) <= 1000 THEN 50
          WHEN sum(image_count) <= 10000 THEN 100 WHEN sum(image_count) <= 100000 THEN 200 ELSE 300 END AS batch_size
        FROM bucketed GROUP BY ROLLUP (batch_id)""",
    "reference_messages": """
        SELECT o_orderkey, '{"processing_type":"csv_s3","s3_bucket":"in","s3_key":"csv-files/' || o_orderkey
          || '.csv","processing_config":{"cols":7,"group_by_creator":true,"max_images_per_creator":35,'
          || '"max_retries":3,"max_workers":8,"quality":95,"rows":5,"timeout":30},"output_prefix":"p/",'
          || '"timestamp":"2001-08-02 00:00:00","source":"local_upload"}' AS body
        FROM orders""",
    "current_state": f"SELECT {STATE_COLUMNS} FROM state",
    "unexpired_state": f"SELECT {STATE_COLUMNS} FROM state WHERE ttl > epoch(TIMESTAMP '2024-02-10')",
    "latest_state": f"SELECT {STATE_COLUMNS} FROM ranked WHERE position = 1",
    "state_history": f"SELECT {STATE_COLUMNS}, CAST(position AS INTEGER) AS position FROM ranked WHERE position <= 5",
    "conditional_create": """
        SELECT r.creator_name, '2024-01-30' AS processing_date, 'processing' AS status, r.batch_id, content_hash,
          image_count, 0::BIGINT AS processing_duration_ms, '' AS collage_s3_key,
          CAST(NULL AS VARCHAR) AS error_message, CAST(epoch(TIMESTAMP '2024-02-29 12:00:00') AS BIGINT) AS ttl,
          coalesce(t.version + 1, 0) AS version, '2024-01-30 12:00:00' AS created_at,
          '2024-01-30 12:00:00' AS updated_at,
          coalesce(t.status <> 'processing', true)
            AND row_number() OVER (PARTITION BY r.creator_name ORDER BY r.batch_id) = 1 AS accepted
        FROM (SELECT creator_name, batch_id || '-' || version AS batch_id, content_hash, image_count,
                unnest(CASE WHEN version % 2 = 0 THEN [1, 2] ELSE [1] END) FROM log
              WHERE processing_date = DATE '2024-01-30') r
        LEFT JOIN (
          SELECT creator_name, arg_max(status, (updated_at, version)) AS status,
            arg_max(version, (updated_at, version)) AS version
          FROM log WHERE processing_date = DATE '2024-01-30' AND created_at < TIMESTAMP '2024-01-30 12:00:00'
          GROUP BY creator_name) t ON r.creator_name = t.creator_name""",
    "snapshot_state": f"SELECT {STATE_COLUMNS} FROM state",
    "creator_lease_stream": """
        SELECT creator_name, CASE WHEN accepted THEN 'opened' ELSE 'refused' END AS outcome, batch_id, content_hash,
          image_count, CASE WHEN accepted THEN coalesce(version + 1, 0) END AS version
        FROM (
          SELECT r.*, t.version, coalesce(t.status <> 'processing', true)
              AND row_number() OVER (PARTITION BY r.creator_name ORDER BY r.batch_id) = 1 AS accepted
          FROM (SELECT creator_name, batch_id || '-' || version AS batch_id, content_hash, image_count,
                  unnest(CASE WHEN version % 2 = 0 THEN [1, 2] ELSE [1] END) FROM log
                WHERE processing_date = DATE '2024-01-30') r
          LEFT JOIN (
            SELECT creator_name, arg_max(status, (updated_at, version)) AS status,
              arg_max(version, (updated_at, version)) AS version
            FROM log WHERE processing_date = DATE '2024-01-30' AND created_at < TIMESTAMP '2024-01-30 12:00:00'
            GROUP BY creator_name) t ON r.creator_name = t.creator_name)""",
    "status_update": """
        SELECT s.creator_name, '2024-01-30' AS processing_date, new_status AS status, batch_id, content_hash,
          image_count, coalesce(new_ms, processing_duration_ms) AS processing_duration_ms,
          coalesce(new_key, collage_s3_key) AS collage_s3_key, coalesce(new_error, error_message) AS error_message,
          ttl, version + 1 AS version, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
          '2024-01-31 00:00:00' AS updated_at
        FROM state s JOIN updates u ON s.creator_name = u.creator_name AND s.processing_date = u.processing_date""",
    "status_stream": f"SELECT {STATE_COLUMNS} FROM swept",
    "unmatched_updates": """
        SELECT creator_name, new_status AS status FROM updates
        WHERE creator_name NOT IN (SELECT creator_name FROM state WHERE processing_date = DATE '2024-01-30')""",
    "stale_cleanup": """
        SELECT creator_name, strftime(processing_date, '%Y-%m-%d') AS processing_date, 'failed' AS status, batch_id,
          content_hash, image_count, processing_duration_ms, collage_s3_key,
          'Processing timed out after 30 minutes' AS error_message, ttl, version + 1 AS version,
          strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, '2024-01-31 00:00:00' AS updated_at
        FROM state WHERE status = 'processing' AND created_at < TIMESTAMP '2024-01-30 23:30:00'""",
    "batch_status": """
        SELECT batch_id, count(status) AS total_creators, count(*) FILTER (status = 'completed') AS completed,
          count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'processing') AS processing,
          CASE WHEN count(status) > 0 THEN CAST(count(*) FILTER (status = 'completed') AS DOUBLE) / count(status) * 100
            ELSE 0 END AS completion_percentage
        FROM (SELECT DISTINCT 'b' || (event_id % 60) AS batch_id FROM events) LEFT JOIN state USING (batch_id)
        GROUP BY batch_id""",
    "batch_records": "SELECT creator_name, status, processing_duration_ms FROM state WHERE batch_id = 'b7'",
    "daily_stats": """
        SELECT strftime(processing_date, '%Y-%m-%d') AS processing_date, count(*) AS creators,
          CAST(sum(image_count) AS BIGINT) AS images, CAST(sum(processing_duration_ms) AS BIGINT) AS duration_ms,
          round_even(CAST(sum(image_count) AS DOUBLE) / count(*), 2) AS avg_images,
          round_even(CAST(sum(processing_duration_ms) AS DOUBLE) / count(*), 2) AS avg_duration_ms
        FROM state WHERE status = 'completed' AND processing_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
        GROUP BY ROLLUP (processing_date)""",
    "processed_decision": """
        SELECT creator_name, content_hash, rule IN ('same', 'today', 'running') AS processed,
          CASE rule WHEN 'none' THEN 'No processing records found'
            WHEN 'same' THEN 'Same content already processed successfully'
            WHEN 'changed' THEN 'Content has changed since last processing'
            WHEN 'today' THEN 'Already processed successfully today'
            WHEN 'stale' THEN 'Previous processing appears stale'
            WHEN 'running' THEN 'Currently being processed'
            ELSE 'Previous processing failed or incomplete' END AS reason,
          rule = 'changed' AS content_changed, rule = 'stale' AS stale, status AS latest_status,
          coalesce(collage_s3_key, '') AS latest_key
        FROM (
          SELECT p.creator_name, p.content_hash, s.status, s.collage_s3_key,
            CASE WHEN s.creator_name IS NULL THEN 'none'
              WHEN p.content_hash <> '' AND p.content_hash = s.content_hash AND s.status = 'completed' THEN 'same'
              WHEN p.content_hash <> '' AND p.content_hash <> s.content_hash THEN 'changed'
              WHEN s.processing_date = DATE '2024-01-30' AND s.status = 'completed' THEN 'today'
              WHEN s.status = 'processing' AND s.created_at < TIMESTAMP '2024-01-30 11:30:00' THEN 'stale'
              WHEN s.status = 'processing' THEN 'running' ELSE 'other' END AS rule
          FROM (
            SELECT 'u' || user_id || CASE WHEN user_id % 10 = 9 THEN 'z' ELSE '' END AS creator_name,
              CASE WHEN user_id % 4 = 0 THEN md5('x') WHEN user_id % 4 = 1 THEN ''
                ELSE arg_max(md5(props), event_id) END AS content_hash
            FROM events GROUP BY user_id) p
          LEFT JOIN (
            SELECT * FROM log WHERE created_at <= TIMESTAMP '2024-01-30 12:00:00'
            QUALIFY row_number() OVER (PARTITION BY creator_name
              ORDER BY processing_date DESC, updated_at DESC, version DESC) = 1) s
          ON p.creator_name = s.creator_name)""",
    "skip_decision": """
        SELECT creator_name, s3_key, should_skip, skip_reason, existing_bytes, content_has_changed FROM skips""",
    "final_decision": """
        SELECT creator_name, content_hash, image_count,
          CASE WHEN rule IN (1, 3) OR should_skip THEN 'skip' ELSE 'process' END AS action,
          CASE rule WHEN 1 THEN 'Same content already processed successfully'
            WHEN 3 THEN 'Already processed successfully today' ELSE skip_reason END AS reason,
          CASE WHEN rule IN (1, 3) THEN 'old/' || creator_name ELSE s3_key END AS s3_key
        FROM (
          SELECT *, CASE WHEN k % 5 = 0 THEN 0 WHEN k % 4 = 0 AND k % 3 = 0 THEN 1 WHEN k % 4 = 1 THEN 2
            WHEN k % 3 = 0 AND k % 4 <> 0 THEN 3 ELSE 4 END AS rule
          FROM (SELECT *, CAST(substr(creator_name, 10) AS BIGINT) AS k FROM skips))""",
    "existing_for_creator": "SELECT creator_name, s3_key, size_bytes FROM objects",
    "existing_page": """
        SELECT creator_name, s3_key,
          CAST((row_number() OVER (PARTITION BY creator_name ORDER BY s3_key) - 1) // 5 AS INTEGER) AS page FROM objects""",
    "retention_plan": """
        SELECT creator_name, s3_key, CASE WHEN row_number() OVER (PARTITION BY creator_name
          ORDER BY last_modified DESC, s3_key) <= 2 THEN 'keep' ELSE 'delete' END AS action FROM objects""",
    "object_metadata": """
        SELECT s3_key, size_bytes, content_type, split_part(s3_key, '/', 3) AS file_name,
          split_part(split_part(s3_key, '/', 3), '_collage_', 1) AS creator_from_key FROM objects""",
    "object_stats": """
        SELECT count(*) AS total_collages, count(DISTINCT creator_name) AS unique_creators,
          round_even(CAST(sum(size_bytes) AS DOUBLE) / 1048576, 2) AS total_size_mb,
          round_even(CAST(sum(size_bytes) AS DOUBLE) / 1048576 / count(*), 2) AS average_size_mb,
          count(*) FILTER (size_bytes < 1048576) AS small,
          count(*) FILTER (size_bytes >= 1048576 AND size_bytes < 10485760) AS medium,
          count(*) FILTER (size_bytes >= 10485760) AS large,
          round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT creator_name), 2) AS collages_per_creator
        FROM objects""",
    "object_integrity": """
        SELECT s3_key, size_bytes BETWEEN 51200 AND 52428800 AND content_type = 'image/jpeg' AS valid,
          days AS age_days, concat_ws('|',
            CASE WHEN size_bytes < 51200
                THEN 'minimum_size:false:File too small: ' || size_bytes || ' bytes (min: 51200)'
              WHEN size_bytes > 52428800
                THEN 'maximum_size:false:File too large: ' || size_bytes || ' bytes (max: 52428800)'
              ELSE 'size_validation:true:File size OK: ' || size_bytes || ' bytes' END,
            CASE WHEN content_type = 'image/jpeg' THEN 'content_type:true:Content type OK: image/jpeg'
              ELSE 'content_type:false:Invalid content type: ' || content_type END,
            CASE WHEN days > 30 THEN 'age_warning:true:Collage is ' || days || ' days old' END) AS checks
        FROM (SELECT *, datediff('day', last_modified, TIMESTAMP '2001-08-02') AS days FROM objects)""",
    "lifecycle_tiers": """
        SELECT p || o_orderkey AS s3_key, store, CAST(days AS INTEGER) AS age_days,
          CASE WHEN p <> 'other/' THEN store || ':' || p END AS rule,
          CASE WHEN p = 'csv-files/' AND days >= 365 THEN 'DEEP_ARCHIVE'
            WHEN p = 'csv-files/' AND days >= 90 THEN 'GLACIER'
            WHEN p = 'csv-files/' AND days >= 30 THEN 'STANDARD_IA'
            WHEN p = 'collages/' AND days >= 365 THEN 'GLACIER'
            WHEN p = 'collages/' AND days >= 90 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS tier,
          CASE p WHEN 'archived/failed/' THEN days >= 90 WHEN 'results/processing-summaries/' THEN days >= 365
            WHEN 'processing/' THEN days >= 7 WHEN 'debug/' THEN days >= 30 WHEN 'large-files/' THEN days >= 3
            ELSE false END AS expired
        FROM (
          SELECT o_orderkey, datediff('day', o_orderdate, TIMESTAMP '1998-06-01') AS days,
            ['csv-files/', 'archived/failed/', 'collages/', 'results/processing-summaries/', 'processing/', 'debug/',
             'large-files/', 'other/'][o_orderkey % 8 + 1] AS p,
            ['input', 'input', 'output', 'output', 'temp', 'temp', 'temp', 'output'][o_orderkey % 8 + 1] AS store
          FROM orders)""",
    "lifecycle_by_rules": """
        SELECT * FROM (WITH rules AS (
          SELECT ['input', 'output', 'temp'][n_nationkey + 1] AS store, ['csv-files/', 'collages/', ''][n_nationkey + 1] AS prefix,
            30 AS age, 'STANDARD_IA' AS tier FROM nation WHERE n_nationkey < 3
          UNION ALL SELECT 'input', 'csv-files/' || n_nationkey, n_regionkey * 100 + 300, 'GLACIER' FROM nation
          UNION ALL SELECT 'input', 'csv-files/' || n_nationkey, n_regionkey * 100 + 1200, 'DEEP_ARCHIVE' FROM nation),
        stored AS (
          SELECT datediff('day', o_orderdate, TIMESTAMP '1998-06-01') AS days,
            ['csv-files/', 'archived/failed/', 'collages/', 'results/processing-summaries/', 'processing/', 'debug/',
             'large-files/', 'other/'][o_orderkey % 8 + 1] || o_orderkey AS s3_key,
            ['input', 'input', 'output', 'output', 'temp', 'temp', 'temp', 'output'][o_orderkey % 8 + 1] AS store
          FROM orders),
        best AS (
          SELECT s.store, s.s3_key, s.days, max(r.prefix) AS rule
          FROM stored s LEFT JOIN rules r ON r.store = s.store AND starts_with(s.s3_key, r.prefix) GROUP BY ALL)
        SELECT b.s3_key, b.store, CAST(b.days AS INTEGER) AS age_days, b.rule,
          coalesce(arg_max(r.tier, r.age) FILTER (r.age <= b.days), 'STANDARD') AS tier
        FROM best b LEFT JOIN rules r ON r.store = b.store AND r.prefix = b.rule GROUP BY ALL)""",
    "cell_size": "SELECT * FROM cells",
    "cell_size_by_width": """
        SELECT creator_name, count(*) AS images, 257 AS cell_w,
          CAST(trunc(avg(CAST(height AS DOUBLE) / width) * 257) AS INTEGER) AS cell_h FROM usable GROUP BY creator_name""",
    "cell_size_by_height": """
        SELECT creator_name, count(*) AS images,
          CAST(trunc(avg(CAST(width AS DOUBLE) / height) * 263) AS INTEGER) AS cell_w, 263 AS cell_h
        FROM usable GROUP BY creator_name""",
    "grid_layout": f"""
        SELECT creator_name, {LAYOUT}, CAST(i % 7 * cell_w AS INTEGER) AS x, CAST(i // 7 * cell_h AS INTEGER) AS y,
          cell_w, cell_h, cell_w * 7 AS canvas_w, cell_h * 5 AS canvas_h
        FROM numbered JOIN cells USING (creator_name) WHERE i < 35""",
    "grid_layout_crop": f"""
        SELECT creator_name, {LAYOUT}, CAST(i % 7 * 200 AS INTEGER) AS x, CAST(i // 7 * 200 AS INTEGER) AS y,
          200 AS cell_w, 200 AS cell_h, 1400 AS canvas_w, CAST(ceil(least(n, 35) / 7.0) * 200 AS INTEGER) AS canvas_h
        FROM numbered WHERE i < 35""",
    "combined_layout": """
        SELECT source_creator, l_orderkey, l_linenumber, CAST(i % 7 * cell_w AS INTEGER) AS x,
          CAST(i // 7 * cell_h AS INTEGER) AS y, cell_w, cell_h
        FROM (
          SELECT *, row_number() OVER (ORDER BY f, l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS i,
            least(greatest(CAST(trunc(avg(width) OVER ()) AS INTEGER), 200), 800) AS cell_w,
            least(greatest(CAST(trunc(avg(height) OVER ()) AS INTEGER), 200), 800) AS cell_h
          FROM (
            SELECT creator_name AS source_creator, l_orderkey, l_linenumber, l_partkey, l_extendedprice, width, height, f
            FROM (SELECT *, min((l_orderkey, l_linenumber, l_partkey, l_extendedprice))
                    OVER (PARTITION BY creator_name) AS f FROM usable)
            ORDER BY f, l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 105))
        WHERE i < 35""",
    "compose_collage": """
        SELECT creator_name, 32 * 7 AS width, 24 * 5 AS height, CAST(count(*) AS INTEGER) AS placed,
          CAST(sum(i * channels * 32 * 24) + (630 - sum(i)) * 765 * 32 * 24 AS BIGINT) AS checksum
        FROM rasters WHERE i <= 35 GROUP BY creator_name""",
    "image_duplicates": """
        SELECT lang AS batch_id, doc_id AS ord, sha256(text) AS image_hash,
          count(*) OVER (PARTITION BY lang, text) AS copies,
          doc_id <> min(doc_id) OVER (PARTITION BY lang, text) AS duplicate
        FROM documents""",
    "fetch_counts": """
        SELECT creator_name, count(*) AS attempted, count(*) FILTER (fine) AS fetched, count(*) FILTER (NOT fine) AS failed,
          CAST(sum(CASE WHEN ord % 10 = 3 OR marker THEN 3 ELSE 1 END) AS BIGINT) AS attempts,
          CAST(sum(ord % 100) FILTER (fine) AS BIGINT) AS bytes
        FROM (SELECT *, cover_url LIKE 'ERROR:%' AS marker,
            cover_url NOT LIKE 'ERROR:%' AND ord % 10 NOT IN (3, 7) AS fine FROM items WHERE trim(cover_url) <> '')
        GROUP BY creator_name""",
    "message_routing": """
        SELECT message_id, processing_type, CASE WHEN kind = 0 THEN 'in' END AS s3_bucket,
          CASE WHEN kind = 0 THEN 'csv-files/' || k || '.csv' END AS s3_key,
          CASE WHEN kind = 0 THEN 'p/' WHEN kind IN (1, 4) THEN 'sqs-data/' END AS output_prefix,
          CASE WHEN kind = 0 THEN 's3_ref_csv-files/' || k || '_20010802_000000'
            WHEN kind IN (1, 4) THEN 'sqs_data_20010802_000000' END AS batch_id,
          reason
        FROM routed""",
    "merged_config": """
        SELECT message_id, true AS group_by_creator,
          CAST(CASE WHEN kind = 0 THEN k % 7 + 1 WHEN far THEN 0 ELSE 5 END AS INTEGER) AS rows, 7 AS cols,
          CASE WHEN kind <> 0 THEN 35 END AS max_images_per_creator,
          CASE WHEN kind = 1 THEN 90 WHEN far THEN 101 ELSE 95 END AS quality,
          CASE WHEN far THEN 21 ELSE 8 END AS max_workers, CASE WHEN far THEN 301 ELSE 30 END AS timeout,
          3 AS max_retries
        FROM messages WHERE kind <> 3""",
    "config_validation": """
        SELECT message_id, CASE WHEN far THEN 'rows must be positive|quality must be between 1 and 100|'
          || 'max_workers should not exceed 20|timeout should not exceed 300 seconds'
          WHEN kind = 4 THEN 'rows has the wrong type|cols has the wrong type' ELSE '' END AS errors
        FROM messages""",
    "message_items": """
        SELECT message_id, 'sqs_data_20010802_000000' AS batch_id, creator_name, cover_url, updated_at,
          CAST(line AS BIGINT) AS line FROM message_rows""",
    "dead_letters": """
        SELECT reason, 1 AS attempt, count(*) AS messages FROM routed WHERE reason IS NOT NULL GROUP BY reason""",
    "dead_letter_patterns": """
        SELECT CASE WHEN kind = 3 THEN 'parse_error' ELSE coalesce(processing_type, 'unknown') END AS pattern,
          count(*) AS messages
        FROM routed WHERE reason IS NOT NULL GROUP BY 1""",
    "reprocess_messages": """
        SELECT CASE WHEN kind = 4 THEN '{"processing_type":"csv_data","csv_data":"creator_name,cover_url,updated_at",'
            || '"processing_config":' || CASE WHEN far THEN '{"max_workers":21,"quality":101,"rows":0,"timeout":301}}'
              ELSE '{"cols":2.7,"quality":null,"rows":"abc"}}' END
            WHEN k % 2 = 0 THEN '{"processing_type":"zip_file"}' ELSE '{"csv_data":"x"}' END AS body,
          processing_type, 'dlq_reprocess' AS source, '2001-08-02T00:00:00' AS stamp, '120' AS timeout,
          '5' AS max_retries, '4' AS max_workers, CASE WHEN far THEN '101' END AS quality
        FROM routed WHERE kind IN (2, 4)""",
    "run_summary": """
        SELECT day, count(*) AS total_creators, count(*) FILTER (outcome = 'created') AS created,
          count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed,
          count(*) FILTER (outcome <> 'failed') AS collages_listed,
          CAST(coalesce(sum(k) FILTER (outcome <> 'failed'), 0) AS BIGINT) AS listed_images
        FROM results GROUP BY day""",
    "stored_summary": """
        SELECT day, count(*) AS total_creators, count(*) FILTER (outcome = 'created') AS created,
          count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed,
          CAST(coalesce(sum(k) FILTER (outcome <> 'failed'), 0) AS BIGINT) AS listed_images
        FROM results GROUP BY day""",
    "run_summary_total": """
        SELECT count(*) AS total_creators, count(*) FILTER (outcome = 'created') AS created,
          count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'failed') AS failed,
          count(*) FILTER (outcome <> 'failed') AS collages_listed,
          CAST(coalesce(sum(k) FILTER (outcome <> 'failed'), 0) AS BIGINT) AS listed_images,
          (SELECT count(*) FROM valid) AS total_urls
        FROM results""",
    "timing_summary": """
        SELECT day, count(*) AS collages, CAST(sum(download_ms) AS BIGINT) AS total_download_ms,
          CAST(sum(k) AS BIGINT) AS total_placement_ms, CAST(sum(save_ms) AS BIGINT) AS total_save_ms,
          CAST(sum(download_ms + k + save_ms) AS BIGINT) AS total_ms,
          CAST(sum(download_ms + k + save_ms) AS DOUBLE) / count(*) AS avg_ms
        FROM results WHERE outcome = 'created' GROUP BY day""",
    "stream_messages": """
        SELECT processing_type, reason,
          CAST(CASE WHEN kind = 0 THEN k % 7 + 1 WHEN far THEN 0 ELSE 5 END AS INTEGER) AS rows,
          count(*) AS messages FROM routed GROUP BY ALL""",
    "stream_message_items": "SELECT creator_name, cover_url, updated_at FROM message_rows",
    "redelivered_messages": """
        SELECT 'order-' || o_orderkey AS sender, 'first' AS body, CASE WHEN o_orderkey % 11 = 0 THEN 2 ELSE 1 END AS messages,
          CAST(NULL AS VARCHAR) AS reason FROM orders
        UNION ALL SELECT 'order-' || o_orderkey, 'next', 1, NULL FROM orders WHERE o_orderkey % 5 = 0
        UNION ALL SELECT 'order-' || o_orderkey, 'late', 1,
          CASE WHEN o_orderkey % 10 = 0 THEN 'no time of sending' ELSE 'late' END FROM orders WHERE o_orderkey % 7 = 0""",
    "stream_references": """
        SELECT 'item' AS kind, CASE WHEN ord % 3 = 2 THEN 'unknown' ELSE creator_name END AS creator_name, cover_url
        FROM valid
        UNION ALL SELECT 'dead', 'missing file', 'gone/' || c_custkey || '.csv' FROM customer WHERE c_custkey % 10 = 0
        UNION ALL SELECT 'dead', 'missing file', '0' FROM region WHERE r_regionkey = 0""",
    "stream_files": "SELECT creator_name, count(*) AS urls FROM valid GROUP BY creator_name",
}

ORACLE: dict[str, str] = {name: _sql(text) for name, text in FINAL.items()}
