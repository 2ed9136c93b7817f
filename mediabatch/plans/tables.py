"""The domain's input tables, derived from the star-schema test tables.

`Tables` reads the given parquet files; each method is a plain projection, join or aggregate of them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediabatch.functions.text import canonical_json, safe_name

EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(2001, 8, 2)

# Links of one record come from one range of order keys, so a record's list has a fixed bound.
KEYS_PER_LINK = 5_000


def text_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows for costly work per row, dealt out evenly: a small table would keep them in few tasks."""
        return rows.repartition(4 * self.spark.sparkContext.defaultParallelism)

    def _orders(self) -> DataFrame:
        customers = self.raw("customer").select("c_custkey", "c_name")
        return self.raw("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))

    def _item_rows(self) -> DataFrame:
        key = F.col("o_orderkey")
        url = (
            F.when(key % 17 == 0, "ERROR: bad")
            .when(key % 13 == 0, "  ")
            .otherwise(F.concat(F.lit("https://img.example/"), key.cast("string"), F.lit(".jpg")))
        )
        return self._orders().select(
            F.col("c_name").alias("creator_name"),
            url.alias("cover_url"),
            text_time(F.col("o_orderdate")).alias("updated_at"),
            key.alias("ord"),
            "o_custkey",
            "o_orderdate",
        )

    def items(self) -> DataFrame:
        return self._item_rows().drop("o_custkey", "o_orderdate")

    def links(self) -> DataFrame:
        url = F.array_sort(F.collect_list(F.struct("ord", "cover_url")))
        text = F.to_json(F.transform("urls", lambda p: p["cover_url"]))
        key = F.col("o_custkey")
        return (
            self._item_rows()
            .withColumn("chunk", F.floor(F.col("ord") / KEYS_PER_LINK))
            .groupBy("creator_name", "o_custkey", "chunk")
            .agg(url.alias("urls"), F.max("o_orderdate").alias("updated_at"))
            .select(
                "creator_name",
                F.when(key % 11 == 0, F.lit(None)).when(key % 19 == 0, "{bad").when(key % 23 == 0, "[]")
                .otherwise(text).alias("cover_urls"),
                "updated_at",
            )
        )

    def order_links(self) -> DataFrame:
        """One link record per order, for the predicates that should reach the scan."""
        key = F.col("o_orderkey").cast("string")
        return self._orders().select(
            F.col("c_name").alias("creator_name"),
            F.concat(F.lit('["https://img.example/'), key, F.lit('.jpg"]')).alias("cover_urls"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def seen_creators(self) -> DataFrame:
        return self.raw("customer").where("c_custkey % 5 = 0").select(F.col("c_name").alias("creator_name"))

    def pages_items(self) -> DataFrame:
        return self.raw("pages").select(
            F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("creator_name"),
            F.col("url").alias("cover_url"),
            F.lit("").alias("updated_at"),
            F.col("page_id").alias("ord"),
        )

    def state_log(self) -> DataFrame:
        kind, user = F.col("event_type"), F.col("user_id").cast("string")
        done = kind.isin("purchase", "click", "signup")
        status = F.when(done, "completed").when(kind == "error", "failed").otherwise("processing")
        started = F.col("ts").cast("timestamp")
        ttl = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") + 30 * 86_400
        key = F.concat(F.lit("out/collages/u"), user, F.lit("_collage_"), F.substring(F.md5("props"), 1, 12),
                       F.lit(".jpg"))
        return self.raw("events").select(
            F.concat(F.lit("u"), user).alias("creator_name"),
            F.col("ts").cast("date").alias("processing_date"),
            status.alias("status"),
            F.concat(F.lit("b"), (F.col("event_id") % 50).cast("string")).alias("batch_id"),
            F.md5("props").alias("content_hash"),
            F.get_json_object("props", "$.k").cast("long").alias("image_count"),
            F.lit("{}").alias("processing_config"),
            started.alias("created_at"),
            started.alias("updated_at"),
            ttl.cast("long").alias("ttl"),
            F.lit("local-test").alias("lambda_request_id"),
            F.floor(F.col("value") * 10).cast("long").alias("processing_duration_ms"),
            F.when(done, key).otherwise("").alias("collage_s3_key"),
            F.lit(None).cast("string").alias("error_message"),
            F.col("event_id").alias("version"),
        )

    def state_probe(self) -> DataFrame:
        """One row per user: its newest hash, a foreign or an empty one, plus users without a record."""
        newest = self.raw("events").groupBy("user_id").agg(F.max_by(F.md5("props"), "event_id").alias("h"))
        user = F.col("user_id")
        content = F.when(user % 4 == 0, F.md5(F.lit("x"))).when(user % 4 == 1, "").otherwise(F.col("h"))
        name = F.concat(F.lit("u"), user.cast("string"), F.when(user % 10 == 9, "z").otherwise(""))
        return newest.select(name.alias("creator_name"), content.alias("content_hash"))

    def objects(self) -> DataFrame:
        key = F.col("o_orderkey")
        factor = F.when(key % 3 == 0, 1).when(key % 3 == 1, 20).otherwise(200)
        name = F.concat(
            F.lit("out/collages/"), safe_name(F.col("c_name")), F.lit("_collage_"),
            F.substring(F.md5(key.cast("string")), 1, 12), F.lit(".jpg"),
        )
        return self._orders().select(
            name.alias("s3_key"),
            F.floor(F.col("o_totalprice") * factor).cast("long").alias("size_bytes"),
            F.col("o_orderdate").alias("last_modified"),
            F.when(key % 29 == 0, "image/png").otherwise("image/jpeg").alias("content_type"),
        )

    def stored_objects(self) -> DataFrame:
        """One object per order, spread over the prefixes of the three stores."""
        key = F.col("o_orderkey")
        places = ["input:csv-files/", "input:archived/failed/", "output:collages/",
                  "output:results/processing-summaries/", "temp:processing/", "temp:debug/",
                  "temp:large-files/", "output:other/"]
        place = F.element_at(F.array(*[F.lit(p) for p in places]), (key % len(places)).cast("int") + 1)
        return self.raw("orders").select(
            F.substring_index(place, ":", 1).alias("store"),
            F.concat(F.substring_index(place, ":", -1), key.cast("string")).alias("s3_key"),
            F.col("o_orderdate").alias("last_modified"),
        )

    def dims(self) -> DataFrame:
        """Image sizes: one image per line item, the supplier as creator."""
        parts = self.raw("part").select("p_partkey", "p_size")
        quantity = F.floor("l_quantity").cast("int")
        return (
            self.raw("lineitem")
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("creator_name"),
                F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("ord"),
                (40 + F.col("p_size") * 20).alias("width"),
                (30 + quantity * 15).alias("height"),
                "p_size",
                quantity.alias("quantity"),
            )
        )

    def image_sizes(self) -> DataFrame:
        """Sizes of the generated images; some are too small."""
        width, height = 50 + F.col("p_size") % 10, 46 + F.col("quantity") % 10
        return self.dims().withColumns({"width": width.cast("int"), "height": height.cast("int")})

    def image(self) -> Column:
        """A decoded one-colour image made by Spark from a row of `image_sizes`, a quarter in colour, others grey."""
        colour = F.col("ord.l_linenumber") % 4 == 0
        blue, green, red = F.col("ord.l_orderkey") % 256, F.col("ord.l_linenumber") * 30, F.col("p_size") * 5
        hexes = [F.lpad(F.hex(c.cast("long")), 2, "0") for c in (blue, green, red)]
        pixel = F.when(colour, F.concat(*hexes)).otherwise(hexes[0])
        return F.struct(
            F.lit("").alias("origin"),
            "height",
            "width",
            F.when(colour, 3).otherwise(1).alias("nChannels"),
            F.when(colour, 16).otherwise(0).alias("mode"),
            F.unhex(F.repeat(pixel, F.col("width") * F.col("height"))).alias("data"),
        )

    def images(self) -> DataFrame:
        return self._spread(self.image_sizes()).select("creator_name", "ord", self.image().alias("image"))

    def messages(self) -> DataFrame:
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        k, c = key.cast("string"), customer.cast("string")
        stored = F.concat(
            F.lit('{"processing_type":"csv_s3","s3_bucket":"in","s3_key":"csv-files/'), k,
            F.lit('.csv","processing_config":{"rows":'), (key % 7 + 1).cast("string"),
            F.lit(',"max_images_per_creator":null},"output_prefix":"p/"}'),
        )
        embedded = F.concat(
            F.lit('{"processing_type":"csv_data","csv_data":"creator_name,cover_url,updated_at\\nc'), c,
            F.lit(",https://img.example/"), k, F.lit(".jpg,2001\\nc"), c,
            F.lit(',ERROR: x,2001\\n d ,https://img.example/d'), k,
            F.lit('.jpg","processing_config":{"quality":90}}'),
        )
        unsupported = F.when(key % 2 == 0, '{"processing_type":"zip_file"}').otherwise('{"csv_data":"x"}')
        # Out of range, or of the wrong type.
        bad = {"rows": 0, "quality": 101, "max_workers": 21, "timeout": 301}
        odd = {"cols": 2.7, "quality": None, "rows": "abc"}
        wrong = F.concat(
            F.lit('{"processing_type":"csv_data","csv_data":"creator_name,cover_url,updated_at","processing_config":'),
            F.when(key % 2 == 0, canonical_json(bad)).otherwise(canonical_json(odd)), F.lit("}"),
        )
        body = (
            F.when(key % 5 == 0, stored)
            .when(key % 5 == 1, embedded)
            .when(key % 5 == 2, unsupported)
            .when(key % 5 == 3, '{"processing_type":"csv_s3"')
            .otherwise(wrong)
        )
        orders = self._spread(self.raw("orders").select("o_orderkey", "o_custkey"))
        return orders.select(key.alias("message_id"), body.alias("body"))

    def results(self) -> DataFrame:
        """Per-creator run results, one per event."""
        kind = F.col("event_type")
        outcome = F.when(kind.isin("purchase", "click"), "created").when(kind == "view", "skipped")
        return self.raw("events").select(
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("creator_name"),
            F.date_format("ts", "yyyy-MM-dd").alias("day"),
            outcome.otherwise("failed").alias("outcome"),
            F.get_json_object("props", "$.k").cast("long").alias("image_count"),
            F.floor(F.col("value") * 10).cast("long").alias("download_ms"),
            F.get_json_object("props", "$.k").cast("long").alias("placement_ms"),
            (F.col("event_id") % 7).alias("save_ms"),
        )
