"""Given parquet tables and the feeds Spark derives from them.

The feeds map the driver tables onto the data model, row-locally wherever
possible (no shuffles except where a grouping is the point):

* comment feed   (events)            -- one flat comment row per event
* nested feed    (events, customer)  -- comments grouped back to posts, plus
                                        comment-less announcement posts
* usage feed     (events)            -- owner struct, day, SKU, decimal quantity
* rule input     (orders)            -- orders with NULLs and a text column
* landing rows   (orders)            -- rows labelled with landing-file names
* message feed   (events)            -- Kafka-shaped records, some malformed
* raw JSON feed  (events)            -- JSON objects with unknown keys

Control tables derived from ``orders`` live in ``sources/control.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens import schemas
from feedlens.functions.dates import iso_text

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Message pool of the derived comment feed (index = event_id % 12): remarks on a night train.
MESSAGE_POOL = [
    "A wonderful journey, the bunk was great and the crew helpful!",
    "We did not enjoy the ride; the heating was awful all night.",
    "Carriage seven, upper berth, window on the left.",
    "Excellent breakfast and a beautiful view over the lake",
    "Terrible noise near the buffet car, a waste of money",
    None,
    "The booking desk made a bad mistake with our tickets",
    "Very friendly conductor, I love travelling this way",
    "",
    "Hmm. Good pillows, poor lighting, otherwise fine.",
    "Arrived early: amazing! The staff were perfect hosts.",
    "Is there a place for bicycles on the evening service?",
]

# Name of the derived message feed's topic.
TOPIC = "post_feed"

# SKU per event type in the usage feed.
SKU_BY_EVENT = {
    "view": "STANDARD_ALL_PURPOSE_COMPUTE",
    "click": "ENTERPRISE_SERVERLESS_SQL_COMPUTE",
    "signup": "STANDARD_JOBS_COMPUTE",
    "error": "PREMIUM_ALL_PURPOSE_COMPUTE_SERVERLESS_SQL",
    "purchase": "STANDARD_DLT_CORE",
}

# Which rows of the derived feeds carry NULLs or bad text.
NULL_OWNER_USER = 7
ANNOUNCEMENT_TIME = "2024-01-01T00:00:00.000000+0000"
NULL_PRIORITY = "5-LOW"
NULL_STATUS = "P"
BAD_REF_EVERY = 7  # cust_ref is text 'n/a' on every 7th order key
NULL_KEY_EVERY = 500  # o_orderkey NULL where o_orderkey % 500 = 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pool_text(index: Column) -> Column:
    """Message at ``index`` of MESSAGE_POOL (a literal array; no join)."""
    arr = F.array(*[F.lit(m).cast("string") for m in MESSAGE_POOL])
    return F.element_at(arr, (index % len(MESSAGE_POOL)).cast("int") + 1)


def _post_no() -> Column:
    return F.expr("event_id div 4")


def comment_feed(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """Flat comment rows (post columns repeated) derived from ``events``;
    ``with_source`` adds the event type as the feed's ``source``."""
    ev = table(spark, sf_dir, "events")
    post = _post_no()
    extra = [F.col("event_type").alias("source")] if with_source else []
    return ev.select(
        F.concat(F.lit("p"), post.cast("string")).alias("id"),
        iso_text(F.date_trunc("hour", F.col("ts"))).alias("created_time"),
        pool_text(post).alias("message"),
        (F.lit(100) + (post * 37) % 901).cast("long").alias("total_count"),
        F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("comment_id"),
        iso_text(F.col("ts")).alias("comment_created_time"),
        pool_text(F.col("event_id")).alias("comment_message"),
        F.floor("value").cast("long").alias("comment_likes"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("comment_author"),
        *extra,
    )


def nested_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with their comments nested, like the landing JSON.

    Every event is a comment of post ``event_id div 4`` (groups of at most 4,
    so no group is unbounded). Posts without comments come from ``customer``:
    one announcement post per customer, with no ``comments`` object for even
    keys and an empty comment array for odd keys.
    """
    flat = comment_feed(spark, sf_dir)
    comment = F.struct(
        F.col("comment_id").alias("id"),
        F.col("comment_created_time").alias("created_time"),
        F.struct(F.concat(F.lit("u-"), F.col("comment_author")).alias("id"),
                 F.col("comment_author").alias("name")).alias("from"),
        F.col("comment_message").alias("message"),
        F.col("comment_likes").alias("like_count"),
    )
    page = F.struct(F.lit("page-1").alias("id"), F.lit("Brand Official").alias("name"))
    posts = (flat.groupBy("id", "message", "total_count")
             .agg(F.min("created_time").alias("created_time"), F.collect_list(comment).alias("_data"))
             .select("id", "created_time", page.alias("from"), "message",
                     F.struct(F.struct(F.col("total_count").alias("total_count")).alias("summary"))
                      .alias("likes"),
                     F.struct(F.col("_data").alias("data")).alias("comments")))
    cust = table(spark, sf_dir, "customer")
    announcements = cust.select(
        F.concat(F.lit("a"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit(ANNOUNCEMENT_TIME).alias("created_time"),
        page.alias("from"),
        F.concat(F.lit("Welcome "), F.col("c_name")).alias("message"),
        F.struct(F.struct((F.col("c_custkey") % 1000).cast("long").alias("total_count"))
                 .alias("summary")).alias("likes"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit(None))
         .otherwise(F.struct(F.array().cast(T.ArrayType(schemas.COMMENT)).alias("data")))
         .alias("comments"))
    return posts.unionByName(announcements)


def usage_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing-usage rows: owner struct (NULL owner for one user), day, SKU, quantity."""
    ev = table(spark, sf_dir, "events")
    sku = F.coalesce(*[F.when(F.col("event_type") == et, F.lit(name)) for et, name in SKU_BY_EVENT.items()],
                     F.lit("OTHER"))
    owner = F.when(F.col("user_id") == NULL_OWNER_USER, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")))
    return ev.select(
        F.struct(owner.alias("owned_by")).alias("identity_metadata"),
        F.to_date("ts").alias("usage_date"),
        sku.alias("sku_name"),
        F.col("value").cast("decimal(12,2)").alias("usage_quantity"),
    )


def rule_input(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """``orders`` with NULLs planted in two columns and in some keys, plus a text
    column ``cust_ref`` that is not always an integer; ``extra`` columns over ``orders`` come last."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % NULL_KEY_EVERY == 13, F.lit(None).cast("long")).otherwise(k).alias("o_orderkey"),
        "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit(NULL_STATUS)).alias("o_orderstatus"),
        "o_totalprice",
        F.to_date("o_orderdate").alias("o_orderdate"),
        F.nullif(F.col("o_orderpriority"), F.lit(NULL_PRIORITY)).alias("o_orderpriority"),
        F.when(k % BAD_REF_EVERY == 0, F.lit("n/a"))
         .otherwise(F.col("o_custkey").cast("string")).alias("cust_ref"),
        *extra,
    )


# Which order dates give malformed landing names (day-of-year % 10).
NAME_NO_TIME, NAME_BAK_SUFFIX, NAME_BAD_MONTH, NAME_OTHER_PREFIX = 3, 5, 7, 8


def _pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` rows labelled with the landing file they would arrive in:
    one file per order date, some with malformed names."""
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    doy = F.dayofyear(d)
    day = F.date_format(d, "yyyy-MM-dd")
    tm = F.concat_ws("-", _pad2(doy % 24), _pad2((doy * 7) % 60), _pad2((doy * 13) % 60))
    variant = doy % 10
    name = (F.when(variant == NAME_NO_TIME, F.concat(F.lit("post_detail_"), day, F.lit(".json")))
            .when(variant == NAME_BAK_SUFFIX,
                  F.concat(F.lit("post_detail_"), day, F.lit("_"), tm, F.lit(".json.bak")))
            .when(variant == NAME_BAD_MONTH,
                  F.concat(F.lit("post_detail_"), F.date_format(d, "yyyy"), F.lit("-13-"),
                           F.date_format(d, "dd"), F.lit("_"), tm, F.lit(".json")))
            .when(variant == NAME_OTHER_PREFIX,
                  F.concat(F.lit("posts_"), day, F.lit("_"), tm, F.lit(".json")))
            .otherwise(F.concat(F.lit("post_detail_"), day, F.lit("_"), tm, F.lit(".json"))))
    return o.select("o_orderkey", F.concat(F.lit("landing/post_detail/"), name).alias("source_file"))


# Malformed message values planted in the message feed.
BAD_VALUE_EVERY = 97
NULL_KEY_USER_EVERY = 50


def message_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records derived from ``events``."""
    ev = table(spark, sf_dir, "events")
    key = F.when(F.col("user_id") % NULL_KEY_USER_EVERY == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("host-"), F.col("user_id").cast("string")))
    value = F.when(F.col("event_id") % BAD_VALUE_EVERY == 0, F.lit("not json {")).otherwise(F.col("props"))
    return ev.select(key.cast("binary").alias("key"), value.cast("binary").alias("value"),
                     F.lit(TOPIC).alias("topic"),
                     (F.col("user_id") % 4).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"),
                     F.col("ts").cast("timestamp").alias("timestamp"))


def raw_json_feed(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """``events.props`` with extra keys planted on some event types; ``extra`` columns over ``events`` come last."""
    ev = table(spark, sf_dir, "events")
    props = F.col("props")
    raw = (F.when(F.col("event_type") == "click",
                  F.regexp_replace(props, "}$", F.concat(F.lit(', "src": "'), F.col("event_type"), F.lit('"}'))))
           .when(F.col("event_type") == "error",
                 F.regexp_replace(props, "}$", F.concat(F.lit(', "code": '), F.col("user_id").cast("string"),
                                                        F.lit(', "extra": null}'))))
           .when(F.col("event_type") == "signup", F.lit('{"k": "many", "v": [1, {"w": 2.5}]}'))
           .otherwise(props))
    return ev.select("event_id", raw.alias("raw"), *extra)
