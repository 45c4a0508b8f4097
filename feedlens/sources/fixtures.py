"""Landing files and message feeds derived from the given tables.

They follow the registered name pattern (one landing file for each post day, in parts of any number)
and carry the edge cases that the ingest path must handle: names that do not match, the three
shapes of a line, posts with unknown and mistyped values, and lines that hold no post.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.functions.dates import iso_text, utc_date
from feedlens.session import materialize, small
from feedlens.sinks.tables import LANDING_FILE, write_landing as write_lines
from feedlens.sources.tables import TOPIC, nested_feed

# Which post days / posts carry the edge cases.
BAD_NAME_DAY = 5
SHAPES = 3  # by post number: an array of one post, an array of arrays, a bare post
EXTRA_KEY_EVERY, MISTYPED_EVERY, CUT_OFF_EVERY, SCALAR_EVERY = 50, 70, 60, 90


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, n, day, post): every post as JSON text, some with an unknown or a mistyped value."""
    post_json = F.to_json(F.struct(*[F.col(c) for c in schemas.POST_FIELDS]))
    n = F.substring("id", 2, 20).cast("long")  # ids are p<post> / a<customer>
    text = F.when(n % EXTRA_KEY_EVERY == 0, F.regexp_replace(post_json, "}$", ',"channel":"web"}')).otherwise(post_json)
    text = F.when(n % MISTYPED_EVERY == 0, F.regexp_replace(
        text, '"total_count":([0-9]+)', '"total_count":"many"')).otherwise(text)
    return nested_feed(spark, sf_dir).select("id", n.alias("n"), utc_date("created_time").alias("day"),
                                             text.alias("post"))


def landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(landing_file, line): the posts' lines, and after some a line that is cut off or a bare scalar."""
    n, post = F.col("n"), F.col("post")
    line = (F.when(n % SHAPES == 0, F.concat(F.lit("["), post, F.lit("]")))
            .when(n % SHAPES == 1, F.concat(F.lit("[["), post, F.lit("]]"))).otherwise(post))
    junk = [F.when(n % CUT_OFF_EVERY == 0, F.concat(F.lit('[{"id": "'), F.col("id"), F.lit('", "message": "cut off'))),
            F.when(n % SCALAR_EVERY == 0, F.concat(F.lit("["), n.cast("string"), F.lit(', "abc"]')))]
    name = F.concat(F.lit("post_detail_"), F.date_format("day", "yyyy-MM-dd"), F.lit("_00-00-00.json"),
                    F.when(F.dayofmonth("day") == BAD_NAME_DAY, F.lit(".bak")).otherwise(F.lit("")))
    lines: Column = F.filter(F.array(line, *junk), lambda x: x.isNotNull())
    return posts(spark, sf_dir).select(name.alias(LANDING_FILE), F.explode(lines).alias("line"))


def write_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    write_lines(landing_lines(spark, sf_dir), landing)


#: Posts of a day's multi-line JSON file; a day with more gets several, as one task writes a file.
JSON_FILE_POSTS = 100_000


def write_json_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """The same posts as multi-line JSON, a landing file a day: an array, or (by day) an array of arrays, in one part for each ``JSON_FILE_POSTS``
    posts (nearly); some elements are no posts."""
    n, day = F.col("n"), F.col("day")
    name = F.concat(F.lit("post_detail_"), F.date_format("day", "yyyy-MM-dd"), F.lit("_00-00-00.json"),
                    F.when(F.dayofmonth("day") == BAD_NAME_DAY, F.lit(".bak")).otherwise(F.lit("")))
    nested = F.dayofmonth("day") % 2 == 0
    opening, closing = F.when(nested, "[\n [\n").otherwise("[\n"), F.when(nested, "\n ]\n]").otherwise("\n]")
    pretty = F.concat(F.regexp_replace(F.regexp_replace("post", '","', '",\n    "'), r"\{", "{\n   "), F.lit("\n"))
    extra = F.when(n % SCALAR_EVERY == 0, F.concat(F.lit(",\n"), n.cast("string"), F.lit(', "abc"'))).otherwise("")
    every = posts(spark, sf_dir)
    days = every.groupBy("day").agg(F.ceil(F.count("*") / JSON_FILE_POSTS).alias("parts"))
    days = small(materialize(days.withColumn("before", F.sum("parts").over(Window.orderBy("day")) - F.col("parts"))))  # a row a day
    n_files = days.agg(F.coalesce(F.sum("parts"), F.lit(1))).first()[0]
    rows = (every.join(days.withColumnRenamed("day", "_day"), day.eqNullSafe(F.col("_day")))
            .withColumn("file", (F.col("before") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int"))
            .select("file", "id", day, name.alias(LANDING_FILE), F.concat(pretty, extra).alias("value")).repartitionById(int(n_files), "file"))
    ordered = Window.partitionBy("file").orderBy("id")
    first, last = F.row_number().over(ordered) == 1, F.lead("file").over(ordered).isNull()
    value = F.concat(F.when(first, opening).otherwise(",\n"), "value", F.when(last, closing).otherwise(""))
    rows.select(value.alias("value"), LANDING_FILE).write.mode("overwrite").partitionBy(LANDING_FILE).text(landing)


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped records of the posts of all days: one message a post, its value an array of one."""
    announced = F.col("id").startswith("a").cast("int")
    return posts(spark, sf_dir).select(
        F.lit("host-1").cast("binary").alias("key"),
        F.concat(F.lit("["), F.col("post"), F.lit("]")).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("n") % 4 + 4 * announced).cast("int").alias("partition"),
        F.floor(F.col("n") / 4).cast("long").alias("offset"),
        F.col("day").cast("timestamp").alias("timestamp"))


# Hours of a day's batches (by a third of the post number); the batches that are delivered again, by day of the month and hour, and
# how their comments have moved meanwhile; posts withdrawn from them.
BATCH_HOURS = ("00", "08", "16")
REDELIVERED_DAY, REDELIVERED_BATCH, MOVED_HOURS, WITHDRAWN_EVERY = 10, 1, 36, 2


def batch_posts(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> DataFrame:
    """(landing_file, line): every post of all days on a line of one of its day's three batches; or those batches that come
    again, with later comment times and some posts left out."""
    n = F.substring("id", 2, 20).cast("long")
    feed = nested_feed(spark, sf_dir).withColumns({"n": n, "batch": F.floor(n / 3) % len(BATCH_HOURS), "day": utc_date("created_time")})
    if redelivered:
        feed = feed.filter((F.dayofmonth("day") == REDELIVERED_DAY) & (F.col("batch") == REDELIVERED_BATCH) & (F.col("n") % WITHDRAWN_EVERY != 0))
        moved = F.transform("comments.data", lambda c: c.withField("created_time", iso_text(
            F.to_timestamp_ntz(F.substring(c["created_time"], 1, 26)) + F.expr(f"INTERVAL {MOVED_HOURS} HOURS"))))
        feed = feed.withColumn("comments", F.when(F.col("comments").isNotNull(), F.struct(moved.alias("data"))))
    hour = F.element_at(F.array(*[F.lit(h) for h in BATCH_HOURS]), F.col("batch").cast("int") + 1)
    name = F.concat(F.lit("post_detail_"), F.date_format("day", "yyyy-MM-dd"), F.lit("_"), hour, F.lit("-00-00.json"))
    return feed.select(name.alias(LANDING_FILE), F.to_json(F.struct(*[F.col(c) for c in schemas.POST_FIELDS])).alias("line"))
