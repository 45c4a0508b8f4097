"""Multi-line JSON files of any size, read by many tasks.

A file is cut at every closing brace (``lineSep``), so Spark splits it like lines and nothing larger than the text between
two such braces is held. Whether a piece begins inside a string, and at which depth, follows from what lies before it:

* a piece is inside a string if an odd number of unescaped quotes lies before it in its file;
* its depth is the number of braces open there, those inside strings not counted.

Both are prefix sums over a file in two levels: within a block (a section of so many pieces of a byte range, as read by one task), and over
the blocks' totals, a few numbers each. A post is an object that no other holds, whatever arrays are around it. The pieces of one block are put together
where they lie; only what crosses a block's border is shuffled once more, and belongs to the block that it starts in.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.session import SMALL_ROWS

#: Columns of a piece: its text, file, the start of its block, the file's size.
PIECE = ("value", "source_file", "block_start", "file_size")
FILE, BLOCK = ["source_file"], ["source_file", "block_start", "section"]
#: A power of two of pieces in a section of a byte range, and bytes of pieces that a task puts together: memory bounds only.
SECTION_BITS, TASK_BYTES = 13, 16 << 20


def piece_columns() -> list[Column]:
    """The columns of pieces as read by the text source with ``lineSep`` "}"."""
    return [F.col("value"), F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("block_start"), F.col("_metadata.file_size").alias("file_size")]


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.format("text").option("lineSep", "}").option("recursiveFileLookup", "true")
    return reader.load(path).select(*piece_columns())


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char)))


def _before(total: DataFrame, value: str, out: str) -> DataFrame:
    """The sum of a block value over the blocks of the file that lie before, as a frame to be joined to the blocks' pieces."""
    w = Window.partitionBy(*FILE).orderBy("block_start", "section").rowsBetween(Window.unboundedPreceding, -1)
    return total.select(*BLOCK, F.coalesce(F.sum(value).over(w), F.lit(0)).alias(out))


def split_elements(pieces: DataFrame, cached: list[DataFrame] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each element of each file: ``source_file``, the columns ``keep`` (the same on all pieces of a file), and its text
    ``_raw`` (NULL for a JSON null).

    Elements are posts, and what else stands between them in arrays (numbers, texts). Where a file isn't JSON to its end (cut off, a brace or
    quote too many), the text after its last whole post is kept as one element a byte range. Empty files have no
    elements; a file read twice in ``pieces`` is not provided for. Texts inside compressed files can't be split.
    The blocks' totals, the pieces, dealt by block, and what each block makes of them are used more than once and therefore persisted; ``cached``
    gets them, for the caller to release. The totals are computed at once, for the number of tasks that the pieces ask for.
    """
    # without escapes, so that each quote left is a string's end
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    at = F.monotonically_increasing_id()
    raw = (pieces.select(*PIECE, *keep, at.alias("at"), plain.alias("plain"))
           .withColumns({"section": F.shiftright("at", SECTION_BITS), "quotes": _count(F.col("plain"), '"')}))

    # whether the file's last piece ended in a brace shows in its size (a byte order mark counts 3 bytes)
    totals = raw.groupBy(*BLOCK).agg(F.sum("quotes").alias("quotes"), F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes"),
                                     F.max("at").alias("last"), F.max("file_size").alias("size")).persist()
    n_blocks, n_bytes = totals.agg(F.count("*"), F.coalesce(F.sum(F.col("bytes") + F.col("n")), F.lit(0))).first()

    def to_blocks(frame: DataFrame) -> DataFrame:
        """A row a block, broadcast unless there are very many of them."""
        return F.broadcast(frame) if n_blocks <= SMALL_ROWS else frame

    of_file = Window.partitionBy(*FILE)
    rest = F.col("size") - F.sum("bytes").over(of_file) - F.sum("n").over(of_file)
    open_end = (F.col("last") == F.max_by("last", F.struct("block_start", "section")).over(of_file)) & rest.isin(-1, 2)
    starts = (totals.withColumn("open_end", F.when(open_end, F.col("last")))
              .join(_before(totals, "quotes", "quotes_before"), BLOCK).select(*BLOCK, "quotes_before", "open_end"))

    here = Window.partitionBy(*BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)

    def within(value: str) -> Column:
        return F.coalesce(F.sum(value).over(here), F.lit(0))

    # braces outside strings if the piece begins outside one; if it begins inside, they are all the others
    braces = _count(F.col("plain"), "{")
    outside = F.when((braces == 0) | (F.col("quotes") == 0), braces).otherwise(_count(F.regexp_replace("plain", '"[^"]*("|$)', ""), "{"))
    braced = F.col("open_end").isNull() | (F.col("at") != F.col("open_end"))
    dealt = (raw.select(*BLOCK, *keep, "at", "value", "quotes", braces.alias("braces"), outside.alias("outside"))
             .repartition(max(1, math.ceil(n_bytes / TASK_BYTES)), *BLOCK))
    known = (dealt.join(to_blocks(starts), BLOCK).withColumn("quoted", (F.col("quotes_before") + within("quotes")) % 2)
             .withColumns({"opens": F.when(F.col("quoted") == 1, F.col("braces") - F.col("outside")).otherwise(F.col("outside")), "braced": braced,
                           "ends": ((F.col("quoted") + F.col("quotes")) % 2 == 0) & braced})
             .select(*BLOCK, *keep, "at", "value", "opens", "ends", (F.col("opens") - F.col("ends").cast("int")).alias("delta"), "braced").persist())
    depths = _before(known.groupBy(*BLOCK).agg(F.sum("delta").alias("delta")), "delta", "depth_before")
    deep = known.join(to_blocks(depths), BLOCK).withColumn("depth", F.col("depth_before") + within("delta"))
    closed = F.col("ends") & (F.col("depth") + F.col("delta") == 0) & (F.col("depth") + F.col("opens") > 0)
    grouped = deep.withColumn("closed", closed.cast("int")).withColumn("own_post", within("closed"))

    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value", "braced"))),
                                    lambda p: F.concat(p["value"], F.when(p["braced"], "}").otherwise(""))), "")
    parts = (grouped.groupBy(*BLOCK, *keep, "own_post")
             .agg(text.alias("text"), F.max("closed").alias("closed"), F.min_by("depth", "at").alias("depth")).persist())
    if cached is not None:
        cached += [totals, known, parts]
    named = ["source_file", *keep]
    whole = parts.filter("depth = 0 AND closed = 1").select(*named, "text", "closed")
    # a post across borders is joined; a text that ends nowhere stays apart by byte range
    numbers = _before(parts.groupBy(*BLOCK).agg(F.sum("closed").alias("closed")), "closed", "posts_before")
    border = (parts.filter("NOT (depth = 0 AND closed = 1)").join(to_blocks(numbers), BLOCK)
              .withColumn("post", F.col("posts_before") + F.col("own_post"))
              .withColumn("closes", F.max("closed").over(Window.partitionBy("source_file", "post"))))
    apart = F.when(F.col("closes") == 0, F.col("block_start"))
    joined = (border.groupBy(*named, "post", "closes", apart.alias("apart"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_start", "section", "text"))), lambda p: p["text"]), "").alias("text"))
              .select(*named, "text", F.col("closes").alias("closed")))
    return whole.unionByName(joined).select(*named, F.explode(_elements(F.col("text"), F.col("closed") == 1)).alias("_raw"))


def _elements(text: Column, closed: Column) -> Column:
    """What stands before a post, and the post; or the elements of a text without one."""
    brace, quote = F.instr(text, "{"), F.instr(text, '"')
    quoted_first = (quote > 0) & (quote < brace)
    lead = F.when(quoted_first, F.regexp_extract(text, r'(?s)^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)', 1)).when(
        brace > 0, F.substr(text, F.lit(1), brace - 1)).otherwise(text)
    own = F.substr(text, F.length(lead) + 1)
    return (F.when(closed, F.concat(_between(lead), F.array(own)))
            .when(F.length(own) > 0, F.array(text))
            .otherwise(_between(text)))


def _between(text: Column) -> Column:
    """The elements of what stands between posts: array brackets and commas around them dropped."""
    inner = F.regexp_replace(F.regexp_replace(text, r"^[\s,\[\]]+", ""), r"[\s,\[\]]+$", "")
    parsed = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>")
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(text)))
