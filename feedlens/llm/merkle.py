"""Operator 10: Merkle-tree fingerprints of documents, in DataFrame functions only.

The tree has four levels. A paragraph (line) is cut into blocks of ``BLOCK`` code points, the leaves; a
paragraph's hash covers its blocks'; consecutive paragraphs form a section that ends at a paragraph
whose hash says so (content-defined, so an edit moves no distant border); the root covers
the sections. Equal texts have equal roots; where roots differ, differing sections,
paragraphs and leaves locate the edit. The fingerprint string holds root, sections, paragraphs and leaves.

The next document by ascending id is found with one shuffle of the texts: ids are dealt into ranges by
approximate quantiles, a copy of each range's first row is sent to the range before, and
``lead`` runs inside the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points of a leaf, hex digits kept of a node's hash.
BLOCK = 48
DIGITS = 10
#: A paragraph whose hash starts with one of these digits ends its section (one in four).
LAST_DIGITS = "0123"
#: Ranges of ids for each shuffle partition, and ranges searched together.
RANGES_PER_PARTITION = 8
GROUP = 32


def node(children: Column) -> Column:
    return F.substring(F.md5(F.array_join(children, ",").cast("binary")), 1, DIGITS)


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, leaves) of a text; an empty text is one empty paragraph."""
    blocks = F.transform(F.split(text, "\n", -1), lambda line: F.transform(
        F.regexp_extract_all(line, F.lit(f"(?s).{{1,{BLOCK}}}"), 0),
        lambda block: F.substring(F.md5(block.cast("binary")), 1, DIGITS)))
    return F.transform(F.array(blocks), levels)[0]


def levels(blocks: Column) -> Column:
    """The tree above the leaves of each paragraph."""
    def sections(paragraphs: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(paragraphs)), lambda i: (i == F.size(paragraphs)) | F.lit(
            LAST_DIGITS).contains(F.substring(F.element_at(paragraphs, i), 1, 1)))
        return F.transform(F.array(ends), lambda e: F.transform(e, lambda end, k: node(F.slice(
            paragraphs, F.when(k == 0, 1).otherwise(F.get(e, k - 1) + 1),
            end - F.when(k == 0, 0).otherwise(F.get(e, k - 1))))))[0]

    def whole(paragraphs: Column) -> Column:
        return F.transform(F.array(sections(paragraphs)), lambda found: F.struct(
            F.md5(F.array_join(found, ",").cast("binary")).alias("root"), found.alias("sections"),
            paragraphs.alias("paragraphs"), F.flatten(blocks).alias("leaves")))[0]

    return F.transform(F.array(F.transform(blocks, node)), whole)[0]


def fingerprint(t: Column) -> Column:
    return F.concat_ws("/", t["root"], F.array_join(t["sections"], ","), F.array_join(t["paragraphs"], ","),
                       F.array_join(t["leaves"], ","))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots; else twice the distinct leaves in both, over the distinct leaves of each."""
    leaves = F.size(F.array_distinct(a["leaves"])) + F.size(F.array_distinct(b["leaves"]))
    shared = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    return (F.when(a["root"] == b["root"], F.lit(1.0)).when(leaves == 0, F.lit(0.0))
            .otherwise(F.lit(2.0) * shared / leaves))


def with_next(docs: DataFrame) -> DataFrame:
    """Each row with the next row's text, by ascending doc_id (nulls first) and text hash; the last row's next is the first.

    Columns doc_id and text. The borders are bounded in number by the shuffle partitions, not by the rows.
    """
    spark = docs.sparkSession
    n = GROUP * -(-RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")) // GROUP)
    borders = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    borders = sorted(set(borders))
    docs = docs.withColumns({"range": rank_among(borders, F.col("doc_id")), "tie": F.md5(F.col("text").cast("binary"))})
    order = Window.orderBy("range")
    guards = (docs.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("at"))  # a row for each range
              .select(F.col("at.doc_id").alias("g_id"), F.col("at.tie").alias("g_tie"), F.coalesce(
                  F.lag("range").over(order), F.last("range").over(order.rowsBetween(
                      Window.unboundedPreceding, Window.unboundedFollowing))).alias("before")))
    slots = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guard")),
                    F.struct(F.col("before").alias("range"), F.lit(True).alias("guard")))
    dealt = (docs.join(F.broadcast(guards), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("tie") == F.col("g_tie")), "left")
             .select("doc_id", "text", "tie", F.explode(F.filter(slots, lambda s: s["range"].isNotNull())).alias("slot"))
             .select("doc_id", "text", "tie", "slot.range", "slot.guard"))
    order = Window.partitionBy("range").orderBy("guard", F.asc_nulls_first("doc_id"), "tie")
    return dealt.withColumn("next_text", F.lead("text").over(order)).where(~F.col("guard")).select(
        "doc_id", "text", "next_text")


def rank_among(borders: list[int], value: Column) -> Column:
    """How many borders a value is not below (nulls: 0), looked up in a group of borders at a time."""
    if not borders:
        return F.lit(0)
    heads = F.array(*map(F.lit, borders[::GROUP]))
    group = F.size(F.filter(heads, lambda b: b <= value)) - 1
    inside = F.slice(F.array(*map(F.lit, borders)), group * GROUP + 1, GROUP)
    return F.when(value.isNull() | (value < borders[0]), 0).otherwise(
        group * GROUP + F.size(F.filter(inside, lambda b: b <= value)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; one row per row.

    The edited text has the last half (rounded down) of the code points replaced by as many from the start
    of the next document's text, or all of it if shorter. Null texts are empty. Rows of equal
    id follow each other by a hash of their texts; null ids come first. A lone document is its own next.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    pairs = with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), "text", F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)).alias("edited"), "next_text")
    trees = pairs.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                         F.transform(F.array("text", "edited", "next_text"), tree).alias("t"))
    own, edited, after = (F.col("t")[k] for k in range(3))
    return trees.select(
        F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", fingerprint(own).alias("fingerprint"),
        fingerprint(edited).alias("edited_fingerprint"), likeness(own, edited).alias("near_edited"),
        likeness(own, after).alias("near_next"))


def _sql_tree(text: str) -> str:
    digits = "', '".join(LAST_DIGITS)
    return f"""(select struct_pack(root := md5(array_to_string(s.sections, ',')), sections := s.sections,
                paragraphs := s.paragraphs, leaves := s.leaves) from (
        select paragraphs, leaves, list_transform(ends, lambda x, k: substr(md5(array_to_string(
                   paragraphs[(case when k = 1 then 0 else ends[k - 1] end) + 1:x], ',')), 1, {DIGITS})) as sections
        from (select paragraphs, leaves, list_filter(range(1, len(paragraphs) + 1), lambda i:
                     i = len(paragraphs) or substr(paragraphs[i], 1, 1) in ('{digits}')) as ends
              from (select list_transform(blocks, lambda b: substr(md5(array_to_string(b, ',')), 1, {DIGITS})) as paragraphs,
                           flatten(blocks) as leaves
                    from (select list_transform(string_split({text}, chr(10)), lambda line: list_transform(
                              regexp_extract_all(line, '(?s).{{1,{BLOCK}}}'), lambda b: substr(md5(b), 1, {DIGITS}))) as blocks)))) s)"""


def _sql_likeness(a: str, b: str) -> str:
    leaves = f"(len(list_distinct({a}.leaves)) + len(list_distinct({b}.leaves)))"
    return (f"case when {a}.root = {b}.root then 1.0::double when {leaves} = 0 then 0.0::double else "
            f"2.0::double * len(list_intersect({a}.leaves, {b}.leaves)) / {leaves} end")


def _sql_fingerprint(t: str) -> str:
    parts = (f"array_to_string({t}.{level}, ',')" for level in ("sections", "paragraphs", "leaves"))
    return f"concat_ws('/', {t}.root, {', '.join(parts)})"


SQL = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
     ordered as (select doc_id, text, lead(text) over o as after, first_value(text) over o as first_text
                 from docs window o as (order by doc_id nulls first, md5(text))),
     pairs as (select doc_id, length(text)::bigint as n_chars, text, coalesce(after, first_text) as next_text,
                      left(text, (length(text) - length(text) // 2)::bigint)
                      || left(coalesce(after, first_text), (length(text) // 2)::bigint) as edited from ordered),
     trees as (select doc_id, n_chars, sha256(edited) as edited_sha256, {_sql_tree('text')} as own,
                      {_sql_tree('edited')} as ed, {_sql_tree('next_text')} as nx from pairs)
select doc_id, n_chars, edited_sha256, {_sql_fingerprint('own')} as fingerprint,
       {_sql_fingerprint('ed')} as edited_fingerprint, {_sql_likeness('own', 'ed')} as near_edited,
       {_sql_likeness('own', 'nx')} as near_next
from trees
"""
