"""Lexicon sentiment scoring (N1) and the pluggable scorer hook.

Two strategies compute the same score:

* ``lexicon_scorer`` (default): the lexicon is a bounded, fixed table, so it is
  embedded once in the plan as two literal maps and every row is scored where
  it lies -- no explode, no shuffle, no join back to the rows.
* ``score_with_lexicon_table``: for a user's lexicon held in a table of any size. Words are
  exploded, joined to the lexicon (a plain join, so that Spark broadcasts a small one by its
  own size limit and splits hot words otherwise), pre-aggregated per row key and joined back.

Score of a text = sum of the (possibly modified) polarities of its matched
words / (1000 * number of matched words); 0.0 when no word matches; NULL text
gives NULL. A negator before a polar word gives ``-(p div 2)``; a booster gives
``clip(p + p div 2, -1000, 1000)``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import lexicon as lx
from feedlens.functions.text import with_previous, words

Scorer = Callable[[Column], Column]

LEXICON_SCHEMA = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("pol_milli", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
])


def lexicon_frame(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else lx.seed_lexicon(), LEXICON_SCHEMA)


def _modified(p: Column, mod: Column) -> Column:
    half = (p / F.lit(2)).cast("int")  # exact: polarities are even
    return (F.when(p.isNull(), F.lit(None).cast("int"))
            .when(mod == lx.NEG, -half)
            .when(mod == lx.BOOST, F.greatest(F.lit(-1000), F.least(F.lit(1000), p + half)))
            .otherwise(p))


def _score_from(total: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(total.cast("double") / (F.lit(1000.0) * n))


class LexiconScorer:
    """Row-local scorer for a bounded lexicon, embedded as literal maps.

    ``apply`` (used by ``score``) stages the work as columns so that lambda
    bodies only touch column references and literals (an expression used
    inside a lambda is re-evaluated per element): tokens, then the polar
    words present (hash-based intersection; no polar word means 0.0 at
    once), then a position scan against those few words, with modifier
    lookups only at matched positions. ``__call__`` is the plain
    ``Column -> Column`` form: one left-to-right fold over the tokens.
    """

    def __init__(self, rows=None):
        rows = rows if rows is not None else lx.seed_lexicon()
        pol = [(w, int(p)) for w, p, k in rows if k == lx.POL]
        mod = [(w, k) for w, _, k in rows if k != lx.POL]
        self.polar_words = F.array(*[F.lit(w) for w, _ in pol]) if pol else F.array().cast("array<string>")
        self.pol_map = F.create_map(*[F.lit(x) for wp in pol for x in wp])
        self.mod_map = F.create_map(*[F.lit(x) for wk in mod for x in wk])

    def apply(self, df: DataFrame, text_col: str, out: str, words_col: str | None = None) -> DataFrame:
        wc = words_col or "__feedlens_words"
        pc, ic, vc = "__feedlens_polar", "__feedlens_idx", "__feedlens_vals"
        ws, present, idx, vals = F.col(wc), F.col(pc), F.col(ic), F.col(vc)
        text = F.col(text_col)
        tok = df if wc in df.columns else df.withColumn(wc, words(text))
        # arrays_overlap is a cheap hash probe; the intersection (hashing the
        # text's own words, the smaller side) runs only for texts that have one
        staged = (tok.withColumn(pc, F.when(F.arrays_overlap(ws, self.polar_words),
                                            F.array_intersect(self.polar_words, ws)))
                  .withColumn(ic, F.when(present.isNotNull(), F.filter(
                      F.sequence(F.lit(1), F.size(ws)),
                      lambda i: F.array_contains(present, F.element_at(ws, i)))))
                  .withColumn(vc, F.transform(idx, lambda i: _modified(
                      F.try_element_at(self.pol_map, F.element_at(ws, i)),
                      F.when(i > 1, F.try_element_at(self.mod_map, F.element_at(ws, i - 1)))))))
        total = F.aggregate(vals, F.lit(0).cast("long"), lambda a, v: a + v)
        scored = staged.withColumn(out, F.when(text.isNull(), F.lit(None).cast("double"))
                                   .when(present.isNull(), F.lit(0.0))
                                   .otherwise(_score_from(total, F.size(vals))))
        scored = scored.drop(pc, ic, vc)
        return scored if words_col else scored.drop(wc)

    def __call__(self, text: Column) -> Column:
        zero = F.struct(F.lit(None).cast("string").alias("prev"),
                        F.lit(0).cast("long").alias("s"), F.lit(0).alias("n"))

        def step(acc, w):
            v = _modified(F.try_element_at(self.pol_map, w), F.try_element_at(self.mod_map, acc["prev"]))
            return F.struct(w.alias("prev"),
                            (acc["s"] + F.coalesce(v, F.lit(0))).cast("long").alias("s"),
                            (acc["n"] + F.when(v.isNull(), 0).otherwise(1)).alias("n"))

        folded = F.aggregate(words(text), zero, step, lambda acc: _score_from(acc["s"], acc["n"]))
        return F.when(text.isNull(), F.lit(None).cast("double")).otherwise(folded)


def lexicon_scorer(rows=None) -> LexiconScorer:
    return LexiconScorer(rows)


def pandas_scorer(fn: Callable[[pd.Series], pd.Series]) -> Scorer:
    """Wrap a vectorised ``pd.Series -> pd.Series`` scorer (Arrow batches).

    Marked non-deterministic so a filter on the score does not evaluate the
    Python function a second time.
    """
    udf = F.pandas_udf(fn, T.DoubleType()).asNondeterministic()
    return lambda text: udf(text)


def score(df: DataFrame, text_col: str = "comment_message", out: str = "sentiment_score",
          scorer: Scorer | None = None, words_col: str | None = None,
          partitions: int | None = None) -> DataFrame:
    """Add ``out`` = score of ``text_col``; default scorer is the seed lexicon.

    For a lexicon scorer the text is tokenised once into a column of its own
    (kept under ``words_col`` when given, so callers can reuse the tokens).
    ``partitions`` deals the rows out anew before scoring, for a caller whose input has fewer
    partitions than the cluster has cores; by default rows are scored where they lie.
    """
    scorer = scorer or lexicon_scorer()
    if partitions:
        df = df.repartition(partitions)
    if isinstance(scorer, LexiconScorer):
        return scorer.apply(df, text_col, out, words_col)
    return df.withColumn(out, scorer(F.col(text_col)))


def score_with_lexicon_table(df: DataFrame, key_cols: list[str], lexicon: DataFrame,
                             text_col: str = "comment_message", out: str = "sentiment_score") -> DataFrame:
    """Join-based scoring with a lexicon table. ``key_cols`` must identify a row."""
    pol = lexicon.filter(F.col("kind") == lx.POL).select(F.col("word").alias("w"), "pol_milli")
    mod = lexicon.filter(F.col("kind") != lx.POL).select(F.col("word").alias("prev"),
                                                         F.col("kind").alias("mod"))
    toks = (df.select(*key_cols, words(F.col(text_col)).alias("_ws"))
            .select(*key_cols, F.inline(with_previous(F.col("_ws"))))
            .join(pol, "w").join(mod, "prev", "left")
            .select(*key_cols, _modified(F.col("pol_milli"), F.col("mod")).alias("v")))
    per_row = toks.groupBy(*key_cols).agg(F.sum("v").alias("_s"), F.count("*").alias("_n"))
    return (df.join(per_row, key_cols, "left")
            .withColumn(out, F.when(F.col(text_col).isNull(), F.lit(None).cast("double"))
                        .otherwise(_score_from(F.coalesce("_s", F.lit(0)), F.coalesce("_n", F.lit(0)))))
            .drop("_s", "_n"))
