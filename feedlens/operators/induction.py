"""Lexicon induction (N1): word polarities learnt from labelled texts.

A word's polarity is the smoothed difference of the logarithms of its document frequencies among texts of the two
labels, counted over all labelled texts of the training part: ``ln((p + s) / (P + 2s)) - ln((n + s) / (N + 2s))`` for a word in p of P
positive and n of N negative texts. It is scaled so that ``cap`` is a polarity of 1, clipped, and stored in even thousandths, as the seed
lexicon's. Counting is one explode of distinct words and one aggregate, pre-aggregated by task; a word in
a third of all texts is one row a task before the shuffle. The result is a lexicon table
for ``sentiment.score_with_lexicon_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import lexicon as lx
from feedlens.functions.text import words


def induce_lexicon(texts: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "label",
                   min_texts: int = 3, smoothing: float = 1.0, cap: float = 3.0, min_milli: int = 100) -> DataFrame:
    """(word, pol_milli, kind) from texts joined to their labels (1 or 0; others and NULL teach nothing).

    Words of fewer than ``min_texts`` labelled texts, or of a polarity below ``min_milli`` thousandths, are left out. Without
    labels of both kinds nothing is learnt. Texts without words count among the texts. A text with
    several labels counts once for each; repeated rows count each time.
    """
    known = labels.filter(F.col(label_col).isin(0, 1)).select(key, F.col(label_col).alias("_label"))
    labelled = texts.select(key, F.col(text_col).alias("_text")).join(known, key)
    positive = F.col("_label") == 1
    sizes = labelled.agg(F.count_if(positive).alias("_p"), F.count_if(~positive).alias("_n"))
    counts = (labelled.select("_label", F.explode(F.array_distinct(words(F.col("_text")))).alias("word"))
              .groupBy("word").agg(F.count_if(positive).alias("p"), F.count_if(~positive).alias("n")))

    def share(count: str, size: str):
        total = sizes.select(size).scalar()
        return F.ln((F.col(count) + F.lit(smoothing)) / (total + F.lit(2 * smoothing)))

    both = (sizes.select(F.least("_p", "_n")).scalar() > 0)
    odds = share("p", "_p") - share("n", "_n")
    scaled = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), odds / F.lit(cap)))
    milli = (F.floor(scaled * F.lit(500.0) + F.lit(0.5)) * 2).cast("int")
    return (counts.filter((F.col("p") + F.col("n") >= min_texts) & both)
            .select("word", milli.alias("pol_milli"), F.lit(lx.POL).alias("kind"))
            .filter(F.abs("pol_milli") >= min_milli))


def with_modifiers(lexicon: DataFrame) -> DataFrame:
    """The learnt words with the seed lexicon's negators and boosters; a learnt word that is one of those stays a modifier only."""
    modifiers = [(w, 0, k) for w, _, k in lx.seed_lexicon() if k != lx.POL]
    fixed = lexicon.sparkSession.createDataFrame(modifiers, "word string, pol_milli int, kind string")
    return lexicon.join(fixed.select("word"), "word", "left_anti").unionByName(fixed)


def agreement(scored: DataFrame, scores: dict[str, str], label_col: str = "label", by: str = "lang") -> DataFrame:
    """Per ``by``: texts, and for each score column (out name -> column) how many are positive exactly where the label is 1."""
    return scored.groupBy(by).agg(F.count("*").alias("n_texts"), *[
        F.count_if((F.coalesce(F.col(c), F.lit(0.0)) > 0) == (F.col(label_col) == 1)).alias(out) for out, c in scores.items()])
