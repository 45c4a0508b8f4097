"""Feedback KPI reports (R1-R9): NPS, CSAT, category mix, sentiment trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import kpi
from feedlens.functions.dates import utc_date


def enrich(scored: DataFrame, score_col: str = "sentiment_score",
           time_col: str = "comment_created_time",
           csat_threshold: float = kpi.CSAT_DAILY_MIN) -> DataFrame:
    """Add comment_date, sentiment_category, sentiment_label and csat_flag once."""
    return scored.withColumns({
        "comment_date": utc_date(time_col),
        "sentiment_category": kpi.nps_category(score_col),
        "sentiment_label": kpi.sentiment_label(score_col),
        "csat_flag": kpi.csat_flag(score_col, csat_threshold),
    })


DAILY_COUNTS = ["total_comments", "promoters", "detractors", "csat_positive"]


def daily_counts(enriched: DataFrame, keys: tuple[str, ...] = ("comment_date",)) -> DataFrame:
    """Per comment_date (or ``keys``): the additive counts behind NPS and CSAT."""
    cat = F.col("sentiment_category")
    return (enriched.groupBy(*keys)
            .agg(F.count("*").alias("total_comments"),
                 F.count_if(cat == kpi.PROMOTER).alias("promoters"),
                 F.count_if(cat == kpi.DETRACTOR).alias("detractors"),
                 F.sum("csat_flag").cast("long").alias("csat_positive")))


def with_ratios(counts: DataFrame) -> DataFrame:
    """NPS % and CSAT % from the daily counts."""
    return counts.withColumns({
        "NPS": kpi.pct(F.col("promoters") - F.col("detractors"), "total_comments"),
        "CSAT": kpi.pct("csat_positive", "total_comments"),
    })


def daily_nps_csat(enriched: DataFrame) -> DataFrame:
    """Per comment_date: totals, promoters, detractors, CSAT-positive, NPS %, CSAT %."""
    return with_ratios(daily_counts(enriched))


def overall_csat(scored: DataFrame, score_col: str = "sentiment_score",
                 threshold: float = kpi.CSAT_OVERALL_MIN) -> DataFrame:
    """One row: share of comments at or above the threshold, in percent."""
    flag = kpi.csat_flag(score_col, threshold)
    return (scored.agg(F.count("*").alias("total_comments"),
                       F.count_if(flag == 1).alias("satisfied"))
            .withColumn("csat_score", kpi.pct("satisfied", "total_comments")))


def overall_nps(scored: DataFrame, score_col: str = "sentiment_score") -> DataFrame:
    """One row: category counts and NPS; NPS is NULL when there are no rows."""
    cat = kpi.nps_category(score_col)
    return (scored.agg(F.count("*").alias("total_comments"),
                       F.count_if(cat == kpi.PROMOTER).alias("promoters"),
                       F.count_if(cat == kpi.PASSIVE).alias("passives"),
                       F.count_if(cat == kpi.DETRACTOR).alias("detractors"))
            .withColumn("nps", kpi.pct(F.col("promoters") - F.col("detractors"), "total_comments")))


def category_distribution(scored: DataFrame, score_col: str = "sentiment_score") -> DataFrame:
    return (scored.groupBy(kpi.nps_category(score_col).alias("sentiment_category"))
            .agg(F.count("*").alias("count")))


def label_counts(enriched: DataFrame, keys: tuple[str, ...] = ("comment_date", "sentiment_label")) -> DataFrame:
    return enriched.groupBy(*keys).agg(F.count("*").alias("count"))


def daily_sentiment_trend(enriched: DataFrame) -> DataFrame:
    return label_counts(enriched).orderBy("comment_date", "sentiment_label")


def daily_net_sentiment(enriched: DataFrame) -> DataFrame:
    """Per day: positives - negatives, and that difference as % of all comments."""
    lab = F.col("sentiment_label")
    return (enriched.groupBy("comment_date")
            .agg(F.count("*").alias("total_comments"),
                 F.count_if(lab == kpi.POSITIVE).alias("positives"),
                 F.count_if(lab == kpi.NEGATIVE).alias("negatives"))
            .withColumns({
                "net_sentiment_score": F.col("positives") - F.col("negatives"),
                "net_sentiment_pct": kpi.pct(F.col("positives") - F.col("negatives"),
                                             "total_comments"),
            })
            .orderBy("comment_date"))
