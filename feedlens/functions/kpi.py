"""Score classifiers used by the KPI reports (NULL-safe by construction)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category thresholds and the two CSAT thresholds.
PROMOTER_MIN = 0.5
PASSIVE_MIN = 0.1
CSAT_DAILY_MIN = 0.4
CSAT_OVERALL_MIN = 0.1

PROMOTER, PASSIVE, DETRACTOR = "Promoter", "Passive", "Detractor"
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nps_category(score="sentiment_score") -> Column:
    """>= 0.5 Promoter, [0.1, 0.5) Passive, anything else (NULL too) Detractor."""
    s = _c(score)
    return (F.when(s >= PROMOTER_MIN, PROMOTER)
            .when((s >= PASSIVE_MIN) & (s < PROMOTER_MIN), PASSIVE)
            .otherwise(DETRACTOR))


def sentiment_label(score="sentiment_score") -> Column:
    """> 0 Positive, < 0 Negative, else (0 or NULL) Neutral."""
    s = _c(score)
    return F.when(s > 0, POSITIVE).when(s < 0, NEGATIVE).otherwise(NEUTRAL)


def csat_flag(score="sentiment_score", threshold: float = CSAT_DAILY_MIN) -> Column:
    """1 when the score reaches the threshold, else 0 (NULL gives 0)."""
    return F.when(_c(score) >= threshold, 1).otherwise(0)


def pct(numerator, denominator) -> Column:
    """numerator / denominator * 100 as double; NULL when the denominator is 0."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double")) * 100
