"""feedlens: customer-feedback analytics on Apache Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built on the public PySpark API. Nothing here collects data to the
driver; actions are left to the caller. The names below are the entry
points a pipeline needs; the modules hold the rest.
"""

__version__ = "0.1.0"

from feedlens.functions.kpi import csat_flag, nps_category, sentiment_label  # noqa: E402
from feedlens.functions.rules import Rule  # noqa: E402
from feedlens.operators.audit import current as audit_current  # noqa: E402
from feedlens.operators.audit import not_yet_done  # noqa: E402
from feedlens.operators.cost import usage_cost  # noqa: E402
from feedlens.operators.flatten import flatten_posts  # noqa: E402
from feedlens.operators.planning import (  # noqa: E402
    aggregation_plan, datasets_to_validate, dependency_readiness, pending_rules)
from feedlens.operators.quality import error_rows, promote_valid, rule_outcomes  # noqa: E402
from feedlens.operators.reports import (  # noqa: E402
    category_distribution, daily_counts, daily_net_sentiment, daily_nps_csat,
    daily_sentiment_trend, enrich, overall_csat, overall_nps)
from feedlens.operators.sentiment import (  # noqa: E402
    lexicon_scorer, pandas_scorer, score, score_with_lexicon_table)
from feedlens.operators.upsert import upsert_errors  # noqa: E402
from feedlens.session import build_session  # noqa: E402

__all__ = [
    "Rule", "aggregation_plan", "audit_current", "build_session", "category_distribution",
    "csat_flag", "daily_counts", "daily_net_sentiment", "daily_nps_csat", "daily_sentiment_trend",
    "datasets_to_validate", "dependency_readiness", "enrich", "error_rows", "flatten_posts",
    "lexicon_scorer", "not_yet_done", "nps_category", "overall_csat", "overall_nps",
    "pandas_scorer", "pending_rules", "promote_valid", "rule_outcomes", "score",
    "score_with_lexicon_table", "sentiment_label", "upsert_errors", "usage_cost",
]
