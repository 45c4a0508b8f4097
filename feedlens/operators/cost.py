"""Usage cost report (R10): quantity and estimated cost per owner x day x SKU."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.cost import DEFAULT_RATE, RATE_RULES, rate


def usage_cost(usage: DataFrame, rules=RATE_RULES, default=DEFAULT_RATE,
               as_double: bool = True) -> DataFrame:
    """Owners present only; decimal sums (exact), newest day first.

    The rate depends only on the SKU (a grouping key), so it is applied after
    the partial/final aggregate instead of per input row.
    """
    owner = F.col("identity_metadata.owned_by")
    out = (usage.filter(owner.isNotNull())
           .groupBy(owner.alias("user_email"), "usage_date", "sku_name")
           .agg(F.sum("usage_quantity").alias("total_dbu_used"))
           .withColumn("estimated_cost_usd",
                       F.col("total_dbu_used") * rate("sku_name", rules, default)))
    if as_double:
        out = out.withColumns({c: F.col(c).cast("double")
                               for c in ("total_dbu_used", "estimated_cost_usd")})
    return out.orderBy(F.col("usage_date").desc(), "user_email", "sku_name")
