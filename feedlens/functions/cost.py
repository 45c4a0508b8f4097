"""Usage price rules (R10): the first matching SKU pattern sets the rate."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (LIKE pattern, USD per unit) in priority order, then the default rate.
RATE_RULES = [
    ("%ALL_PURPOSE_COMPUTE%", Decimal("0.15")),
    ("%SERVERLESS_SQL%", Decimal("0.22")),
]
DEFAULT_RATE = Decimal("0.10")


def rate(sku, rules=RATE_RULES, default=DEFAULT_RATE) -> Column:
    s = F.col(sku) if isinstance(sku, str) else sku
    expr = None
    for pattern, r in rules:
        lit = F.lit(r).cast("decimal(6,4)")
        expr = F.when(s.like(pattern), lit) if expr is None else expr.when(s.like(pattern), lit)
    dflt = F.lit(default).cast("decimal(6,4)")
    return dflt if expr is None else expr.otherwise(dflt)
