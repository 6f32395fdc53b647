"""Keyword product categoriser: ordered rules, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category rules in evaluation order (substring of the
# upper-case canonical description -> category), and the fallback category.
CATEGORY_RULES = (
    ("Iluminacion", ("LIGHT", "LAMP", "CANDLE", "LANTERN", "GLASS BALL")),
    ("Accesorios", ("BAG", "BASKET", "LUNCH")),
    ("Hogar", ("CLOCK", "FRAME", "BOX", "SEWING", "BUILDING BLOCK")),
    ("Decoracion", ("HEART", "ORNAMENT", "BIRD", "TREE")),
    ("Logistica", ("POSTAGE", "DOTCOM", "MANUAL")),
)
DEFAULT_CATEGORY = "General"


def categorize(name: Column, rules=CATEGORY_RULES, default: str = DEFAULT_CATEGORY) -> Column:
    """Chained CASE built from the rule list; NULL input falls to default."""
    expr = None
    for category, keywords in rules:
        cond = None
        for kw in keywords:
            hit = F.coalesce(name.contains(kw), F.lit(False))
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(default))
