"""Row validity rules of the silver layer: one ``CASE WHEN`` chain per entity.

The flags never drop rows; only gold filters on them. The first branch (key is NULL) is
kept so the rule is also right where it is used without the key filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expressions import is_blank


def _first_match(*failing: Column) -> Column:
    chain = None
    for cond in failing:
        chain = F.when(cond, F.lit(False)) if chain is None else chain.when(cond, F.lit(False))
    return chain.otherwise(F.lit(True))


def customer_is_valid() -> Column:
    """Valid iff key, email and name are present and not blank. Tier and region unchecked."""
    return _first_match(F.col("customer_id").isNull(), is_blank("email"), is_blank("name"))


def order_is_valid() -> Column:
    """Valid iff key, customer, date present and the (unrounded) amount is >= 0. Status unchecked."""
    amt = F.col("total_amount")
    return _first_match(
        F.col("order_id").isNull(),
        F.col("customer_id").isNull(),
        F.col("order_date").isNull(),
        amt.isNull() | (amt < 0),
    )


def line_item_is_valid() -> Column:
    """Valid iff key and order present, product not blank, quantity > 0 and price >= 0."""
    q, p = F.col("quantity"), F.col("unit_price")
    return _first_match(
        F.col("line_item_id").isNull(),
        F.col("order_id").isNull(),
        is_blank("product_name"),
        q.isNull() | (q <= 0),
        p.isNull() | (p < 0),
    )
