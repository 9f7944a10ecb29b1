"""Label columns used by the questions (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names by order_dow (0 = Sunday) and the fallback label.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
UNKNOWN_DAY = "Unknown"

# Order-number buckets, (low, high, label); anything else,
# including 0 and null, is the last label.
ORDER_NUMBER_BUCKETS = [
    (1, 1, "01. First Order"),
    (2, 5, "02. Order 2-5"),
    (6, 10, "03. Order 6-10"),
    (11, 20, "04. Order 11-20"),
    (21, 50, "05. Order 21-50"),
]
ORDER_NUMBER_OTHER = "06. Order 51+"

# Days-since-prior-order buckets in display order.  Null is the
# first label, exactly 0 the second, closed ranges next; the rest (fractions
# outside the ranges, negatives, > 30) fall to the last label.
DAYS_NULL_LABEL = "Unknown / First Order"
DAYS_ZERO_LABEL = "Same Day"
DAYS_BUCKETS = [
    (1, 3, "1-3 Days"),
    (4, 7, "4-7 Days"),
    (8, 14, "8-14 Days"),
    (15, 30, "15-30 Days"),
]
DAYS_OTHER = "30+ Days"
DAYS_LABEL_ORDER = [DAYS_NULL_LABEL, DAYS_ZERO_LABEL] + [b[2] for b in DAYS_BUCKETS] + [DAYS_OTHER]

# Product-line types of the reorder split.
REORDERED_LABEL = "Reordered"
FIRST_TIME_LABEL = "First-time"


def day_name(dow: Column) -> Column:
    expr = None
    for i, name in enumerate(DAY_NAMES):
        expr = (F.when(dow == i, F.lit(name)) if expr is None
                else expr.when(dow == i, F.lit(name)))
    return expr.otherwise(F.lit(UNKNOWN_DAY))


def order_number_bucket(n: Column) -> Column:
    expr = None
    for lo, hi, label in ORDER_NUMBER_BUCKETS:
        cond = (n == lo) if lo == hi else n.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(ORDER_NUMBER_OTHER))


def days_since_bucket(d: Column) -> Column:
    expr = F.when(d.isNull(), F.lit(DAYS_NULL_LABEL)).when(d == 0, F.lit(DAYS_ZERO_LABEL))
    for lo, hi, label in DAYS_BUCKETS:
        expr = expr.when(d.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(DAYS_OTHER))


def days_bucket_position(label: Column) -> Column:
    """1-based position of a label in display order, 0 if absent."""
    return F.array_position(F.array(*[F.lit(x) for x in DAYS_LABEL_ORDER]), label)


def product_line_type(reordered: Column) -> Column:
    return F.when(F.coalesce(reordered, F.lit(0)) == 1, F.lit(REORDERED_LABEL)) \
            .otherwise(F.lit(FIRST_TIME_LABEL))
