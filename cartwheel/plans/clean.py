"""Typed clean projection of lake rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LAKE_ITEMS, TEXT_DEFAULT_EMPTY

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def lenient_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that yields null for bad or out-of-range values instead of failing.

    Text that is no integer passes through decimal, so '1.0' becomes 1 as a
    non-ANSI cast would give, and long ids keep their value.
    """
    if isinstance(source, T.StringType) and isinstance(target, _INTEGRAL):
        return F.coalesce(col.try_cast(target), col.try_cast("decimal(38,10)").try_cast(target))
    if source == target:
        return col
    return col.try_cast(target)


def clean_items(lake: DataFrame) -> DataFrame:
    """16 typed columns; null text -> '' for eval_set, product_name, aisle,
    department; NaN -> null in double columns (S12: the reference's load
    turned pandas NaN into NULL)."""
    source = {f.name: f.dataType for f in lake.schema.fields}
    cols = []
    for field in LAKE_ITEMS.fields:
        name = field.name
        if name in source:
            c = lenient_cast(F.col(name), source[name], field.dataType)
        else:
            c = F.lit(None).cast(field.dataType)
        if name in TEXT_DEFAULT_EMPTY:
            c = F.coalesce(c, F.lit(""))
        if isinstance(field.dataType, T.DoubleType):
            c = F.nanvl(c, F.lit(None).cast("double"))
        cols.append(c.alias(name))
    return lake.select(*cols)


def product_lines(items: DataFrame) -> DataFrame:
    """Rows that carry a product (drops the empty-order placeholders)."""
    return items.filter(F.col("product_id").isNotNull())
