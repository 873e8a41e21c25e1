"""Small shared helpers for the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronokey.functions.time import epoch_us


def order_value(df: DataFrame, col: str) -> Column:
    """Numeric form of an order column (epoch micros for timestamps)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return epoch_us(col)
    return F.col(col)


def as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def sorted_by(values: Column, *order: Column) -> Column:
    """``collect_list`` of ``values`` sorted by ``order`` (ties keep no order).

    collect_list is a partial (map-side) aggregate; the sort happens once per
    group on the merged buffer.
    """
    pairs = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], values.alias("v"))))
    return F.transform(pairs, lambda p: p["v"])
