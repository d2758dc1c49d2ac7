"""Column expressions shared by the operators. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cap(c: str | Column, limit) -> Column:
    """``least`` that leaves NULL alone (plain ``least(NULL, 4)`` is 4)."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.least(c, F.lit(limit)))


def strip_quotes(c: str | Column) -> Column:
    """Remove every single quote wrapped around a code, on both ends."""
    return F.btrim(as_column(c).cast("string"), F.lit("'"))


def relabel(c: str | Column, labels: Mapping[str, str]) -> Column:
    """Look a code up in a small fixed mapping; codes outside it become NULL."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items())
    return F.try_element_at(F.create_map(*pairs), as_column(c))


def feature_name(column: str, level) -> str:
    """Name of the indicator column for one level of a categorical factor."""
    return f"{column}_{str(level).upper().replace(' ', '_').replace('-', '_')}"


def key_slot(key: str | Column, slots: int, salt: str = "") -> Column:
    """A number in ``0..slots-1`` that depends on the key (and salt) alone.

    The same key lands in the same slot whatever the partitioning, file layout or engine, which
    ``randomSplit`` does not promise.
    """
    text = as_column(key).cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (head % slots).cast("int")


def interval_index(c: str | Column, edges: Sequence[float]) -> Column:
    """Index of the first right-closed interval holding ``c``: 0 for ``c <= edges[0]``, and
    ``len(edges)`` above the last edge. NULL stays NULL."""
    c = as_column(c)
    if not edges:
        return F.when(c.isNotNull(), F.lit(0))
    expr = F.when(c <= F.lit(edges[0]), F.lit(0))
    for i, edge in enumerate(edges[1:], start=1):
        expr = expr.when(c <= F.lit(edge), F.lit(i))
    return expr.when(c.isNotNull(), F.lit(len(edges)))


def indicator(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it is false or unknown."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    value, weight = as_column(value), as_column(weight)
    return F.try_divide(F.sum(value * weight), F.sum(weight))
