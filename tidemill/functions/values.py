"""Numbers, codes and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column, scale: int = 2) -> Column:
    return c.cast(f"decimal(18,{scale})")


def money_sum(c: Column, scale: int = 2) -> Column:
    """Sum in decimals, so the result does not depend on the order of rows."""
    return F.sum(money(c, scale)).cast("double")


def money_avg(c: Column, scale: int = 2) -> Column:
    return F.try_divide(money_sum(c, scale), F.count(c).cast("double"))


def mapped(c: Column, mapping: Mapping[str, object], default: object = None, keep: bool = False) -> Column:
    """Dictionary replacement; unmapped values give ``default`` or, with ``keep``, stay."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, c)
    if keep:
        return F.coalesce(found, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def tier(c: Column, floors: Sequence[tuple[float, str]], lowest: str, missing: str | None = None) -> Column:
    """Name of the first floor (highest first) that the value reaches."""
    ranked = sorted(floors, key=lambda f: f[0], reverse=True)
    expr = F.when(c >= ranked[0][0], ranked[0][1])
    for floor, name in ranked[1:]:
        expr = expr.when(c >= floor, name)
    if missing is not None:
        expr = expr.when(c.isNull(), missing)
    return expr.otherwise(lowest)


def spending_tier(total: Column) -> Column:
    # Spend floors and their tier names.
    return tier(total, [(1000, "enterprise"), (500, "growth"), (200, "scale")], "starter", "unknown")


def revenue_class(revenue: Column) -> Column:
    # Revenue bounds and their class names.
    return F.when(revenue < 100, "low").when(revenue < 1000, "medium").otherwise("high")


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def contact_key(email: Column, phone: Column) -> Column:
    """``email|phone``; null unless both are present."""
    return F.concat(email, F.lit("|"), phone)


def prefixed_id(source: Column, record_id: Column) -> Column:
    """``source::id``; null where the id is null (``concat_ws`` would skip it)."""
    return F.concat(source, F.lit("::"), record_id.cast("string"))


def present_share(columns: Sequence[str]) -> Column:
    """Share of the columns that are not null in the row."""
    present = [F.col(c).isNotNull().cast("double") for c in columns]
    return reduce(add, present) / F.lit(float(len(columns)))


def share_pct(condition: Column) -> Column:
    """Percentage of rows where the condition holds; null without rows."""
    hits = F.sum(F.when(condition, 1).otherwise(0)).cast("double")
    return F.try_divide(hits, F.count(F.lit(1)).cast("double")) * 100.0


def joined_sorted(values: Column, separator: str = "|") -> Column:
    return F.array_join(F.array_sort(values), separator)
