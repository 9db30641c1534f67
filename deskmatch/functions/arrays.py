"""Array helpers with warehouse semantics: a null array reads as an empty one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(array: Column | str) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.coalesce(array, F.array())


def joined(array: Column | str, separator: str, field: str | None = None) -> Column:
    """Array (or one field of an array of structs) as text; an absent array gives the empty text."""
    array = F.col(array) if isinstance(array, str) else array
    texts = F.transform(array, lambda x: x[field]) if field else array
    return F.coalesce(F.array_join(texts, separator), F.lit(""))


def first(array: Column | str) -> Column:
    return F.get(F.col(array) if isinstance(array, str) else array, F.lit(0))


def distinct_present(array: Column | str) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.array_distinct(F.array_compact(or_empty(array)))


def has_items(array: Column | str) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.coalesce(F.size(array), F.lit(0)) > 0


def any_field_equals(array: Column | str, field: str, value: str) -> Column:
    """True when an element's field equals ``value``; null elements and a null array count as no match."""
    array = F.col(array) if isinstance(array, str) else array
    return F.coalesce(F.exists(array, lambda x: x[field].eqNullSafe(F.lit(value))), F.lit(False))


def max_field(array: Column | str, field: str) -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.array_max(F.transform(array, lambda x: x[field]))


def pick_ordered(
    array: Column,
    order: Callable[[Column], list[Column]],
    value: Callable[[Column], Column] = lambda x: x,
    keep: Callable[[Column], Column] | None = None,
    descending: bool = False,
) -> Column:
    """``value`` of the first element in order (nulls first ascending, last descending); null if none."""
    kept = F.filter(array, keep) if keep else array

    def entry(x, i):
        keys = [k.alias(f"k{n}") for n, k in enumerate(order(x))]
        # the position keeps equal keys in array order in both directions
        return F.struct(*keys, (-i if descending else i).alias("at"), value(x).alias("value"))

    return F.get(F.sort_array(F.transform(kept, entry), asc=not descending), F.lit(0))["value"]


def positions_equal(array: Column | str, value: Column) -> Column:
    """Membership as a flag: null when not found and the array holds a null."""
    return F.array_contains(or_empty(array), value)
