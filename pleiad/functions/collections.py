"""Collections inside an event: leading members, transposition, maps and multimaps, as higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once a row however often the body, or a function within it, names it."""
    return F.transform(F.array(value), body)[0]


def leading(collection: Column, k: int, *by: Callable[[Column], Column]) -> Column:
    """The first k members in descending order of the keys, all of them if there are fewer; a null collection stays null.

    Keys decide in turn, nulls last; members that tie in all of them keep their order.
    """
    keyed = F.transform(collection, lambda m, i: F.struct(*(key(m).alias(f"k{n}") for n, key in enumerate(by)), (-i).alias("place")))
    return F.transform(F.slice(F.sort_array(keyed, asc=False), 1, k), lambda x: F.get(collection, -x["place"]))


def multiplicity(collection: Column) -> Column:
    return F.coalesce(F.size(collection), F.lit(0))


def transposed(*fields: Column | str) -> Column:
    """One array a field to one array of structs, as split collections are stored; short arrays are filled with nulls."""
    return F.arrays_zip(*fields)


def _by_key(entries: Column) -> Column:
    """(key, place) of each entry, by key and in order within."""
    return F.sort_array(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"))))


def map_last_wins(entries: Column) -> Column:
    """A map of (key, value) structs in order; of equal keys the last one stands."""

    def built(e: Column, own: Column) -> Column:
        last = F.filter(own, lambda x, i: (i == F.size(own) - 1) | (F.get(own, i + 1)["key"] != x["key"]))
        return F.map_from_entries(F.transform(last, lambda x: F.struct(x["key"], F.get(e, x["place"])["value"])))

    return let(entries, lambda e: let(_by_key(e), lambda own: built(e, own)))


def multimap(entries: Column) -> Column:
    """A map of (key, value) structs in order: to each key all of its values."""

    def built(e: Column, own: Column, begin: Column) -> Column:
        end = lambda j: F.coalesce(F.get(begin, j + 1), F.size(own))
        values = lambda b, j: F.transform(F.slice(own, b + 1, end(j) - b), lambda x: F.get(e, x["place"])["value"])
        return F.map_from_entries(F.transform(begin, lambda b, j: F.struct(F.get(own, b)["key"], values(b, j))))

    def begins(own: Column) -> Column:
        places = F.transform(own, lambda _, i: i)
        return F.filter(places, lambda i: (i == 0) | (F.get(own, i - 1)["key"] != F.get(own, i)["key"]))

    return let(entries, lambda e: let(_by_key(e), lambda own: let(begins(own), lambda begin: built(e, own, begin))))


def total(values: Column) -> Column:
    """Sum of an array of numbers, nulls aside; zero for an empty one."""
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + F.coalesce(x.cast("double"), F.lit(0.0)))
