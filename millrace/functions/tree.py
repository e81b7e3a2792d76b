"""Whole VARIANT trees as arrays of nodes: one aggregate expression, a step for each level.

Objects give their fields in the order of their names, for a VARIANT keeps no other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

DICT_DEPTH = 12
NUMBER_DEPTH = 11
FEW_LEVELS = 3


def entries(v: Column) -> Column:
    """The fields of an object as a map; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def elements(v: Column) -> Column:
    """The elements of a list; null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_object(v: Column) -> Column:
    # No field is asked for, so none is copied.
    return F.try_variant_get(v, "$", "struct<>").isNotNull()


def is_list(v: Column) -> Column:
    return elements(v).isNotNull()


def levels(start: Column, below: Callable[[Column], Column], depth: int) -> Column:
    """``start`` (an array of nodes) and ``depth`` levels below it, in one array; each level is computed once."""
    last = lambda seen: F.element_at(seen, -1)
    step = lambda seen, _: F.concat(seen, F.array(F.flatten(F.transform(last(seen), below))))
    few = min(depth, FEW_LEVELS)
    # Most trees end within few levels; the others are followed on.
    more = lambda seen: F.when(F.size(last(seen)) > 0, F.aggregate(F.sequence(F.lit(few + 1), F.lit(depth)), seen, step)).otherwise(seen) if depth > few else seen
    return F.flatten(let(F.aggregate(F.sequence(F.lit(1), F.lit(few)), F.array(start), step), more))


def in_order(nodes: Column) -> Column:
    """Nodes by their place ``at``: a parent, then what is below it, then its next sibling."""
    return F.array_sort(nodes, lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0))


def nodes(v: Column, depth: int) -> Column:
    """struct(at, key, v) of the value and all values down to ``depth`` levels below it, in document order."""

    def node(at: Column, key: Column, x: Column) -> Column:
        return F.struct(at.alias("at"), key.alias("key"), x.alias("v"))

    def below(n: Column) -> Column:
        place = lambda i: F.concat(n["at"], F.array(i))
        fields = F.transform(F.map_entries(entries(n["v"])), lambda e, i: node(place(i), e["key"], e["value"]))
        return F.coalesce(fields, F.transform(elements(n["v"]), lambda e, i: node(place(i), F.lit(None).cast("string"), e)), F.array().cast("array<struct<at:array<int>,key:string,v:variant>>"))

    root = F.array(node(F.array().cast("array<int>"), F.lit(None).cast("string"), v))
    return in_order(levels(root, below, depth))


def dicts(v: Column, depth: int = DICT_DEPTH) -> Column:
    """All objects of a tree, outer ones before those within."""
    return F.filter(F.transform(nodes(v, depth), lambda n: n["v"]), is_object)


def numbers_of(found: Column, keys: list[str]) -> Column:
    """Distinct numbers (no booleans, no texts) of those nodes that stand under one of the keys."""
    kind = lambda x: F.schema_of_variant(x).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    # The type is only asked of values that are no containers.
    plain = F.filter(found, lambda n: n["key"].isin(keys) & entries(n["v"]).isNull() & elements(n["v"]).isNull())
    return F.array_distinct(F.transform(F.filter(plain, lambda n: F.coalesce(kind(n["v"]), F.lit(False))), lambda n: F.try_variant_get(n["v"], "$", "double")))


def numbers_under(v: Column, keys: list[str], depth: int = NUMBER_DEPTH) -> Column:
    """``numbers_of`` all nodes of a tree."""
    return numbers_of(nodes(v, depth), keys)


def first_list(v: Column, keys: list[str], depth: int) -> Column:
    """The objects of the first list that a chain of ``keys`` leads to and that holds an object.

    At an object the keys are tried in their order; objects under them are looked into, and
    a list ends the object's turn. A chain longer than ``depth`` is an error.
    """
    none = F.array().cast("array<struct<at:array<int>,v:variant,list:array<variant>>>")

    def node(at: Column, x: Column) -> Column:
        return F.struct(at.alias("at"), x.alias("v"), elements(x).alias("list"))

    def below(n: Column) -> Column:
        values = F.array(*[F.try_variant_get(n["v"], f"$.{k}", "variant") for k in keys])
        held = F.filter(F.transform(values, lambda x, i: node(F.concat(n["at"], F.array(i)), x)), lambda c: c["list"].isNotNull() | is_object(c["v"]))
        to_list = lambda cs: F.nullif(F.array_position(F.transform(cs, lambda c: c["list"].isNotNull()), True), F.lit(0)).cast("int")
        return F.when(n["list"].isNull(), let(held, lambda cs: F.coalesce(F.slice(cs, F.lit(1), to_list(cs)), cs))).otherwise(none)

    def read(walked: Column) -> Column:
        lists = F.transform(in_order(F.filter(walked, lambda n: n["list"].isNotNull())), lambda n: F.filter(n["list"], is_object))
        # Short chains don't pay for long ones: what is still open at the end is an error.
        open_ = F.exists(walked, lambda n: (F.size(n["at"]) == depth) & n["list"].isNull())
        error = F.raise_error(F.lit(f"lists lie deeper than {depth} keys")).cast("array<variant>")
        return let(F.get(F.filter(lists, lambda x: F.size(x) > 0), F.lit(0)), lambda got: F.when(got.isNull() & open_, error).otherwise(got))

    start = F.when(is_object(v), F.array(node(F.array().cast("array<int>"), v))).otherwise(none)
    return let(levels(start, below, depth), read)
