"""Predicate closure (O4, F5): slots reachable from a root through ``is_a``.

Pointer doubling: every slot knows the slot 2^k steps above it and whether the root lies on
the way there. One join with the same table doubles the step, so a hierarchy of any depth
takes log2(depth) jobs instead of one per level. Each state is written to the session's
checkpoint folder, so plans stay flat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import py_strip
from ..session import materialize

PREFIX = "biolink:"


def predicate_name(name: Column) -> Column:
    """``biolink:`` + name with spaces as underscores."""
    return F.concat(F.lit(PREFIX), F.translate(name, " ", "_"))


def collapse_ws(desc: Column) -> Column:
    """whitespace runs to one space, ends stripped; null -> ''."""
    return F.coalesce(
        py_strip(F.regexp_replace(desc, "(?U)[\\s\\x1c-\\x1f]+", " ")), F.lit("")
    )


def descendants(slots: DataFrame, root: str = "related to") -> DataFrame:
    """Names reachable from ``root`` (root included). Raises KeyError when the root is not a
    slot.

    Slots whose way is settled (the root was met, or nothing lies further up) are not joined
    again: a parent with very many children, such as the root, costs no step. Cycles end
    when steps are longer than the table."""
    named = slots.where(F.col("name").isNotNull())
    up = F.when(F.col("name") != root, F.col("is_a"))
    # from each name the slot 2^k above; hit: the root is the name itself or on the way
    state = materialize(named.select(
        "name", up.alias("up"), ((F.col("name") == root) | F.coalesce(up == root, F.lit(False))).alias("hit")
    ).distinct(), "closure")
    counts = state.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("name") == root).alias("roots")).first()
    if not counts.roots:
        raise KeyError(root)
    step = 1
    while step <= counts.n:
        open_ = state.where(~F.col("hit") & F.col("up").isNotNull())
        if open_.isEmpty():
            break
        above = state.select(F.col("name").alias("up"), F.col("up").alias("higher"), F.col("hit").alias("met"))
        moved = open_.join(above, "up", "left").select(
            "name", F.col("higher").alias("up"), F.coalesce("met", F.lit(False)).alias("hit"))
        settled = state.where(F.col("hit") | F.col("up").isNull())
        state = materialize(settled.unionByName(moved).distinct(), "closure")
        step *= 2
    return state.where("hit").select("name").distinct()


def predicate_closure(slots: DataFrame, root: str = "related to") -> DataFrame:
    """O4 + F5: predicate id and collapsed description for every descendant."""
    names = descendants(slots, root)
    return (
        slots.join(names, "name", "left_semi")
        .select(predicate_name(F.col("name")).alias("predicate"),
                collapse_ws(F.col("description")).alias("description"))
    )


def sorted_predicates(slots: DataFrame, root: str = "related to") -> DataFrame:
    """The closure in the order of its slots' names, as the predicates file has it."""
    names = descendants(slots, root)
    return slots.join(names, "name", "left_semi").orderBy("name").select(
        predicate_name(F.col("name")).alias("predicate"), collapse_ws(F.col("description")).alias("description"))
