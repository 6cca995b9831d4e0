"""Folds over arrays as Column expressions, in proportion to their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of a list that one step of a scan appends to.
SCAN_BLOCK = 256


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What step (state, item) -> (state, output) gives for every item in order: array<kind>.

    In blocks, so that appending an item copies a block and not all that came before.
    """
    none = F.array().cast(f"array<{kind}>")
    first = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("all"))

    def item(acc: Column, x: Column) -> Column:
        state, out = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], F.array(out.cast(kind))).alias("out"))

    def over(xs: Column) -> Column:
        def block(acc: Column, at: Column) -> Column:
            here = F.aggregate(F.slice(xs, at, SCAN_BLOCK), F.struct(acc["state"].alias("state"), none.alias("out")), item)
            return let(here, lambda h: F.struct(h["state"].alias("state"), F.concat(acc["all"], F.array(h["out"])).alias("all")))

        begins = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), F.lit(SCAN_BLOCK))).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.aggregate(begins, first, block, lambda acc: acc["all"]))

    return let(items, over)
