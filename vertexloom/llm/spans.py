"""Matches of patterns with their places in a text, in SQL functions alone."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it.

    Spark folds projections into each other, and what a lambda names is then made anew
    for each element; the lambda's own argument is not.
    """
    return F.transform(F.array(value), body)[0]


def spans_of(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: ``start`` and ``end`` in code points, and the ``value`` of a group."""
    none = F.array().cast(f"array<{SPAN}>")

    def places(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("found"))

        def step(a: Column, i: Column) -> Column:
            begin = a["at"] + F.char_length(F.get(parts["between"], i))
            end = begin + F.char_length(F.get(parts["whole"], i))
            value = F.get(parts["value"], i)
            found = F.struct(begin.alias("start"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(a["found"], F.array(found)).alias("found"))

        return F.aggregate(F.sequence(F.lit(0), F.size(parts["whole"]) - 1), start, step, lambda a: a["found"])

    def extracted(between: Column) -> Column:
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if group == 0:
            parts = let(whole, lambda w: F.struct(between.alias("between"), w.alias("whole"), w.alias("value")))
        else:
            value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
            parts = F.struct(between.alias("between"), whole.alias("whole"), value.alias("value"))
        return F.when(F.size(between) > 1, let(parts, places)).otherwise(none)

    # What a split leaves between the matches tells whether there are any, and where they stand.
    return let(F.split(text, pattern, -1), extracted)


def named(spans: Column, kind: str, rank: int) -> Column:
    """Spans with their kind, to be sorted by start and then by the rank of the kind."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def span_list(spans: Column, kinds: Iterable[str] | None = None) -> Column:
    """``kind:start:end`` of the spans (of some kinds) by start, then rank, comma-joined."""
    if kinds is not None:
        wanted = list(kinds)
        spans = F.filter(spans, lambda s: s["kind"].isin(wanted))
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")
