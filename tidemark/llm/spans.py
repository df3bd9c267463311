"""Matches of a pattern in texts with their places, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches, in code points, end exclusive: lengths of what lies between, added up.

    Matches are added up in groups of about the square root of their number, then the groups, so that no list grows by one for each match.
    """
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("begins"))

    def step(held, item):
        begin = held["at"] + F.length(item["gap"])
        end = begin + F.length(item["value"])
        return F.struct(end.alias("at"), F.array_append(held["spans"], F.struct(begin.alias("start"), end.alias("end"), item["value"].alias("value"))).alias("spans"))

    def moved(group, begin):
        return F.transform(group["spans"], lambda s: F.struct((s["start"] + begin).alias("start"), (s["end"] + begin).alias("end"), s["value"].alias("value")))

    def joined(groups):
        begins = F.aggregate(groups, first, lambda held, g: F.struct((held["at"] + g["at"]).alias("at"), F.array_append(held["begins"], held["at"]).alias("begins")), lambda held: held["begins"])
        return F.flatten(F.zip_with(groups, begins, moved))

    def grouped(zipped):
        width = F.ceil(F.sqrt(F.size(zipped))).cast("int")
        groups = F.sequence(F.lit(1), F.size(zipped), width)
        return F.transform(groups, lambda at: F.aggregate(F.slice(zipped, at, width), start, step))

    def places(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        zipped = F.zip_with(gaps, found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
        return F.when(F.size(found) > 0, bound(bound(zipped, grouped), joined)).otherwise(none)

    return bound(matches(text, pattern), places)
