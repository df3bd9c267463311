"""Presentation values. The only place where a price becomes a DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed import as_col, floor_div

MISSING = "–"


def money(micros: Column | str) -> Column:
    return as_col(micros) / F.lit(1_000_000.0)


def contracts(units: Column | str) -> Column:
    return as_col(units) / F.lit(100.0)


def cents_label(micros: Column | str) -> Column:
    """Whole cents, halves rounded up."""
    m = as_col(micros)
    return F.when(m.isNull(), MISSING).otherwise(F.concat(floor_div(m + 5_000, 10_000).cast("string"), F.lit("¢")))


def bytes_label(n: Column | str) -> Column:
    size = as_col(n).cast("double")
    label = F.when(size.isNull(), MISSING)
    for power, unit in enumerate(("B", "KB", "MB", "GB", "TB")):
        scaled = size / float(1024**power)
        text = F.format_string("%.0f", scaled) if power == 0 else F.when(
            scaled >= 10, F.format_string("%.0f", scaled)
        ).otherwise(F.format_string("%.1f", scaled))
        text = F.concat(text, F.lit(f" {unit}"))
        label = label.when(scaled < 1024, text) if power < 4 else label.otherwise(text)
    return label


def duration_label(seconds: Column | str) -> Column:
    s = F.greatest(F.lit(0.0), F.floor(as_col(seconds) + 0.5).cast("double"))
    return (
        F.when(as_col(seconds).isNull(), MISSING)
        .when(s < 90, F.concat(s.cast("bigint").cast("string"), F.lit("s")))
        .when(s < 5_400, F.concat(F.floor(s / 60 + 0.5).cast("string"), F.lit(" min")))
        .when(s < 172_800, F.format_string("%.1f h", s / 3600))
        .otherwise(F.format_string("%.1f d", s / 86400))
    )


def ago_label(at_ms: Column | str, now_ms: Column | int) -> Column:
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    at = as_col(at_ms)
    return F.when(at.isNull(), MISSING).otherwise(F.concat(duration_label((now - at) / 1000), F.lit(" ago")))


def game_label(event: Column | str, first: Column | str, second: Column | str) -> Column:
    """The two outcomes, in the order in which the event's code spells them out, as ``A at B``; else the code, else the event.

    The code is what follows the date in the last part of the event.
    """
    e, a, b = as_col(event), F.coalesce(as_col(first), F.lit("")), F.coalesce(as_col(second), F.lit(""))
    code = F.regexp_extract(e, r"(?:-[0-9]{2}[A-Z]{3}[0-9]{2}|-|^)([^-]*)\z", 1)
    at_a, at_b = F.instr(code, a), F.instr(code, b)
    spelled = (a != "") & (b != "") & (F.length(code) == F.length(a) + F.length(b))
    return (
        F.when(spelled & (at_a == 1) & code.endswith(b), F.concat_ws(" at ", a, b))
        .when(spelled & (at_b == 1) & code.endswith(a), F.concat_ws(" at ", b, a))
        .when(code != "", code)
        .otherwise(e)
    )
