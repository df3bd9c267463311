"""Tick grids: ``ARRAY<STRUCT<start, end, step>>`` in micro-dollars, ``end`` inclusive."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fixed import as_col, format_price, parse_price

BANDS = "array<struct<start:bigint,end:bigint,step:bigint>>"
BAND_TEXT = "array<struct<start:string,end:string,step:string>>"

# 64-bit FNV-1a offset basis and prime.
FNV_BASIS = np.uint64(0xCBF29CE484222325)
FNV_PRIME = np.uint64(0x100000001B3)


def parse_grid(text: Column | str) -> Column:
    """Wire JSON -> bands, NULL when it is not an array of bands with readable prices."""
    raw = F.from_json(as_col(text), BAND_TEXT)
    bands = F.transform(
        raw,
        lambda b: F.struct(
            parse_price(b["start"]).alias("start"),
            parse_price(b["end"]).alias("end"),
            parse_price(b["step"]).alias("step"),
        ),
    )
    broken = F.exists(
        bands, lambda b: b["start"].isNull() | b["end"].isNull() | b["step"].isNull()
    )
    return F.when(~broken, bands)


def band_contains(band: Column, price: Column) -> Column:
    return (price >= band["start"]) & (price <= band["end"])


def _offset(band: Column, price: Column) -> Column:
    """(price - start) mod step without forming the difference, so it cannot overflow."""
    step = band["step"]
    return F.pmod(F.pmod(price, step) - F.pmod(band["start"], step), step)


def band_on_grid(band: Column, price: Column) -> Column:
    return F.when(band["step"] > 0, band_contains(band, price) & (_offset(band, price) == 0)).otherwise(False)


def is_on_grid(bands: Column | str, price: Column | str) -> Column:
    """True when some band holds the price on a tick; an empty grid holds none."""
    p = as_col(price)
    return F.exists(as_col(bands), lambda b: band_on_grid(b, p))


def snap_to_grid(bands: Column | str, price: Column | str) -> Column:
    """Nearest tick as ``struct(price, verdict)``; ties go up; NULL for an empty grid."""
    grid, p = as_col(bands), as_col(price)

    def candidate(b: Column) -> Column:
        target = F.least(F.greatest(p, b["start"]), b["end"])
        over = _offset(b, target)
        up = target - over + b["step"]
        tick = F.when((over > 0) & (up <= b["end"]) & (b["step"] - over <= over), up).otherwise(target - over)
        return F.struct(F.abs(tick - p).alias("distance"), (-tick).alias("negated"))

    usable = F.filter(grid, lambda b: (b["step"] > 0) & (b["start"] <= b["end"]))
    best = -F.array_min(F.transform(usable, candidate))["negated"]
    verdict = (
        F.when(best == p, "exact").when(F.exists(grid, lambda b: band_contains(b, p)), "snapped").otherwise("clamped")
    )
    return F.when(best.isNotNull(), F.struct(best.alias("price"), verdict.alias("verdict")))


def grid_defect(bands: Column | str) -> Column:
    """First structural fault as ``struct(band, reason)``, NULL when the grid is sound."""
    grid = as_col(bands)

    def fault(b: Column, i: Column) -> Column:
        previous = F.try_element_at(grid, F.greatest(i, F.lit(1)))["start"]
        reason = (
            F.when(b["step"] <= 0, "non_positive_step")
            .when(b["start"] > b["end"], "inverted")
            .when((i > 0) & (b["start"] < previous), "unsorted")
        )
        return F.when(reason.isNotNull(), F.struct(i.alias("band"), reason.alias("reason")))

    return F.try_element_at(F.filter(F.transform(grid, fault), lambda f: f.isNotNull()), F.lit(1))


def render_grid(bands: Column | str) -> Column:
    """Readable form, e.g. ``[$0.010000..=$0.990000 step $0.010000]``."""
    parts = F.transform(
        as_col(bands),
        lambda b: F.concat(
            F.lit("$"), format_price(b["start"]), F.lit("..=$"), format_price(b["end"]),
            F.lit(" step $"), format_price(b["step"]),
        ),
    )
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def _fnv1a(texts: pd.Series) -> pd.Series:
    """Distinct texts of a batch, longest first, take one byte each per step; 64-bit products wrap."""
    codes, distinct = pd.factorize(texts)
    data = sorted(((text.encode("utf-8"), place) for place, text in enumerate(distinct)), key=lambda d: -len(d[0]))
    lengths = np.array([len(d) for d, _ in data], dtype=np.int64)
    octets = np.frombuffer(b"".join(d for d, _ in data), dtype=np.uint8).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    state = np.full(len(data), FNV_BASIS, dtype=np.uint64)
    for i in range(int(lengths.max(initial=0))):
        left = np.searchsorted(-lengths, -i)  # texts longer than i
        state[:left] = (state[:left] ^ octets[starts[:left] + i]) * FNV_PRIME
    found = np.empty(len(data) + 1, dtype=object)
    found[-1] = None  # the code of NULL
    for (_, place), h in zip(data, state.tolist()):
        found[place] = f"{h:016x}"
    return pd.Series(found[codes], index=texts.index)


def grid_hash(text: Column | str) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes, 16 hex digits."""
    return F.pandas_udf(_fnv1a, T.StringType())(as_col(text))
