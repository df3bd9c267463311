"""Integrity reports over the channel tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fixed import reparse_scaled
from tidemark.operators.sequence import continuity_headline
from tidemark.schemas import DUALS


def channel_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per channel, and their total under ``TOTAL``."""
    named = [df.select(F.lit(name).alias("channel")) for name, df in tables.items()]
    rows = reduce(DataFrame.unionByName, named)
    return rows.rollup("channel").agg(F.count("*").alias("rows")).withColumn("channel", F.coalesce("channel", F.lit("TOTAL")))


def sessions_present(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Distinct sessions of the data with their declared convention, ``?`` when the record lacks one."""
    seen = rows.select("session_id").distinct()
    return seen.join(sessions.select("session_id", "pricing_convention"), "session_id", "left").select(
        "session_id", F.coalesce("pricing_convention", F.lit("?")).alias("pricing_convention")
    )


def _checks(duals: list[tuple[str, str, int]]) -> list[Column]:
    out = []
    for raw, parsed, digits in duals:
        expected = reparse_scaled(raw, digits)
        out.append(
            F.struct(
                F.lit(raw).alias("column"),
                F.col(raw).alias("raw"),
                F.col(parsed).alias("stored"),
                expected.alias("expected"),
            )
        )
    return out


def round_trip_mismatches(table: DataFrame, duals: list[tuple[str, str, int]], ids: list[str]) -> DataFrame:
    """Every stored integer that its raw text does not give when parsed by the second parser.

    Compared inside the row; only differences become rows.
    """
    wrong = F.filter(F.array(*_checks(duals)), lambda c: c["raw"].isNotNull() & ~c["stored"].eqNullSafe(c["expected"]))
    return table.select(*ids, F.explode(wrong).alias("m")).select(*ids, "m.*")


def round_trip_counts(table: DataFrame, duals: list[tuple[str, str, int]]) -> DataFrame:
    """Values checked and values that differ, per raw column, in one pass without multiplying the rows."""
    sums = []
    for i, (raw, parsed, digits) in enumerate(duals):
        bad = F.col(raw).isNotNull() & ~F.col(parsed).eqNullSafe(reparse_scaled(raw, digits))
        sums += [F.count(raw).alias(f"c{i}"), F.count_if(bad).alias(f"m{i}")]
    rows = F.array(
        *[F.struct(F.lit(raw).alias("column"), F.col(f"c{i}").alias("checked"), F.col(f"m{i}").alias("mismatches"))
          for i, (raw, _, _) in enumerate(duals)]
    )
    return table.agg(*sums).select(F.inline(rows))


def round_trip_report(tables: dict[str, DataFrame]) -> DataFrame:
    """``round_trip_counts`` of every channel that stores pairs."""
    parts = [
        round_trip_counts(df, DUALS[name]).select(F.lit(name).alias("channel"), "column", "checked", "mismatches")
        for name, df in tables.items()
        if name in DUALS
    ]
    return reduce(DataFrame.unionByName, parts)


def audit_verdict(round_trip: DataFrame, points: DataFrame, unreadable: DataFrame | None = None) -> DataFrame:
    """One row per check with its figures and PASS or FAIL, and the overall result."""
    checked = round_trip.agg(
        F.coalesce(F.sum("checked"), F.lit(0)).alias("n"), F.coalesce(F.sum("mismatches"), F.lit(0)).alias("bad")
    ).select(F.lit("round_trip").alias("check"), "n", "bad")
    continuity = continuity_headline(points).select(
        F.lit("continuity").alias("check"), F.col("messages").alias("n"), F.col("gaps").alias("bad")
    )
    parts = [checked, continuity]
    if unreadable is not None:
        parts.append(
            unreadable.agg(F.count("*").alias("n"), F.count_if(F.col("defect").isNotNull()).alias("bad")).select(
                F.lit("files").alias("check"), "n", "bad"
            )
        )
    checks = reduce(DataFrame.unionByName, parts)
    overall = checks.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select(F.lit("result").alias("check"), "n", "bad")
    return checks.unionByName(overall).withColumn("verdict", F.when(F.col("bad") == 0, "PASS").otherwise("FAIL"))
