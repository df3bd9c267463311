"""Running values over an ordered key, computed in bounded pieces.

A plain window over ``partitionBy(key)`` puts a whole key in one task, which
fails when one market or stream holds a third of all rows. Here each key is cut
along its own order axis into chunks. A window runs inside each (key, chunk);
one row of totals per chunk is carried forward to the next ones; and the two are
combined. The big side is shuffled once, by (key, chunk): the carry join needs
the same partitioning as the window. Results equal the plain window exactly.

Keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixed import floor_div

# Five minutes, the file-roll period of a capture: one stream's traffic in that time fits a task.
TIME_CHUNK_MS = 300_000
TIME_CHUNK_NS = TIME_CHUNK_MS * 1_000_000
SEQ_CHUNK = 1 << 18

CHUNK = "_chunk"


@dataclass(frozen=True)
class Run:
    """A running value: ``max``, ``min``, ``sum``, ``count`` (of true rows) or ``last`` (last non-NULL)."""

    kind: str
    value: Column

    def _source(self) -> Column:
        return F.when(self.value, 1).otherwise(0).cast("bigint") if self.kind == "count" else self.value

    def over(self, window) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        name = "sum" if self.kind == "count" else self.kind
        return getattr(F, name)(self._source()).over(window)

    def total(self, order: Sequence[str], backward: bool) -> Column:
        if self.kind == "last":
            tagged = F.when(
                self.value.isNotNull(), F.struct(*[F.col(o) for o in order], self.value.alias("_value"))
            )
            return (F.min if backward else F.max)(tagged)["_value"]
        name = "sum" if self.kind == "count" else self.kind
        return getattr(F, name)(self._source())

    def carry(self, total: Column, window) -> Column:
        if self.kind == "last":
            return F.last(total, ignorenulls=True).over(window)
        name = "sum" if self.kind == "count" else self.kind
        return getattr(F, name)(total).over(window)

    def combine(self, local: Column, carried: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(local, carried)
        if self.kind in ("sum", "count"):
            return F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        return (F.greatest if self.kind == "max" else F.least)(local, carried)


def time_chunk(column: str, width: int) -> Column:
    return floor_div(column, width)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    runs: dict[str, Run],
    inclusive: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Add running values over the rows before each row (and the row itself when ``inclusive``).

    ``chunk`` must not decrease along ``order``. ``backward`` runs from the end,
    so that ``last`` gives the next value.
    """

    def sort(name: str) -> Column:
        return F.col(name).desc() if backward else F.col(name).asc()

    staged = df.withColumn(CHUNK, chunk)
    inside = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*[sort(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    across = Window.partitionBy(*keys).orderBy(sort(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    local = staged.select("*", *[r.over(inside).alias(f"_local_{n}") for n, r in runs.items()])
    totals = staged.groupBy(*keys, CHUNK).agg(*[r.total(order, backward).alias(f"_total_{n}") for n, r in runs.items()])
    carried = totals.select(
        *keys, CHUNK, *[r.carry(F.col(f"_total_{n}"), across).alias(f"_carry_{n}") for n, r in runs.items()]
    )
    return local.join(carried, [*keys, CHUNK]).select(
        *[F.col(c) for c in df.columns],
        *[r.combine(F.col(f"_local_{n}"), F.col(f"_carry_{n}")).alias(n) for n, r in runs.items()],
    )


def running_high_water(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    value: str,
    reset: Column,
    name: str = "high_water",
) -> DataFrame:
    """Highest earlier ``value`` since the last ``reset`` row, which itself restarts the mark.

    Inside a chunk the pair (resets so far, value) is maximised, so that a later
    reset always wins; across chunks the same is done with one row per chunk.
    """
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    staged = (
        df.withColumn(CHUNK, chunk)
        .withColumn("_resets", F.sum(F.when(reset, 1).otherwise(0)).over(upto))
        .withColumn("_mark", F.struct("_resets", F.col(value).alias("_value")))
    )
    local = staged.withColumn("_local", F.max("_mark").over(before))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = (
        staged.groupBy(*keys, CHUNK)
        .agg(F.max("_mark").alias("_tail"))
        .withColumn(
            "_restarts",
            F.sum(F.when(F.col("_tail._resets") > 0, 1).otherwise(0)).over(
                across.rowsBetween(Window.unboundedPreceding, 0)
            ),
        )
        .withColumn(
            "_carry",
            F.max(F.struct("_restarts", F.col("_tail._value").alias("_value"))).over(
                across.rowsBetween(Window.unboundedPreceding, -1)
            )["_value"],
        )
        .select(*keys, CHUNK, "_carry")
    )
    mark = F.when(F.col("_local._resets") > 0, F.col("_local._value")).otherwise(
        F.greatest(F.col("_local._value"), F.col("_carry"))
    )
    return local.join(carried, [*keys, CHUNK]).select(*[F.col(c) for c in df.columns], mark.alias(name))


def as_of(
    events: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    at: str,
    payload: Sequence[str],
    tie: Sequence[str] = (),
    width: int = TIME_CHUNK_MS,
    name: str = "fact",
) -> DataFrame:
    """The newest fact at or before each event, as a struct column (NULL when there is none).

    The payload travels as one struct, so a fact whose fields are all NULL still
    replaces the one before it.
    """
    body = F.struct(*[F.col(p) for p in payload])
    events_part = events.withColumn("_is_event", F.lit(1))
    for p in tie:
        if p not in events.columns:
            raise ValueError(f"tie-break column {p!r} is missing from the events")
    facts_part = facts.select(
        *keys,
        at,
        *[c for c in tie if c in facts.columns and c not in (*keys, at)],
        F.lit(0).alias("_is_event"),
        body.alias("_fact"),
    )
    both = events_part.unionByName(facts_part, allowMissingColumns=True)
    ran = running(
        both,
        keys,
        [at, "_is_event", *tie],
        time_chunk(at, width),
        {name: Run("last", F.col("_fact"))},
    )
    return ran.where("_is_event = 1").drop("_is_event", "_fact")
