"""How filters overlap: what each removes in every order they could run in, from counts of failure patterns alone.

Documents are reduced to cells: part, set of failed filters, two label flags, number of documents. A cell folds along
each order of the filters (``aggregate`` inside ``transform``) into one weighted struct per step; the arrays of a
part's cells are added element by element. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
# Filters have orders beyond count soon: all orders of six are 720, of seven 5,040.
MOST_FILTERS = 6


def failures(text: Column) -> list[Column]:
    """Failure conditions A to D of one text: short, repetitive, shouting, marked with symbols."""
    words = F.array_remove(F.split(text, SPACES), "")
    n_words = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        n_words < 100,
        100 * F.size(F.array_distinct(words)) < 80 * n_words,
        100 * upper.cast("long") > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Number of documents per (part, mask, good, toxic), ``mask`` having bit i set where filter i of ABCDE fails.

    Texts are compared by SHA-256, the first of equal ones being that of the smallest doc_id. Copies are counted before they meet,
    so a text with a third of all rows is a few rows per task. Rows of one text that share its smallest doc_id
    all pass E, as do rows without a doc_id.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    mask = reduce(Column.__add__, [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(F.col("text")))])
    marked = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("print"), mask.alias("mask"))
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    joined = marked.join(flags, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    cell = ["part", "mask", "good", "toxic"]
    per_doc = joined.groupBy("doc_id", "print", *cell).agg(F.count("*").alias("n"))
    # At most parts x 16 x 4 x 2 rows per text.
    per_text = per_doc.groupBy("print", F.col("doc_id").isNotNull().alias("named"), *cell).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    smallest = F.min("first.doc_id").over(Window.partitionBy("print"))
    told = per_text.withColumn("smallest", smallest)
    passing = F.when(~F.col("named"), F.col("n")).when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    split = told.select(*cell, F.explode(F.array(F.struct(F.lit(0).alias("copy"), passing.alias("n")), F.struct(F.lit(16).alias("copy"), (F.col("n") - passing).alias("n")))).alias("s"))
    split = split.where("s.n > 0").select("part", (F.col("mask") + F.col("s.copy")).alias("mask"), "good", "toxic", "s.n")
    return split.groupBy(*cell).agg(F.sum("n").alias("n"))


def interaction_audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, order of ``filters`` and step: what the step's filter keeps, removes and repeats.

    ``cells`` (part, mask, good, toxic, n): see ``failure_cells``; at most 2 ** filters x 4 rows per part. Columns: part,
    filter_order, step (from 1), kept (after the step), removed, redundant (fail, but were gone), unique_fails (fail this filter only),
    good_lost and toxic_lost (removed, with the flag) and shapley (the filter's removals added over all
    orders). Every order and step of a part that has a cell is there, with zeros; no cells give no rows.
    """
    if not 0 < len(set(filters)) == len(filters) <= MOST_FILTERS:
        raise ValueError(f"one to {MOST_FILTERS} different filters can be tried in all orders")
    size = len(filters)
    orders = list(permutations(range(size)))
    order_array = F.lit([list(order) for order in orders])
    shape = "array<struct<" + ",".join(f"{c}:bigint" for c in FIGURES) + ">>"

    def weighted(when: Column, name: str) -> Column:
        return F.when(when, F.col("n")).otherwise(F.lit(0).cast("long")).alias(name)

    def fold(order: Column) -> Column:
        def step(held: Column, place: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1), place)
            fails, alive = F.col("mask").bitwiseAND(bit) != 0, held["alive"]
            lost = alive & fails
            figures = (alive & ~fails, lost, ~alive & fails, F.col("mask") == bit, lost & F.col("good"), lost & F.col("toxic"))
            here = F.struct(*[weighted(when, name) for when, name in zip(figures, FIGURES)])
            return F.struct((alive & ~fails).alias("alive"), F.concat(held["steps"], F.array(here)).alias("steps"))

        start = F.struct(F.lit(True).alias("alive"), F.array().cast(shape).alias("steps"))
        return F.aggregate(order, start, step, lambda held: held["steps"])

    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in FIGURES]))

    folded = cells.select("part", F.flatten(F.transform(order_array, fold)).alias("steps"))
    zero = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in FIGURES]), size * len(orders))
    merged = folded.groupBy("part").agg(F.aggregate(F.collect_list("steps"), zero, add).alias("steps"))
    acting = F.flatten(order_array)

    def share(place: Column) -> Column:
        own = F.zip_with("steps", acting, lambda figures, at: F.when(at == place, figures["removed"]).otherwise(F.lit(0).cast("long")))
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, more: total + more)

    shared = merged.withColumn("shares", F.transform(F.lit(list(range(size))), share))
    rows = shared.select("part", "shares", F.posexplode("steps").alias("at", "figures"))
    names = F.lit(["".join(filters[i] for i in order) for order in orders])
    return rows.select(
        "part",
        F.get(names, F.floor(F.col("at") / size).cast("int")).alias("filter_order"),
        (F.col("at") % size + 1).alias("step"),
        "figures.*",
        F.get("shares", F.get(acting, F.col("at"))).alias("shapley"),
    )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, quality, toxic); more columns are ignored.

    A null text is empty, a null lang is the part ''. A document is good or toxic if any of its label rows says so; without one it is
    neither. Repeated rows count each. Empty documents give no rows, empty labels no losses.
    """
    return interaction_audit(failure_cells(docs, labels))
