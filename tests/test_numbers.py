"""Golden values for fixed-point numbers, tickers, grids and labels."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clocks, display, fixed, grid, tickers

def spelled(micros, places, zeros=0):
    """A decimal text of ``micros`` with at least ``places`` decimals and ``zeros`` more before and after."""
    sign, (whole, rest) = "-" if micros < 0 else "", divmod(abs(micros), 1_000_000)
    digits = f"{rest:06d}".rstrip("0").ljust(places, "0") + "0" * zeros
    return f"{sign}{'0' * zeros}{whole}" + (f".{digits}" if digits else "")


AMOUNTS = [0, 3, 70, 4_000, 310_000, 250_001, 999_999, 7_000_000, 31_400_000, -1, -870_000, 2**63 - 1, -(2**63)]
PRICES = {spelled(v, places, zeros): v for v in AMOUNTS for places, zeros in ((0, 0), (2, 0), (6, 0), (6, 5))} | {"-0": 0, "-0.00": 0}
# A shape rule each, on texts of our own.
REJECTS = {
    "": "empty", "-": "missing_integer_digits", ".25": "missing_integer_digits", "-.7": "missing_integer_digits", "8.": "missing_fraction_digits",
    "3.1.4": "multiple_decimal_points", "zwei": "invalid_char", "0b11": "invalid_char", "2e3": "invalid_char", "+7.2": "invalid_char",
    "\t4.4": "invalid_char", "4.4 ": "invalid_char", "3,5": "invalid_char", "nan": "invalid_char", "-inf": "invalid_char", "٣.٠": "invalid_char",
    "-+2": "invalid_char", "6.0\r": "invalid_char", "2.0000003": "excess_precision", "7" * 25: "overflow", spelled(2**63, 6): "overflow",
    "8" * 33 + ".0000001": "overflow",
}


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_parse_accepts(spark):
    df = spark.createDataFrame([(k, v) for k, v in PRICES.items()], "raw string, want bigint")
    rows = df.select("raw", "want", fixed.parse_price("raw").alias("got"), fixed.reparse_scaled("raw", 6).alias("again"),
                     fixed.parse_failure("raw", 6).alias("why")).collect()
    for r in rows:
        assert (r.got, r.again, r.why) == (r.want, r.want, None), r


def test_parse_rejects(spark):
    df = spark.createDataFrame(list(REJECTS.items()), "raw string, want string")
    for r in df.select("*", fixed.parse_price("raw").alias("got"), fixed.reparse_scaled("raw", 6).alias("again"),
                       fixed.parse_failure("raw", 6).alias("why")).collect():
        assert (r.got, r.again, r.why) == (None, None, r.want), r


def test_quantities(spark):
    df = spark.createDataFrame([("-12.50", -1250), ("38", 3800), ("38.0", 3800), ("38.00000", 3800), ("6.283", None)],
                               "raw string, want bigint")
    for r in df.select("*", fixed.parse_quantity("raw").alias("got")).collect():
        assert r.got == r.want


def test_format_round_trip(spark):
    values = list(range(-3_000_000, 3_000_001, 8_191)) + [-(2**63), 2**63 - 1, -1, 0, 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    bad = df.where(~fixed.parse_price(fixed.format_price("v")).eqNullSafe(F.col("v")))
    assert bad.count() == 0
    assert one(spark, fixed.format_notional(F.lit(123_456)), fixed.format_scaled(F.lit(-7), 2)) == ("0.00123456", "-0.07")


def test_price_arithmetic(spark):
    assert one(spark, fixed.complement(F.lit(310_000)), fixed.checked_complement(F.lit(-(2**63) + 9)),
               fixed.complement(F.lit(-(2**63) + 9))) == (690_000, None, 2**63 - 1)
    pairs = [(4, 7, 5), (-4, -7, -6), (300_000, 330_000, 315_000), (2**63 - 1, 2**63 - 1, 2**63 - 1), (-(2**63), 2**63 - 1, -1)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint, want bigint")
    assert all(r.want == r.got for r in df.select("want", fixed.midpoint("a", "b").alias("got")).collect())
    assert one(spark, fixed.checked_add(F.lit(2**63 - 1), F.lit(1))) == (None,)


def test_notional(spark):
    halves = {100 * n + 50: n + 1 for n in range(4)} | {-(100 * n + 50): -(n + 1) for n in range(4)}  # away from zero
    cases = halves | {n: round(n / 100) for n in range(-937, 938, 61) if n % 100 != 50}
    df = spark.createDataFrame(list(cases.items()), "n bigint, want bigint")
    assert all(r.want == r.got for r in df.select("want", fixed.notional_micros("n").alias("got")).collect())
    assert one(spark, fixed.notional(F.lit(310_000), F.lit(700)), fixed.notional(F.lit(2**63 - 1), F.lit(2**63 - 1))) == (
        217_000_000, None)


def test_tickers(spark):
    good = ["KXRAIN-25APR01-OSLO", "SNOW-25APR-TN0.7", "WIND-25APR09-B12.5", "kxr-a"]
    bad = {"": "empty", "..": "unsafe_as_path", ".hidden": "unsafe_as_path", "A/B": "invalid_char", "A B": "invalid_char",
           "A\nB": "invalid_char", "A\n": "invalid_char", "A" * 129: "too_long", "É": "invalid_char"}
    df = spark.createDataFrame([(g, None) for g in good] + list(bad.items()), "t string, why string")
    for r in df.select("*", tickers.ticker_failure("t").alias("got"), tickers.normalize_ticker("t").alias("n"),
                       tickers.strict_ticker("t").alias("s")).collect():
        assert r.got == r.why
        assert r.n == (r.t.upper() if r.why is None else None)
        assert r.s == (r.t if r.why is None and r.t == r.t.upper() else None)


def test_ticker_parts(spark):
    df = spark.createDataFrame([("KXRAIN-25APR01OSLROM-ROM", "KXRAIN-25APR01OSLROM", "2025-04-01", "ROM"),
                                ("A-25PRM08X-Y", "A-25PRM08X", None, "Y"), ("A-25APR31-Y", "A-25APR31", None, "Y"),
                                ("PLAIN", "", None, "PLAIN")], "t string, e string, d string, o string")
    for r in df.select("*", tickers.event_ticker("t").alias("e2"), tickers.event_date("t").cast("string").alias("d2"),
                       tickers.outcome("t").alias("o2")).collect():
        assert (r.e2, r.d2, r.o2) == (r.e, r.d, r.o)


def test_conventions_and_directions(spark):
    assert one(spark, tickers.yes_price(F.lit("no"), F.lit(690_000), F.lit("no_leg")),
               tickers.yes_price(F.lit("no"), F.lit(690_000), F.lit("yes_leg")),
               tickers.yes_price(F.lit("yes"), F.lit(690_000), F.lit("no_leg"))) == (310_000, 690_000, 690_000)
    with pytest.raises(Exception, match="unknown pricing convention"):
        one(spark, tickers.yes_price(F.lit("no"), F.col("id"), F.lit("other")))
    null = F.lit(None).cast("string")
    assert one(spark, tickers.trade_direction(F.lit("yes"), F.lit("ask"), null),
               tickers.trade_direction(null, F.lit("ask"), F.lit("yes")),
               tickers.trade_direction(null, F.lit("odd"), F.lit("yes")),
               tickers.trade_direction(null, null, F.lit("no"))) == ("yes", "no", None, "no")
    assert one(spark, tickers.recovery_for_error(F.lit(25)), tickers.recovery_for_error(F.lit(6)),
               tickers.is_overflow_error(F.lit(25)), tickers.opposite_side(F.lit("yes"))) == ("resubscribe", None, True, "no")


BANDS = '[{"start":"0.0020","end":"0.2000","step":"0.0020"},{"start":"0.2000","end":"0.7000","step":"0.0250"},' \
        '{"start":"0.7000","end":"0.9980","step":"0.0020"}]'


def test_grid(spark):
    cases = [("0.0020", True, 2_000, "exact"), ("0.3250", True, 325_000, "exact"), ("0.3301", False, 325_000, "snapped"),
             ("0.3399", False, 350_000, "snapped"), ("0.3375", False, 350_000, "snapped"), ("3.0000", False, 998_000, "clamped"),
             ("0.0010", False, 2_000, "clamped"), ("0.8040", True, 804_000, "exact"), ("0.9990", False, 998_000, "clamped")]
    df = spark.createDataFrame(cases, "p string, valid boolean, snap bigint, verdict string").withColumn(
        "g", grid.parse_grid(F.lit(BANDS)))
    for r in df.select("*", grid.is_on_grid("g", fixed.parse_price("p")).alias("v"),
                       grid.snap_to_grid("g", fixed.parse_price("p")).alias("s")).collect():
        assert (r.v, r.s.price, r.s.verdict) == (r.valid, r.snap, r.verdict), r
    empty = grid.parse_grid(F.lit("[]"))
    assert one(spark, grid.is_on_grid(empty, F.lit(1)), grid.snap_to_grid(empty, F.lit(1))) == (False, None)


def test_grid_structure(spark):
    def bands(*rows):
        return F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(n) for v, n in zip(r, ("start", "end", "step"))]) for r in rows])

    got = one(spark, grid.grid_defect(bands((100, 900, 0))), grid.grid_defect(bands((900, 100, 10))),
              grid.grid_defect(bands((500, 900, 10), (100, 400, 10))), grid.grid_defect(bands((1, 5, 1), (5, 9, 1))),
              grid.render_grid(bands((10_000, 990_000, 10_000))))
    assert got == ((0, "non_positive_step"), (0, "inverted"), (1, "unsorted"), None,
                   "[$0.010000..=$0.990000 step $0.010000]")
    assert one(spark, grid.parse_grid(F.lit('[{"start":"x","end":"1","step":"1"}]')), grid.parse_grid(F.lit("no"))) == (None, None)


def fnv(data):
    h = 0xCBF29CE484222325
    for b in data:
        h = ((h ^ b) * 0x100000001B3) % 2**64
    return f"{h:016x}"


def test_grid_hash(spark):
    for text in ("", "abc", BANDS, "é–x"):
        assert one(spark, grid.grid_hash(F.lit(text)))[0] == fnv(text.encode())


def test_grid_hash_of_many_and_long_texts(spark):
    import time

    texts = [None if i % 7 == 0 else "é" * (i % 5) + str(i % 50) for i in range(500)] + ["", "x" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("h", grid.grid_hash("t"))
    started = time.monotonic()
    got = {r.i: r.h for r in df.collect()}
    assert time.monotonic() - started < 60  # a substring per byte took the square of the length
    assert got == {i: None if t is None else fnv(t.encode()) for i, t in enumerate(texts)}


def test_labels(spark):
    assert one(spark, display.cents_label(F.lit(435_000)), display.cents_label(F.lit(None).cast("bigint")),
               display.bytes_label(F.lit(512)), display.bytes_label(F.lit(1536)), display.bytes_label(F.lit(20 * 1024**2)),
               display.duration_label(F.lit(89)), display.duration_label(F.lit(3600)), display.duration_label(F.lit(7200)),
               display.duration_label(F.lit(200_000))) == ("44¢", "–", "512 B", "1.5 KB", "20 MB", "89s", "60 min", "2.0 h", "2.3 d")
    assert one(spark, display.game_label(F.lit("KX-26OCT08TBDAL"), F.lit("TB"), F.lit("DAL")),
               display.game_label(F.lit("KX-26OCT08DALTB"), F.lit("TB"), F.lit("DAL")),
               display.game_label(F.lit("KX-26OCT08"), F.lit("TB"), F.lit("DAL")),
               display.ago_label(F.lit(1_000), 31_000)) == ("TB at DAL", "DAL at TB", "KX-26OCT08", "30s ago")


def test_clocks(spark):
    late = 1_793_577_540_000_000_000  # 2026-11-01T23:59:00Z
    assert one(spark, clocks.partition_date(F.lit(late)).cast("string"),
               clocks.partition_date(F.lit(late + 120_000_000_000)).cast("string")) == ("2026-11-01", "2026-11-02")
    assert one(spark, clocks.skew_class(F.lit(-5_000)), clocks.skew_class(F.lit(30_000)), clocks.skew_class(F.lit(4_999)),
               clocks.feed_latency_ms(F.lit(5_000_999_999), F.lit(1))) == ("warn", "error", "ok", 4_999)
    assert one(spark, clocks.parse_instant_ms(F.lit("2026-10-01T00:00:00.250Z")))[0] == 1_790_812_800_250
