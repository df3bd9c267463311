"""Exact fixed-point numbers as Column expressions; no floating point anywhere.

Prices are BIGINT micro-dollars (6 digits), quantities BIGINT hundredths
(2 digits), notionals BIGINT at 8 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scales of the wire format.
PX_DIGITS = 6
QTY_DIGITS = 2
NOTIONAL_DIGITS = 8
ONE_DOLLAR = 1_000_000
MAX_DIGITS = 18

I64_MAX = 9_223_372_036_854_775_807
I128_MAX_TEXT = "170141183460469231731687303715884105727"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column | str, b: Column | str | int) -> Column:
    """BIGINT division truncating toward zero (SQL ``div``)."""
    divisor = F.lit(b).cast("bigint") if isinstance(b, int) else as_col(b)
    return F.call_function("div", as_col(a).cast("bigint"), divisor)


def floor_div(a: Column | str, b: int) -> Column:
    """BIGINT division toward minus infinity."""
    x = as_col(a).cast("bigint")
    return int_div(x - F.pmod(x, F.lit(b).cast("bigint")), b)


def parse_scaled(text: Column | str, digits: int) -> Column:
    """Decimal text -> scaled BIGINT, NULL when the text is not exactly representable.

    One anchored pattern covers shape and precision together: at most ``digits``
    fractional digits may be non-zero. ``\\A``/``\\z`` are used because ``$``
    would accept a trailing newline.
    """
    if digits > MAX_DIGITS:
        return F.lit(None).cast("bigint")
    c = as_col(text)
    tail = rf"(\.[0-9]{{1,{digits}}}0*)?" if digits else r"(\.0+)?"
    dot = F.instr(c, ".")
    whole = F.when(dot > 0, F.substring_index(c, ".", 1)).otherwise(c)
    frac = F.when(dot > 0, F.substring_index(c, ".", -1)).otherwise(F.lit(""))
    scaled = F.concat(whole, F.rpad(F.substring(frac, 1, digits), digits, "0")) if digits else whole
    return F.when(c.rlike(rf"\A-?[0-9]+{tail}\z"), scaled.try_cast("bigint"))


def parse_failure(text: Column | str, digits: int) -> Column:
    """Why ``parse_scaled`` gave NULL, as a code; NULL when it parsed or the text is NULL."""
    c = as_col(text)
    if digits > MAX_DIGITS:
        return F.when(c.isNotNull(), F.lit("unsupported_scale"))
    body = F.when(c.startswith("-"), F.substring(c, 2, 2147483647)).otherwise(c)
    dots = F.length(body) - F.length(F.replace(body, F.lit("."), F.lit("")))
    whole = F.substring_index(body, ".", 1)
    frac = F.when(dots > 0, F.substring_index(body, ".", -1))
    kept = F.rpad(F.substring(F.coalesce(frac, F.lit("")), 1, digits), digits, "0") if digits else F.lit("")
    magnitude = F.regexp_replace(F.concat(whole, kept), r"\A0+", "")
    beyond_i128 = (F.length(magnitude) > len(I128_MAX_TEXT)) | (
        (F.length(magnitude) == len(I128_MAX_TEXT)) & (magnitude > I128_MAX_TEXT)
    )
    excess = F.substring(F.coalesce(frac, F.lit("")), digits + 1, 2147483647)
    return (
        F.when(c.isNull(), None)
        .when(c == "", "empty")
        .when(dots > 1, "multiple_decimal_points")
        .when(whole == "", "missing_integer_digits")
        .when(~whole.rlike(r"\A[0-9]+\z"), "invalid_char")
        .when(frac == "", "missing_fraction_digits")
        .when(frac.isNotNull() & ~frac.rlike(r"\A[0-9]+\z"), "invalid_char")
        .when(beyond_i128, "overflow")
        .when(excess.rlike("[1-9]"), "excess_precision")
        .when(parse_scaled(c, digits).isNull(), "overflow")
    )


def reparse_scaled(text: Column | str, digits: int) -> Column:
    """A second parser for the audit, sharing no step with ``parse_scaled``.

    Works on DECIMAL values instead of digit strings, so that a fault in one
    parser cannot hide in the other.
    """
    c = as_col(text)
    shape = c.rlike(r"\A-?[0-9]+(\.[0-9]+)?\z")
    # Trailing zeros after the point carry no information.
    tidy = F.when(F.instr(c, ".") > 0, F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))).otherwise(c)
    point = F.instr(tidy, ".")
    places = F.when(point > 0, F.length(tidy) - point).otherwise(0)
    number = tidy.try_cast(f"decimal(38,{digits})")
    scaled = F.try_multiply(number, F.lit(10**digits).cast("decimal(19,0)")).try_cast("bigint")
    return F.when(shape & (places <= digits), scaled)


def format_scaled(value: Column | str, digits: int) -> Column:
    """Scaled BIGINT -> decimal text with all ``digits`` fractional digits, exact at both int64 ends."""
    v = as_col(value)
    text = v.cast("string")
    if digits == 0:
        return F.concat(text, F.lit(".0"))
    sign = F.when(v < 0, "-").otherwise("")
    bare = F.ltrim(text, F.lit("-"))
    padded = F.lpad(bare, F.greatest(F.length(bare), F.lit(digits + 1)), F.lit("0"))
    return F.concat(
        sign,
        F.substring(padded, F.lit(1), F.length(padded) - digits),
        F.lit("."),
        F.right(padded, F.lit(digits)),
    )


def parse_price(text: Column | str) -> Column:
    return parse_scaled(text, PX_DIGITS)


def format_price(value: Column | str) -> Column:
    return format_scaled(value, PX_DIGITS)


def parse_quantity(text: Column | str) -> Column:
    return parse_scaled(text, QTY_DIGITS)


def format_quantity(value: Column | str) -> Column:
    return format_scaled(value, QTY_DIGITS)


def format_notional(value: Column | str) -> Column:
    return format_scaled(value, NOTIONAL_DIGITS)


def checked_complement(price: Column | str) -> Column:
    """$1.00 - p, NULL when it leaves int64."""
    return F.try_subtract(F.lit(ONE_DOLLAR).cast("bigint"), as_col(price))


def complement(price: Column | str) -> Column:
    """$1.00 - p, saturating at the int64 maximum."""
    p = as_col(price)
    return F.when(p.isNotNull(), F.coalesce(checked_complement(p), F.lit(I64_MAX)))


def checked_add(a: Column | str, b: Column | str) -> Column:
    return F.try_add(as_col(a), as_col(b))


def checked_subtract(a: Column | str, b: Column | str) -> Column:
    return F.try_subtract(as_col(a), as_col(b))


def midpoint(a: Column | str, b: Column | str) -> Column:
    """Floor of the mean: shared bits plus half of the differing bits, so nothing can overflow."""
    x, y = as_col(a), as_col(b)
    return x.bitwiseAND(y) + F.shiftright(x.bitwiseXOR(y), 1)


def notional(price: Column | str, quantity: Column | str) -> Column:
    """price x quantity at 8 digits, NULL outside int64."""
    return F.try_multiply(as_col(price), as_col(quantity))


def notional_micros(value: Column | str) -> Column:
    """Notional -> micro-dollars, half away from zero."""
    n = as_col(value)
    rest = n % 100
    step = F.when(rest >= 50, 1).when(rest <= -50, -1).otherwise(0)
    return int_div(n, 100) + step


def dual(raw: Column, name: str, digits: int) -> list[Column]:
    """The stored pair: the text as sent, and the integer read from it."""
    unit = "micros" if digits == PX_DIGITS else "fp_units"
    return [raw.alias(f"{name}_raw"), parse_scaled(raw, digits).alias(f"{name}_{unit}")]
