"""Market tickers, sides, pricing conventions and error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fixed import as_col, complement

MAX_TICKER_BYTES = 128

# Month names inside event tickers, in calendar order.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Server error codes that end a subscription, and the one that means "too slow".
TERMINAL_CODES = (10, 17, 25)
OVERFLOW_CODE = 25

# Pricing conventions a session may declare.
CONVENTIONS = ("no_leg", "yes_leg")


def ticker_failure(text: Column | str) -> Column:
    """Why a ticker is unusable, as a code; NULL when it is fine."""
    c = as_col(text)
    return (
        F.when(c == "", "empty")
        .when(F.octet_length(c) > MAX_TICKER_BYTES, "too_long")
        .when(~c.rlike(r"\A[A-Za-z0-9._-]*\z"), "invalid_char")
        .when(c.startswith("."), "unsafe_as_path")
    )


def is_canonical(text: Column | str) -> Column:
    return ~as_col(text).rlike("[a-z]")


def normalize_ticker(text: Column | str) -> Column:
    """Upper-case ticker, NULL when it does not validate."""
    c = as_col(text)
    return F.when(ticker_failure(c).isNull(), F.upper(c))


def strict_ticker(text: Column | str) -> Column:
    """The ticker as given, NULL when it does not validate or is not upper case."""
    c = as_col(text)
    return F.when(ticker_failure(c).isNull() & is_canonical(c), c)


def event_ticker(text: Column | str) -> Column:
    """Everything before the last '-', empty when there is none."""
    c = as_col(text)
    return F.when(F.instr(c, "-") > 0, F.regexp_replace(c, r"-[^-]*\z", "")).otherwise(
        F.when(c.isNotNull(), F.lit(""))
    )


def outcome(text: Column | str) -> Column:
    return F.substring_index(as_col(text), "-", -1)


def event_date(text: Column | str) -> Column:
    """Date from the first ``-YYMMMDD`` of the event ticker, NULL when there is no such valid date."""
    event = event_ticker(text)
    pattern = r"-([0-9]{2})([A-Z]{3})([0-9]{2})"
    year, name, day = (F.regexp_extract(event, pattern, i) for i in (1, 2, 3))
    at = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    month = F.lpad(at.cast("string"), 2, "0")
    return F.when(at > 0, F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-"), day).try_cast("date"))


def opposite_side(side: Column | str) -> Column:
    s = as_col(side)
    return F.when(s == "yes", "no").when(s == "no", "yes")


def yes_price(side: Column | str, price: Column | str, convention: Column | str) -> Column:
    """Price on the canonical YES side. An unknown convention fails the job: there is no safe default."""
    s, p, k = as_col(side), as_col(price), as_col(convention)
    unknown = F.raise_error(F.concat(F.lit("unknown pricing convention: "), F.coalesce(k, F.lit("NULL"))))
    return (
        F.when(~F.coalesce(k.isin(*CONVENTIONS), F.lit(False)), unknown.cast("bigint"))
        .when((s == "no") & (k == "no_leg"), complement(p))
        .otherwise(p)
    )


def trade_direction(outcome_side: Column | str, book_side: Column | str, legacy_side: Column | str) -> Column:
    """Taker side. A present but unknown book side gives NULL and does not fall through to the legacy field."""
    o, b = as_col(outcome_side), as_col(book_side)
    return (
        F.when(o.isNotNull(), o)
        .when(b == "bid", "yes")
        .when(b == "ask", "no")
        .when(b.isNull(), as_col(legacy_side))
    )


def is_terminal_error(code: Column | str) -> Column:
    return as_col(code).isin(*TERMINAL_CODES)


def is_overflow_error(code: Column | str) -> Column:
    return as_col(code) == OVERFLOW_CODE


def recovery_for_error(code: Column | str) -> Column:
    return F.when(is_terminal_error(code), "resubscribe")
