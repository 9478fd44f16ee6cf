"""Standardising raw export text: amounts, dates, currencies, channels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.schemas import MONEY

# Spellings of a currency.
CURRENCY_ALIASES = {
    "US": "USD",
    "USA": "USD",
    "DOLLAR": "USD",
    "$": "USD",
    "EURO": "EUR",
    "EU": "EUR",
    "€": "EUR",
    "POUND": "GBP",
    "UK": "GBP",
    "£": "GBP",
}

# Channel words, first matching channel wins.
CHANNEL_WORDS = [
    ("pos", ["pos", "point of sale", "debit"]),
    ("ecom", ["online", "ecommerce", "web"]),
    ("ach", ["ach", "transfer", "wire"]),
    ("zelle", ["zelle", "venmo", "paypal"]),
    ("atm", ["atm", "withdrawal"]),
]

# Date patterns, tried in this order; then any ISO-like date and time.
DATE_PATTERNS = ["yyyy-M-d", "M/d/yyyy", "d/M/yyyy"]

# Further ways to write a date, tried after those: month names, compact, slashes and dots, two-digit years.
FREE_PATTERNS = [
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "yyyyMMdd",
    "yyyy/M/d",
    "d.M.yyyy",
    "M/d/yy",
]


def parse_amount(raw: Column) -> Column:
    """Money text without ``$`` and thousands commas; NULL when unreadable."""
    return F.trim(F.regexp_replace(raw.cast("string"), "[$,]", "")).try_cast(MONEY)


def std_amount(raw: Column, is_credit: bool | Column = False) -> Column:
    """Signed amount; card exports list charges as positive, so those flip."""
    credit = is_credit if isinstance(is_credit, Column) else F.lit(is_credit)
    value = parse_amount(raw)
    flipped = F.when(credit & (value > 0), -value).otherwise(value)
    return F.coalesce(flipped, F.lit(0)).cast(MONEY)


def std_date(raw: Column) -> Column:
    """Timestamp without zone; month-first beats day-first, unreadable gives NULL.

    Nothing passes through a zoned timestamp, so the session's time zone has no effect.
    """
    text = F.trim(raw)
    dates = [F.try_to_date(text, p).cast("timestamp_ntz") for p in [*DATE_PATTERNS, *FREE_PATTERNS]]
    known = len(DATE_PATTERNS)
    # eight digits alone would also cast, as a year
    iso = F.when(text.rlike(r"^\d{4}-"), text.try_cast("timestamp_ntz"))
    return F.coalesce(*dates[:known], iso, *dates[known:])


def std_currency(raw: Column) -> Column:
    """ISO code; known aliases are mapped, other codes pass, NULL is USD."""
    code = F.upper(F.trim(raw))
    aliases = F.create_map(*[F.lit(x) for pair in CURRENCY_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, code), code, F.lit("USD"))


def detect_channel(description: Column) -> Column:
    """Channel by substring: "deposit" contains "pos" and is therefore pos."""
    text = F.lower(description)
    result = F.lit("unknown")
    for channel, words in reversed(CHANNEL_WORDS):
        found = text.contains(words[0])
        for word in words[1:]:
            found = found | text.contains(word)
        result = F.when(found, F.lit(channel)).otherwise(result)
    return result


def clean_text(raw: Column) -> Column:
    return F.trim(F.coalesce(raw, F.lit("")))
