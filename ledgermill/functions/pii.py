"""Personal-data patterns and their redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pattern per kind, applied in this order (the account pattern is
# the widest and must come last).
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PII_PATTERNS = {
    "credit_card": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "email": _EMAIL,
    "phone": r"\b\d{3}-\d{3}-\d{4}\b",
    "account_number": r"\b\d{8,12}\b",
}

# The log variant, with its own tags.
LOG_PATTERNS = [
    (r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "[CARD_NUMBER]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN]"),
    (_EMAIL, "[EMAIL]"),
    (r"\b\d{3}-\d{3}-\d{4}\b", "[PHONE]"),
    (r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", "[NAME]"),
]


def redact(text: Column) -> Column:
    for kind, pattern in PII_PATTERNS.items():
        text = F.regexp_replace(text, pattern, f"[{kind.upper()}]")
    return text


def redact_log(text: Column) -> Column:
    for pattern, tag in LOG_PATTERNS:
        text = F.regexp_replace(text, pattern, tag)
    return text


def redact_map(record: Column) -> Column:
    """Redact the values of a map<string,string>."""
    return F.transform_values(record, lambda _, v: redact(v))


def redact_list(items: Column) -> Column:
    """Redact the items of an array<string>."""
    return F.transform(items, redact)


def redact_nested(record: Column) -> Column:
    """Redact a map<string,map<string,string>>."""
    return F.transform_values(record, lambda _, v: redact_map(v))
