"""Money text and money arithmetic. Decimals are multiplied or summed first and narrowed once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def positive_amount(text: Column) -> Column:
    """Accounting text to a magnitude; the parentheses are formatting."""
    return F.regexp_replace(text, "[()]", "").cast(MONEY)


def is_accounting_text(text: Column) -> Column:
    return text.startswith("(")


def signed_cents(text: Column) -> Column:
    """Accounting text to cents; parentheses mean a credit, anything unreadable is NULL."""
    trimmed = F.trim(text)
    plain = trimmed.rlike(r"^-?[0-9]+(\.[0-9]+)?$")
    credit = trimmed.rlike(r"^\([0-9]+(\.[0-9]+)?\)$")
    digits = F.regexp_replace(trimmed, "[()]", "")
    cents = (digits.try_cast("decimal(18,2)") * 100).cast("bigint")
    return F.when(plain, cents).when(credit, -cents)


def accounting_text(amount: Column, use_parentheses: Column) -> Column:
    plain = amount.cast(MONEY).cast("string")
    return F.when(use_parentheses, F.concat(F.lit("("), plain, F.lit(")"))).otherwise(plain)


def narrow(amount: Column) -> Column:
    return amount.cast(MONEY)


def commission(subtotal: Column, pct: Column) -> Column:
    return narrow(subtotal * pct)


def tax_cents(subtotal_cents: Column, rate_bps: Column) -> Column:
    """Half-up on exact decimals, never on a double."""
    exact = subtotal_cents.cast("decimal(20,0)") * rate_bps.cast("decimal(6,0)")
    return F.round(exact * F.lit("0.0001").cast("decimal(5,4)"), 0).cast("bigint")
