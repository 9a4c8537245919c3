"""Masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email_hash(email: Column, salt: str) -> Column:
    if not salt or not salt.strip():
        raise ValueError("the hash salt is empty: hashes would be unsalted")
    return F.sha2(F.concat(F.lit(salt), F.lower(F.trim(email))), 256)


def phone_masked(phone: Column) -> Column:
    """First three characters, stars, last three."""
    size = F.length(phone)
    return F.concat(F.substring(phone, 1, 3), F.repeat(F.lit("*"), size - 6),
                    F.substring(phone, size - 2, F.lit(3)))
