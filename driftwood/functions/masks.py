"""Masking and hashing expressions.

They are plain Column expressions (no Python UDF) so they stay inside
whole-stage code generation and do not block filter pushdown on other
columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mask_email(c: str | Column) -> Column:
    """``ab***@domain``: first two characters, then the domain."""
    e = _c(c)
    return F.concat(F.left(e, F.lit(2)), F.lit("***@"), F.split_part(e, F.lit("@"), F.lit(2)))


def mask_last4(c: str | Column, prefix: str = "***-") -> Column:
    """Keep only the last four characters (card, phone, id numbers)."""
    return F.concat(F.lit(prefix), F.right(_c(c).cast("string"), F.lit(4)))


def mask_ssn(c: str | Column) -> Column:
    return mask_last4(c, "***-**-")


def mask_salary(c: str | Column, bucket: int = 10000) -> Column:
    """Salary shown as a band floor (e.g. 40000 for 43210)."""
    return (F.floor(_c(c) / F.lit(bucket)) * F.lit(bucket)).cast("long")


def redact(c: str | Column) -> Column:
    return F.lit("REDACTED").cast("string")


def hash_id(c: str | Column) -> Column:
    """One-way surrogate: hex SHA-256 of the value's string form."""
    return F.sha2(_c(c).cast("string"), 256)


def keyed_digest(c: str | Column, secret: bytes) -> Column:
    """HMAC-SHA-256 in hex of the value's string form. Without ``secret`` a small key space cannot be enumerated
    to undo it; the secret belongs in the session's secret store, never beside the data."""
    key = hashlib.sha256(secret).digest() if len(secret) > 64 else secret
    inner, outer = (F.lit(bytearray(b ^ pad for b in key.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    value = _c(c).cast("string").cast("binary")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, value), 256))), 256)
