"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How the parts of a seed are joined, how a missing part is written,
# the seed of a key made from an e-mail address, and the length of the digest kept.
SEPARATOR = "::"
MISSING = "None"
EMAIL_SEED = "cust_email_"
DIGEST_LENGTH = 16


def _digest(prefix: str, seed: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(seed, 256), 1, DIGEST_LENGTH))


def source_key(prefix: str, *parts: Column | str) -> Column:
    """Key from its parts; a plain string is a constant part. The prefix is not hashed."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(F.lit(part) if isinstance(part, str)
                      else F.coalesce(part.cast("string"), F.lit(MISSING)))
    return _digest(prefix, F.concat(*pieces))


def reference_key(prefix: str, namespace: str, value: Column) -> Column:
    """Key of a row in another table; null when there is no reference."""
    return F.when(value.isNotNull(), source_key(prefix, namespace, value))


def email_key(address: Column) -> Column:
    return _digest("cust", F.concat(F.lit(EMAIL_SEED), address))
