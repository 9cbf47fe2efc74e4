"""Text columns: trimming, e-mail addresses, currency codes, names, defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: the accepted form of an e-mail address.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
DEFAULT_CURRENCY = "USD"


def trim_blank(value: Column) -> Column:
    """Strip Unicode white space on both ends; blank text becomes null.

    ``btrim`` with a character set is linear in the text, unlike an ``\\s+$`` pattern.
    """
    return F.nullif(F.btrim(value, F.lit(WHITE_SPACE)), F.lit(""))


def email_address(value: Column) -> Column:
    """Trimmed and lower-cased address, null when it has not the form of one."""
    address = F.lower(F.btrim(value, F.lit(WHITE_SPACE)))
    return F.when(address.rlike(EMAIL_PATTERN), address)


def currency_code(value: Column, default: str = DEFAULT_CURRENCY) -> Column:
    return F.coalesce(F.upper(trim_blank(value)), F.lit(default))


def or_default(value: Column, default) -> Column:
    """The default in place of null or empty text."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def compose_name(first: Column, last: Column) -> Column:
    """``first last``; only the last name when there is no first name."""
    return F.when(first.isNotNull(), F.concat(first, F.lit(" "), last)).otherwise(last)
