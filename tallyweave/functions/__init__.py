"""Column builders: narrow, stateless expressions that work on batch and streaming frames."""

from tallyweave.functions.keys import email_key, source_key
from tallyweave.functions.numbers import money, net_amount, round2, to_double, to_long
from tallyweave.functions.text import (
    compose_name,
    currency_code,
    email_address,
    or_default,
    trim_blank,
)
from tallyweave.functions.times import epoch_iso, parse_time, utc_iso

__all__ = [
    "compose_name", "currency_code", "email_address", "email_key", "epoch_iso", "money",
    "net_amount", "or_default", "parse_time", "round2", "source_key", "to_double", "to_long",
    "trim_blank", "utc_iso",
]
