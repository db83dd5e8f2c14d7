"""Masking and personal-data patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns kept to what RE2 and Java read alike. They tell only whether
# a text has a match, so the e-mail starts at the last character before the sign:
# a longer local part would be tried anew from each of its characters.
EMAIL = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2}"
PHONE_END = r"[0-9]{3}[ .-][0-9]{4}"
PHONE = r"(^|[^0-9])(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}([^0-9]|$)"
CARD_DIGITS = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"
CARD = r"(^|[^0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}([^0-9]|$)"


def mask_ip(ip: Column) -> Column:
    """Last octet of a dotted IPv4 address set to zero; other text is unchanged."""
    return F.regexp_replace(ip, r"^([0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})[.][0-9]{1,3}$", "$1.0")


def anonymize(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value), 256)


def has_email(text: Column) -> Column:
    return _both(F.contains(text, F.lit("@")), text.rlike(EMAIL))


def has_phone(text: Column) -> Column:
    return _both(text.rlike(PHONE_END), text.rlike(PHONE))


def has_card(text: Column) -> Column:
    return _both(text.rlike(CARD_DIGITS), text.rlike(CARD))


def _both(cheap: Column, exact: Column) -> Column:
    """The cheap test is implied by the exact one and spares most texts its cost."""
    return F.coalesce(cheap & exact, F.lit(False))
