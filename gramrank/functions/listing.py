"""Postal codes, popularity and validity of business listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Postal letters A..Z as digits, int(position / (26 / 9)) with A = 1.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTER_DIGITS = "00111222333444555666777889"
# Fixed value: review count that gives a listing the full weight of its stars.
FULL_REVIEWS = 7968.0
# Fixed value: divisor of the postal number on the x axis.
ZIP_SCALE = 10000.0


def letters_to_digits(code: Column) -> Column:
    return F.translate(code, LETTERS, LETTER_DIGITS)


def zip_number(code: Column, second: Column) -> Column:
    """Postal code as a number: five digits as they are; a code in two parts
    becomes five digits, a point and the remaining one or two digits."""
    digits = letters_to_digits(F.concat(code, second))
    two_parts = F.concat(F.substring(digits, 1, 5), F.lit("."), F.substring(digits, 6, 2))
    return (
        F.when(F.length(code) == 5, code.try_cast("double"))
        .when(
            F.length(code).isin(3, 4) & two_parts.rlike("^[0-9]{5}[.][0-9]{1,2}$"),
            two_parts.try_cast("double"),
        )
    )


def popularity(stars: Column, reviews: Column) -> Column:
    return stars * F.ln(reviews) / F.ln(F.lit(FULL_REVIEWS))


def is_alphanumeric(text: Column) -> Column:
    """Letters and digits of any script, not empty."""
    return text.rlike(r"^[\p{L}\p{Nd}]+$")


def valid_code(code: Column, second: Column) -> Column:
    """Three to five of ``0-9A-Z``, nothing else; five must be all digits, three
    or four need a second part of three letters or digits."""
    allowed = F.length(F.regexp_replace(code, "[^0-9A-Z]", ""))
    return (
        allowed.between(3, 5)
        & is_alphanumeric(code)
        & ((F.length(code) != 5) | code.rlike("^[0-9]{5}$"))
        & (
            ~F.length(code).isin(3, 4)
            | ((F.length(second) == 3) & is_alphanumeric(second))
        )
    )
