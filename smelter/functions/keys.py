"""Column rules that bring keys of different systems into one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key layout.
CUSTOMER_KEY_LENGTH = 10
CATEGORY_LENGTH = 5
PRODUCT_NUMBER_START = 7


def customer_key_of_suffix(cid: Column) -> Column:
    """Customer key at the end of a prefixed id."""
    return F.right(cid, F.lit(CUSTOMER_KEY_LENGTH))


def customer_key_of_dashed(cid: Column) -> Column:
    """Customer key of an id written with dashes."""
    return F.replace(cid, F.lit("-"), F.lit(""))


def category_id(prd_key: Column) -> Column:
    """Category part of a product key, spelled as in the category table."""
    return F.replace(F.substring(prd_key, 1, CATEGORY_LENGTH), F.lit("-"), F.lit("_"))


def product_number(prd_key: Column) -> Column:
    """Rest of a product key, after the category and its dash."""
    return F.substr(prd_key, F.lit(PRODUCT_NUMBER_START))


def comparable(key: Column) -> Column:
    """A text key as joins compare it: trailing blanks don't count."""
    return F.rtrim(key)


def pseudonym(c: Column) -> Column:
    """SHA-256 of the UTF-16LE bytes in upper-case hex."""
    return F.upper(F.sha2(F.encode(c, "UTF-16LE"), 256))
