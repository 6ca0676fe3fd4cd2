"""Packed-date and birth-number decoding as Column expressions (F-1 ... F-6).

All functions take and return ``Column`` objects, so they stay inside
whole-stage codegen.  ``strict=True`` uses ``to_date`` (ANSI: a bad value fails
the query, which is what the mart wants); ``strict=False`` uses ``try_to_date``
(NULL on a bad value) for the rejected-row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference day for ages.
END_OF_DATASET = "1998-12-31"
END_OF_DATASET_YEAR = 1998


def _parse(text: Column, strict: bool) -> Column:
    return F.to_date(text, "yyyyMMdd") if strict else F.try_to_date(text, "yyyyMMdd")


def padded_yymmdd(packed: Column | str) -> Column:
    """YYMMDD integer (leading zeros lost) -> 6-character text."""
    c = F.col(packed) if isinstance(packed, str) else packed
    return F.lpad(c.cast("string"), 6, "0")


def transaction_date(packed: Column | str, strict: bool = True) -> Column:
    """F-5: pad to 6; a leading 0 means 20xx, anything else 19xx."""
    p = padded_yymmdd(packed)
    century = F.when(p.startswith("0"), F.lit("20")).otherwise(F.lit("19"))
    return _parse(F.concat(century, p), strict)


def account_open_date(packed: Column | str, strict: bool = True) -> Column:
    """F-4: a leading 9 means 19xx, anything else 20xx (padded first, see Q-4)."""
    p = padded_yymmdd(packed)
    century = F.when(p.startswith("9"), F.lit("19")).otherwise(F.lit("20"))
    return _parse(F.concat(century, p), strict)


def is_female(birth_number: Column | str) -> Column:
    """F-1 predicate: month part (real-valued) above 50."""
    b = F.col(birth_number) if isinstance(birth_number, str) else birth_number
    return (b % 10000) / 100 > 50


def gender(birth_number: Column | str) -> Column:
    """F-1: 'F' when the month part is above 50, else 'M'."""
    return F.when(is_female(birth_number), F.lit("F")).otherwise(F.lit("M"))


def birth_date(birth_number: Column | str, strict: bool = True) -> Column:
    """F-2: minus 5000 for women, pad to 6, always prefix '19'."""
    b = F.col(birth_number) if isinstance(birth_number, str) else birth_number
    plain = F.when(is_female(b), b - 5000).otherwise(b)
    return _parse(F.concat(F.lit("19"), padded_yymmdd(plain)), strict)


def age_at_end_of_dataset(birth: Column | str) -> Column:
    """F-3: difference of calendar years to 1998-12-31 (not completed years)."""
    d = F.col(birth) if isinstance(birth, str) else birth
    return (F.lit(END_OF_DATASET_YEAR) - F.year(d)).cast("bigint")


def to_yymmdd(d: Column | str) -> Column:
    """F-6: date -> YYMMDD integer (2000s lose their leading zeros)."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_format(c, "yyMMdd").cast("bigint")
