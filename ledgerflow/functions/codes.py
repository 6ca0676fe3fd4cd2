"""Small value rules as Column expressions (F-7 ... F-11, F-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation -> transaction type (F-10).  NULL operation is its own
# category, written with the sentinel below while fitting.
MISSING_OPERATION = "__MISSING__"
TYPE_BY_OPERATION = {
    "VKLAD": "PRIJEM",
    "PREVOD Z UCTU": "PRIJEM",
    "PREVOD NA UCET": "VYDAJ",
    "VYBER KARTOU": "VYDAJ",
    "VYBER": "VYDAJ",
    MISSING_OPERATION: "VYBER",
}

# Domain sets declared for the source tables (FL-5, DQ-3).
TRANSACTION_TYPES = ["PRIJEM", "VYDAJ", "VYBER"]
DISPOSITION_TYPES = ["OWNER", "DISPONENT"]
GENDERS = ["M", "F"]

# Dead-letter reasons (F-11).
REASON_MISSING_ACCOUNT = "missing_account_id"
REASON_REFERENTIAL = "referential_violation"
# Own value: a message whose value is no JSON object of the expected shape.
REASON_UNREADABLE = "unreadable_message"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def empty_to_null(x: Column | str) -> Column:
    """F-7: '' -> NULL; a single space is kept."""
    return F.nullif(_c(x), F.lit(""))


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """F-8: num / nullif(den, 0) as a plain double (safe under ANSI mode)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def operation_key(op: Column | str) -> Column:
    """F-9: NULL operation -> sentinel category."""
    return F.coalesce(_c(op), F.lit(MISSING_OPERATION))


def operation_from_key(key: Column | str) -> Column:
    """F-9 inverse: sentinel -> NULL."""
    return F.nullif(_c(key), F.lit(MISSING_OPERATION))


def type_of_operation(op_key: Column | str) -> Column:
    """F-10: map an operation key to its type; unknown keys give NULL (a DQ rule
    flags them)."""
    mapping = F.create_map(*[F.lit(x) for kv in TYPE_BY_OPERATION.items() for x in kv])
    return F.try_element_at(mapping, _c(op_key))


def dlq_reason(account_id: Column | str, client_id: Column | str) -> Column:
    """F-11: NULL account -> missing_account_id; no profile -> referential_violation."""
    return (F.when(_c(account_id).isNull(), F.lit(REASON_MISSING_ACCOUNT))
            .when(_c(client_id).isNull(), F.lit(REASON_REFERENTIAL)))


def round_half_up(x: Column | str, digits: int) -> Column:
    """Engine-independent rounding of a double: floor(x * 10^d + 0.5) / 10^d.

    Both Spark and DuckDB evaluate this identically in IEEE doubles, unlike
    ``round``, whose tie handling differs between engines.
    """
    scale = float(10 ** digits)
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def clipped_lognormal(mu: Column, sigma: Column, z: Column, lo: Column, hi: Column) -> Column:
    """F-13: exp(mu + sigma * z) clipped to [lo, hi] and rounded to cents."""
    raw = F.exp(mu + sigma * z)
    return round_half_up(F.greatest(lo, F.least(hi, raw)), 2)
