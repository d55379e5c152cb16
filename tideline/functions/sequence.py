"""Sequence-number expressions.

Sequence numbers run far beyond DECIMAL(38), so they stay strings: ``base`` is
the canonical text, ``base_key`` a form of it whose string order is the number
order. The marker of a stream's beginning sorts before every number, all other
markers after.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits whose count fits the key; services use 129 at most.
MAX_DIGITS = 99_999

#: Markers that stand for a place in a stream: its beginning, its tip, and the end of a shard.
BEGINNING = "TRIM_HORIZON"
PLACES = (BEGINNING, "LATEST", "SHARD_END")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _led_by_digit(c: Column) -> Column:
    return F.ascii(c).between(48, 57)


def decode_base(c: Column | str) -> Column:
    """Canonical text of a sequence number; text led by a digit must be a number."""
    c = _col(c)
    digits = F.ltrim(c, F.lit("0"))
    number = F.when(digits == "", "0").otherwise(digits)
    broken = F.raise_error(F.concat(F.lit("not a sequence number: "), c)).cast("string")
    return F.when(_led_by_digit(c), F.when(c.rlike("^[0-9]+$"), number).otherwise(broken)).otherwise(c)


def base_key(base: Column | str) -> Column:
    """Sort key of a canonical ``base``: a number's digits behind their count.

    Without leading zeros the longer number is the greater one, so the count, as
    five digits, decides first. That keeps keys as short as the numbers are.
    """
    base = _col(base)
    count = F.length(base)
    number = F.when(
        count > MAX_DIGITS, F.raise_error(F.concat(F.lit("sequence number too long: "), base)).cast("string")
    ).otherwise(F.concat(F.lpad(count.cast("string"), 5, "0"), base))
    marker = F.when(base == BEGINNING, F.concat(F.lit("!"), base)).otherwise(F.concat(F.lit("~"), base))
    return F.when(_led_by_digit(base), number).otherwise(marker)


def place_key(base_key: Column | str) -> Column:
    """The key of a number or of a marker that stands for a place; any other marker fails."""
    key = _col(base_key)
    known = _led_by_digit(key) | F.substring(key, 2, MAX_DIGITS).isin(*PLACES)
    unknown = F.raise_error(F.concat(F.lit("no place in a stream: "), key)).cast("string")
    return F.when(key.isNull() | known, key).otherwise(unknown)


def order_columns() -> list[Column]:
    """Total order of records inside a shard."""
    return [
        F.col("base_key"),
        F.coalesce(F.col("sub"), F.lit(0)),
        F.coalesce(F.col("user_sub"), F.lit(0)),
    ]


def position(*, whole: bool = False) -> Column:
    """Comparable struct of a record's place; ``max`` of it is the newest record.

    The first three fields decide the comparison; the others ride along so that
    an aggregate over positions hands back a complete checkpoint. ``whole``
    leaves the position inside an aggregated record out of the comparison.
    """
    keys = [
        F.col("base_key").alias("k_base"),
        F.coalesce(F.col("sub"), F.lit(0)).cast("bigint").alias("k_sub"),
    ]
    if not whole:
        keys.append(F.coalesce(F.col("user_sub"), F.lit(0)).cast("bigint").alias("k_user_sub"))
    carried = ["base", "base_key", "sub", "user_sub", "user_total"]
    return F.struct(*keys, *[F.col(c) for c in carried])


def order_key() -> Column:
    """The comparison part of :func:`position` alone."""
    return F.struct(
        F.col("base_key").alias("k_base"),
        F.coalesce(F.col("sub"), F.lit(0)).cast("bigint").alias("k_sub"),
        F.coalesce(F.col("user_sub"), F.lit(0)).cast("bigint").alias("k_user_sub"),
    )


def request_position(seq: Column | str, sub: Column | str) -> Column:
    """Start position named by a request: text and sub-sequence, or all NULL."""
    seq, sub = _col(seq), _col(sub)
    base = decode_base(seq)
    sub = F.when(seq.isNotNull(), sub).cast("bigint")
    return F.struct(
        base.alias("base"),
        base_key(base).alias("base_key"),
        sub.alias("sub"),
        sub.alias("user_sub"),
        F.lit(None).cast("bigint").alias("user_total"),
    )


def is_sub_record(user_sub: Column | str = "user_sub", user_total: Column | str = "user_total") -> Column:
    """True for every record of an aggregate but its last one; never NULL."""
    return F.coalesce(_col(user_sub) < _col(user_total) - 1, F.lit(False))
