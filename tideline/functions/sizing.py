"""Encoded-size expressions for aggregated records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def varint_size(n: Column | str) -> Column:
    """Bytes a non-negative integer takes as a base-128 varint (0 takes one)."""
    n = _col(n).cast("bigint")
    return F.ceil(F.length(F.bin(n)) / F.lit(7)).cast("bigint")


def _delimited(length: Column) -> Column:
    return F.lit(1) + varint_size(length) + length


def record_size(
    pk_len: Column | str,
    pk_is_new: Column | str,
    pk_index: Column | str,
    data_len: Column | str,
    ehk_len: Column | str,
    ehk_is_new: Column | str,
    ehk_index: Column | str,
) -> Column:
    """Bytes a user record adds to an open aggregate.

    A key costs its own bytes only the first time a batch sees it; every record
    costs its key indexes, its data and the length prefixes. ``ehk_len`` is NULL
    for a record without an explicit hash key.
    """
    pk_len, data_len, ehk_len = (_col(c).cast("bigint") for c in (pk_len, data_len, ehk_len))
    keys = F.when(_col(pk_is_new), _delimited(pk_len)).otherwise(F.lit(0)) + F.when(
        ehk_len.isNotNull() & _col(ehk_is_new), _delimited(ehk_len)
    ).otherwise(F.lit(0))
    inner = (
        F.lit(1)
        + varint_size(pk_index)
        + F.when(ehk_len.isNotNull(), F.lit(1) + varint_size(ehk_index)).otherwise(F.lit(0))
        + _delimited(data_len)
    )
    return (keys + _delimited(inner)).cast("bigint")
