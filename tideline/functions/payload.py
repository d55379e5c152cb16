"""Payload expressions: base64, format test, checksum."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.schema import DIGEST_BYTES, MAGIC_DEFLATED, MAGIC_PLAIN

Decoder = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base64_decoder(c: Column) -> Column:
    """Strict base64: text outside the alphabet fails the query; a line end behind it does not."""
    return F.to_binary(F.rtrim(c, F.lit(" \t\r\n")), F.lit("base64"))


def decode_data(c: Column | str, decoder: Decoder | None = None) -> Column:
    """Decode record text with ``decoder`` (a Column -> Column function)."""
    return (decoder or base64_decoder)(_col(c))


def record_format(data: Column | str) -> Column:
    """``plain``, ``aggregated`` or ``deflated``, from the first four bytes."""
    head = F.substring(_col(data), 1, 4)
    return (
        F.when(head == F.lit(MAGIC_PLAIN), "aggregated")
        .when(head == F.lit(MAGIC_DEFLATED), "deflated")
        .otherwise("plain")
    )


def is_aggregated(data: Column | str) -> Column:
    return F.substring(_col(data), 1, 4).isin(F.lit(MAGIC_PLAIN), F.lit(MAGIC_DEFLATED))


def checksum_matches(data: Column | str) -> Column:
    """Whether an undeflated aggregate's trailer is the MD5 of its body."""
    data = _col(data)
    body_len = F.length(data) - 4 - DIGEST_BYTES
    body = data.substr(F.lit(5), body_len)
    trailer = data.substr(body_len + 5, F.lit(DIGEST_BYTES))
    return (body_len >= 0) & (F.md5(body) == F.lower(F.hex(trailer)))


def verify_checksum(data: Column | str) -> Column:
    """``data`` itself; fails the query where an undeflated aggregate is damaged."""
    data = _col(data)
    bad = (record_format(data) == "aggregated") & ~checksum_matches(data)
    return F.when(bad, F.raise_error(F.lit("checksum of aggregated record does not match"))).otherwise(data)
