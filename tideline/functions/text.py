"""Log-text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Log lines of the consumer daemon that carry no information.
DAEMON_NOISE = (
    "^INFO: Received response ",
    "^INFO: Starting: Reading next message from STDIN ",
    "^INFO: Writing ProcessRecordsMessage to child process ",
    "^INFO: Message size == (40|63) bytes for shard ",
    "com.amazonaws.services.kinesis.multilang.MultiLangProtocol validateStatusMessage$",
    "com.amazonaws.services.kinesis.multilang.MessageWriter writeMessage$",
    "com.amazonaws.services.kinesis.multilang.MessageWriter call$",
    "com.amazonaws.services.kinesis.multilang.LineReaderTask call$",
)


def is_noise(line: Column | str, patterns: Sequence[str] = DAEMON_NOISE) -> Column:
    """True for an empty line or one any pattern matches."""
    line = F.col(line) if isinstance(line, str) else line
    noise = line == ""
    if patterns:
        noise = noise | line.rlike("|".join(f"(?:{p})" for p in patterns))
    return noise


def keep_lines(df: DataFrame, text: str, patterns: Sequence[str] = DAEMON_NOISE, line: str = "line") -> DataFrame:
    """One row per informative line of ``text``; the other columns are kept."""
    lines = df.withColumn(line, F.explode(F.split(F.col(text), "\n"))).drop(text)
    return lines.filter(~is_noise(line, patterns))
