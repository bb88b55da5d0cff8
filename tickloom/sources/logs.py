"""Rejections out of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import EPOCH_US, unix_us


def rejections(lines: DataFrame, channel: str, *keep: str) -> DataFrame:
    """keep, names (of a pair or triple) and epoch of each line (column value) that tells of a rejection on a channel."""
    pattern = rf"\bdas_{channel}\.(\S+) rejected at (\S+):"
    at = F.regexp_extract("value", pattern, 2)
    found = lines.where(F.col("value").rlike(pattern)).select(*keep, F.split(F.regexp_extract("value", pattern, 1), r"\.").alias("names"), F.try_to_timestamp(at).cast("timestamp_ntz").alias("at"))
    return found.where("at IS NOT NULL").select(*keep, "names", F.floor(unix_us(F.col("at")) / EPOCH_US).cast("long").alias("epoch"))
