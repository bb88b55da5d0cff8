"""Daily files of raw readings: whitespace text, one line a reading, checked and refused line by line with a reason.

A file's order rules (no instant before the last accepted one, one accepted reading a pair and epoch) depend on what was
accepted before, so the lines that pass the checks of form go through a fold a file; a day's file is its bound. Everything
else is column functions, and refused lines stay in the result with their reason.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import PERIOD_PS
from ..functions.timefn import EPOCH_US, epoch_of_us, mjd_to_us

LATE_US = 10_000_000
FILE_NAME = r"cd5m5m_(\d+)\.dat$"
READINGS = "file string, day long, line_no long, mjd double, measured_us long, epoch long, delta_us long, ref string, clock string, phase int, rms int, reason string"
_COLUMNS = ("mjd", "phase", "rms", "switch", "clock")
#: Patterns of the five columns of a line.
_PATTERNS = {"mjd": r"^\d{5}\.\d{6}$", "phase": r"^\d{1,6}$", "rms": r"^\d{1,4}$", "switch": r"^[0-9][A-Z][0-9]{2}$", "clock": r"^\S+$"}


def lines(spark: SparkSession, folder: str, from_day: int | None = None) -> DataFrame:
    """file, day, line_no and value of every line of the day files; files of earlier days are not opened.

    A file whose last line is not ended is an error.
    """
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "cd5m5m_*.dat").load(folder)
    named = files.select(F.col("_metadata.file_name").alias("file"), "value").withColumn("day", F.regexp_extract("file", FILE_NAME, 1).cast("long"))
    kept = named.where(F.col("day") >= from_day) if from_day is not None else named
    checked = F.when(F.col("value") == "", F.array().cast("array<string>")).when(F.col("value").endswith("\n"), F.split(F.expr("left(value, length(value) - 1)"), "\n")).otherwise(F.raise_error(F.concat("file", F.lit(": the last line is not ended"))))
    return kept.select("file", "day", F.posexplode(checked).alias("at", "value")).select("file", "day", (F.col("at") + 1).cast("long").alias("line_no"), "value")


def parse(text: DataFrame, skip_reference: str | None = None) -> DataFrame:
    """READINGS of every line, with the reason why it is refused: form, then range, day, lateness, order and copies."""
    part = F.split(F.trim("value"), r"\s+")
    cells = text.select("file", "day", "line_no", part.alias("cells"), *(F.get(part, i).alias(n) for i, n in enumerate(_COLUMNS)))
    form: Column = F.size("cells") == len(_COLUMNS)
    for name, pattern in _PATTERNS.items():
        form = form & F.coalesce(F.col(name).rlike(pattern), F.lit(False))
    typed = cells.select("file", "day", "line_no", form.alias("form"), F.col("mjd").try_cast("double").alias("mjd"), F.col("phase").try_cast("int").alias("phase"), F.col("rms").try_cast("int").alias("rms"), F.concat(F.lit("mc"), F.substring("switch", 1, 1)).alias("ref"), "clock")
    us = mjd_to_us(F.col("mjd"))
    timed = typed.withColumn("measured_us", us).withColumn("epoch", epoch_of_us(us)).withColumn("delta_us", us - epoch_of_us(us) * EPOCH_US)
    used = timed.where(~F.col("form") | (F.col("ref") != skip_reference)) if skip_reference else timed
    late = EPOCH_US - F.col("delta_us") <= LATE_US
    reason = F.when(~F.col("form"), "malformed").when(F.col("phase") >= PERIOD_PS, "phase out of range").when(F.floor("mjd") != F.col("day"), "wrong day").when(late, "late")
    first = used.select(*(c.split()[0] for c in READINGS.split(", ")[:-1]), reason.alias("reason"))
    return first.groupBy("file").applyInArrow(_in_order, READINGS)


def _in_order(table: pa.Table) -> pa.Table:
    """Refuse what goes back in time or repeats a pair in an epoch; only accepted lines count."""
    table = table.sort_by("line_no")
    last, seen, reasons = None, set(), []
    for us, epoch, ref, clock, reason in zip(*(table.column(c).to_pylist() for c in ("measured_us", "epoch", "ref", "clock", "reason")), strict=True):
        if reason is None and last is not None and us < last:
            reason = "out of order"
        elif reason is None and (epoch, ref, clock) in seen:
            reason = "duplicate"
        if reason is None:
            last = us
            seen.add((epoch, ref, clock))
        reasons.append(reason)
    return table.set_column(table.column_names.index("reason"), "reason", pa.array(reasons, pa.string()))


def render(readings: DataFrame) -> DataFrame:
    """The lines (column value) that such readings are parsed from."""
    switch = F.concat(F.substring("ref", 3, 1), F.lit("A00"))
    return readings.select(F.format_string("%12.6f %6d %4d %4s %s", "mjd", "phase", "rms", switch, "clock").alias("value"))
