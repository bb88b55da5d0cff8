"""Steering logs, a file a reference: instant, phase change and rate change. Any bad line is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefn import mjd_to_us

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """ref, applied_us, dx (ps) and dy (ps/s), from files steer_<ref>.dat."""
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "steer_*.dat").load(folder)
    named = files.select(F.regexp_extract("_metadata.file_name", r"^steer_(.+)\.dat$", 1).alias("ref"), F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n")).alias("line_no", "line")).where("line <> ''")
    return parse(named)


def parse(lines: DataFrame) -> DataFrame:
    """ref, applied_us, dx, dy out of (ref, line_no, line); malformed, non-ASCII and backward lines raise."""
    part = F.split(F.trim("line"), r"\s+")
    cell = lambda i: F.get(part, i)
    good = (F.size(part) == 3) & cell(0).rlike(r"^\d+\.\d+$") & cell(1).rlike(_NUMBER) & cell(2).rlike(_NUMBER) & F.col("line").rlike(r"^[\x20-\x7e\t]*$")
    typed = lines.select("ref", "line_no", "line", F.coalesce(good, F.lit(False)).alias("good"), cell(0).try_cast("double").alias("mjd"), cell(1).try_cast("double").alias("dx"), cell(2).try_cast("double").alias("dy"))
    back = F.coalesce(F.col("mjd") < F.lag("mjd").over(Window.partitionBy("ref").orderBy("line_no")), F.lit(False))
    marked = typed.withColumn("back", back)
    told = F.raise_error(F.concat(F.lit("steering of "), "ref", F.lit(", line "), (F.col("line_no") + 1).cast("string"), F.lit(": "), "line"))
    us = F.when(F.col("good") & ~F.col("back"), mjd_to_us(F.col("mjd"))).otherwise(told.cast("long"))
    return marked.select("ref", us.alias("applied_us"), "dx", "dy")


#: What is known of each file that was read: whole lines of it by bytes and digest, and its last instant.
STATE = "ref string, size long, digest string, n_lines long, last_us long"


def increment(spark: SparkSession, folder: str, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(ref, action, applied_us, dx, dy) of what is new since a known STATE, and the STATE after it.

    A file that begins with all that was read of it is 'appended' to: only its further lines are parsed, and none of them may lie
    before the last one read. Any other file is 'replaced', shrunk ones too: all its lines are new and the earlier events of
    its reference no longer hold. A file that is gone or empty is 'replaced' by a row without an event, and then unknown. A last line that is not ended
    yet waits for the next call. Events and STATE come of one reading of the files, so stage them together.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "steer_*.dat").load(folder)
    text = files.select(F.regexp_extract("_metadata.file_name", r"^steer_(.+)\.dat$", 1).alias("ref"), F.decode("content", "ISO-8859-1").alias("text"))  # a byte a character
    last = F.instr(F.reverse("text"), "\n")
    whole = text.select("ref", F.when(last > 0, F.left("text", F.length("text") - last + 1)).otherwise("").alias("text"))
    before = (known if known is not None else spark.createDataFrame([], STATE)).select("ref", *(F.col(c).alias(f"_{c}") for c in ("size", "digest", "n_lines", "last_us")))
    both = whole.join(before, "ref", "full")
    begins = (F.length("text") >= F.col("_size")) & (F.sha2(F.encode(F.left("text", F.col("_size").cast("int")), "ISO-8859-1"), 256) == F.col("_digest"))
    goes_on = F.coalesce(begins, F.lit(False))
    told = both.withColumn("action", F.when(goes_on, "appended").otherwise("replaced"))
    fresh = told.withColumn("_new", F.when(goes_on, F.expr("substring(text, cast(_size as int) + 1)")).otherwise(F.coalesce("text", F.lit(""))))
    lines = fresh.select("ref", "action", "_last_us", F.coalesce(F.when(F.col("action") == "appended", F.col("_n_lines")), F.lit(0)).alias("_from"), F.posexplode(F.split(F.regexp_replace("_new", r"\n$", ""), "\n")).alias("at", "line")).where("line <> ''")
    events = parse(lines.select("ref", (F.col("at") + F.col("_from")).alias("line_no"), "line")).join(fresh.select("ref", "action", "_last_us"), "ref")
    back = (F.col("action") == "appended") & F.coalesce(F.col("applied_us") < F.col("_last_us"), F.lit(False))
    us = F.when(back, F.raise_error(F.concat(F.lit("steering of "), "ref", F.lit(": a line goes back before what was read"))).cast("long")).otherwise(F.col("applied_us"))
    emptied = fresh.where("action = 'replaced' AND _size > 0 AND _new = ''").select("ref", "action", F.lit(None).cast("long").alias("applied_us"), *(F.lit(None).cast("double").alias(c) for c in ("dx", "dy")))
    changes = events.select("ref", "action", us.alias("applied_us"), "dx", "dy").unionByName(emptied)
    newest = events.groupBy("ref").agg(F.max("applied_us").alias("_newest"))
    kept = fresh.where("text IS NOT NULL").join(newest, "ref", "left")
    size = F.length("text").cast("long")
    state = kept.select("ref", size.alias("size"), F.sha2(F.encode("text", "ISO-8859-1"), 256).alias("digest"), (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("n_lines"), F.coalesce("_newest", F.when(F.col("action") == "appended", F.col("_last_us"))).alias("last_us"))
    return changes, state


def applied(events: DataFrame, changes: DataFrame) -> DataFrame:
    """All events (ref, applied_us, dx, dy) that hold after changes: those of replaced references give way."""
    gone = changes.where("action = 'replaced'").select("ref").distinct()
    return events.join(gone, "ref", "left_anti").unionByName(changes.where("applied_us IS NOT NULL").drop("action"))
