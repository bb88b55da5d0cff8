"""Archives kept as text, a file a series: fixed-width rows of pairs and triples, read by slices and written back.

Spark's text source cuts large files at line ends, so a file is no bound of a task. A column is a slice of the line, cut out
only if something reads it: two columns of a wide row cost two slices. Header lines start with '#'. Numbers keep their text's
value exactly: phases in femtoseconds as whole numbers; a double is written with the fewest digits that give it back, filled up to 17
with zeros, so its value is kept while another writer's last digits may differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import EPOCH_US, EPOCHS_PER_DAY, MJD_1970, epoch_to_mjd_text, us_to_mjd, us_to_timestamp

# Fixed values of the format: names and widths of the columns in order, and what stands between them.
SEPARATOR = ", "
_EPOCH = (("interpolated_datetime", 25), ("interpolated_mjd", 13))
_STATE = (
    ("x", 20), ("y", 23), ("d", 23), ("innovation_scale", 23), ("step_offset", 16), ("epochs_in_segment", 9), ("epochs_since_accept", 9),
    ("consecutive_rejects", 9), ("reject_fraction", 23), ("reject1_mjd", 13), ("reject1_innovation", 23), ("reject2_mjd", 13),
    ("reject2_innovation", 23), ("reject3_mjd", 13), ("reject3_innovation", 23), ("filter_states", 1), ("time_constant", 23),
    ("scale_time_constant", 23), ("flags", 8),
)
COLUMNS = {
    "meas": (*_EPOCH, ("measurement_datetime", 32), ("measurement_mjd", 13), ("measured_phase", 6), ("rms", 4), ("cycle_count", 12), ("z", 16), *_STATE),
    "ddiff": (*_EPOCH, ("z", 16), ("innovation", 23), ("double_difference_sigma", 23), ("components_used", 3), *_STATE),
}
WHOLE = ("step_offset", "epochs_in_segment", "epochs_since_accept", "consecutive_rejects", "filter_states", "measured_phase", "rms", "cycle_count", "z")
REAL = ("y", "d", "innovation", "innovation_scale", "double_difference_sigma", "reject_fraction", "time_constant", "scale_time_constant")
NAMES = {"meas": ("ref", "clock"), "ddiff": ("r", "s", "c")}


def _slices(kind: str) -> dict[str, tuple[int, int]]:
    found, at = {}, 1
    for name, width in COLUMNS[kind]:
        found[name] = (at, width)
        at += width + len(SEPARATOR)
    return found


def width(kind: str) -> int:
    return sum(w + len(SEPARATOR) for _, w in COLUMNS[kind]) - len(SEPARATOR)


def _field(kind: str, name: str) -> Column:
    """A column's text, null where it is blank."""
    return F.nullif(F.trim(F.substring("value", *_slices(kind)[name])), F.lit(""))


def mark(mjd: Column) -> Column:
    """The ten-minute mark, counted from 1970, nearest to an MJD."""
    return (F.rint(mjd.cast("double") * EPOCHS_PER_DAY) - MJD_1970 * EPOCHS_PER_DAY).cast("long")


def _femtoseconds(text: Column) -> Column:
    return F.when(text.rlike(r"^-?\d+\.\d{3}$"), F.replace(text, F.lit("."), F.lit("")).cast("long")).when(text.isNotNull(), F.raise_error(F.concat(F.lit("phase without three decimals: "), text)).cast("long"))


def _typed(kind: str, name: str) -> Column:
    text = _field(kind, name)
    return text.cast("long") if name in WHOLE else text.cast("double") if name in REAL else text


def lines(spark: SparkSession, folder: str, kind: str, channel: str) -> DataFrame:
    """channel, the series' names and the line of every row of a channel's files; a row of another width is an error."""
    text = spark.read.text(folder, pathGlobFilter=f"das_{channel}.*.dat").where(~F.col("value").startswith("#"))
    part = F.split(F.regexp_extract("_metadata.file_name", r"^das_[^.]+\.(.+)\.dat$", 1), r"\.")
    sound = F.when(F.length("value") == width(kind), F.col("value")).otherwise(F.raise_error(F.concat("_metadata.file_name", F.lit(": a row is not as wide as its columns: "), "value")))
    names = NAMES[kind]
    return text.where(F.size(part) == len(names)).select(F.lit(channel).alias("channel"), *(F.get(part, i).alias(n) for i, n in enumerate(names)), sound.alias("value"))


def decode(text: DataFrame, kind: str, epochs: tuple[int, int] | None = None) -> DataFrame:
    """Typed rows of lines, by series: epoch, the kind's measurement and the state; of [first, last] epochs where they are given.

    measured_us and offset_s (the measurement's instant, and its seconds after the epoch's start) are null where nothing was
    measured. buffer holds the one to three rejected (epoch, value); x_fs is in femtoseconds. A value of another form is an error.
    """
    names, epoch = NAMES[kind], mark(_field(kind, "interpolated_mjd"))
    kept = text if epochs is None else text.where(epoch.between(*epochs))
    buffer = F.filter(F.array(*(F.struct(mark(_field(kind, f"reject{i}_mjd")).alias("epoch"), _field(kind, f"reject{i}_innovation").cast("double").alias("value")) for i in (1, 2, 3))), lambda b: b["epoch"].isNotNull() | b["value"].isNotNull())
    at = F.unix_micros(_field(kind, "measurement_datetime").cast("timestamp")) if kind == "meas" else None
    measured = [] if at is None else [at.alias("measured_us"), ((at - epoch * EPOCH_US) / F.lit(1e6)).alias("offset_s")]
    given = {n for n, _ in COLUMNS[kind]}
    plain = [_typed(kind, n).alias(n) for n, _ in COLUMNS[kind] if n in WHOLE + REAL]
    used = [_field(kind, "components_used").alias("components_used")] if "components_used" in given else []
    return kept.select("channel", *names, epoch.alias("epoch"), *measured, *used, *plain, _femtoseconds(_field(kind, "x")).alias("x_fs"), buffer.alias("buffer"), F.coalesce(_field(kind, "flags"), F.lit("")).alias("flags"))


def offsets(spark: SparkSession, folder: str, channel: str) -> DataFrame:
    """channel, ref, clock, epoch and offset_s of every row with a measurement."""
    return decode(lines(spark, folder, "meas", channel), "meas").where("offset_s IS NOT NULL").select("channel", "ref", "clock", "epoch", "offset_s")


def phases(spark: SparkSession, folder: str, channel: str) -> DataFrame:
    """channel, ref, clock, epoch and the raw phase of every row that has one."""
    return decode(lines(spark, folder, "meas", channel), "meas").where("measured_phase IS NOT NULL").select("channel", "ref", "clock", "epoch", F.col("measured_phase").alias("phase"))


def _instant(us: Column, form: str) -> Column:
    return F.concat(F.date_format(us_to_timestamp(us), form), F.lit("+00:00"))


def encode(rows: DataFrame, kind: str) -> DataFrame:
    """rows with value, the line that decode reads them from; a value wider than its column is an error."""
    start = F.col("epoch") * EPOCH_US
    real = lambda c: F.format_string("%+.16e", c)
    mjd = lambda epoch: epoch_to_mjd_text(epoch + MJD_1970 * EPOCHS_PER_DAY)
    x = F.concat(F.when(F.col("x_fs") < 0, "-").otherwise(""), F.floor(F.abs("x_fs") / 1000).cast("string"), F.lit("."), F.lpad((F.abs("x_fs") % 1000).cast("string"), 3, "0"))
    text = {"interpolated_datetime": _instant(start, "yyyy-MM-dd HH:mm:ss"), "interpolated_mjd": mjd(F.col("epoch")), "x": x, "flags": F.col("flags")}
    if kind == "meas":
        text |= {"measurement_datetime": _instant(F.col("measured_us"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), "measurement_mjd": F.format_string("%.6f", us_to_mjd(F.col("measured_us")))}
    else:
        text |= {"components_used": F.col("components_used")}
    for i in (1, 2, 3):
        b = F.get("buffer", i - 1)
        text |= {f"reject{i}_mjd": mjd(b["epoch"]), f"reject{i}_innovation": F.when(b["value"].isNotNull(), real(b["value"]))}
    cells = []
    for name, wide in COLUMNS[kind]:
        cell = text.get(name, F.col(name).cast("string") if name in WHOLE else F.when(F.col(name).isNotNull(), real(F.col(name))) if name in REAL else None)
        known = F.coalesce(F.when(F.col("measured_us").isNotNull(), cell) if name.startswith("measurement_") else cell, F.lit(""))
        fits = F.when(F.length(known) <= wide, F.lpad(known, wide, " ")).otherwise(F.raise_error(F.concat(F.lit(f"{name} does not fit its column: "), known)))
        cells.append(fits)
    return rows.withColumn("value", F.concat_ws(SEPARATOR, *cells))


def series_columns(kind: str) -> Sequence[str]:
    return ("channel", *NAMES[kind])
