"""Column functions for instants, Modified Julian Dates and ten-minute epochs.

Doubles keep one fixed order of operations; instants are whole microseconds since 1970 in UTC, whatever the session's time
zone is, and rounding is half to even (rint).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_S = 600
EPOCH_US = EPOCH_S * 1_000_000
DAY_S = 86_400
EPOCHS_PER_DAY = DAY_S // EPOCH_S
MJD_1970 = 40_587
JD_1970 = 2_440_587.5
JD_OF_MJD_0 = 2_400_000.5


def unix_us(timestamp: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, taken as UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), timestamp.cast("timestamp_ntz"))


def unix_to_mjd(seconds: Column) -> Column:
    return seconds / F.lit(float(DAY_S)) + F.lit(float(MJD_1970))


def mjd_to_unix(mjd: Column) -> Column:
    return (mjd - F.lit(float(MJD_1970))) * F.lit(float(DAY_S))


def unix_to_jd(seconds: Column) -> Column:
    return seconds / F.lit(float(DAY_S)) + F.lit(JD_1970)


def jd_to_unix(jd: Column) -> Column:
    return (jd - F.lit(JD_1970)) * F.lit(float(DAY_S))


def mjd_to_jd(mjd: Column) -> Column:
    return mjd + F.lit(JD_OF_MJD_0)


def jd_to_mjd(jd: Column) -> Column:
    return jd - F.lit(JD_OF_MJD_0)


def us_to_mjd(us: Column) -> Column:
    return unix_to_mjd(us / F.lit(1e6))


def mjd_to_us(mjd: Column) -> Column:
    """Whole microseconds, half to even."""
    return F.rint(mjd_to_unix(mjd) * F.lit(1e6)).cast("long")


def us_to_timestamp(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_of_us(us: Column) -> Column:
    """Ten-minute marks since 1970 at or before an instant."""
    return F.floor(us / F.lit(EPOCH_US)).cast("long")


def next_epoch_of_us(us: Column) -> Column:
    return epoch_of_us(us) + 1


def epoch_of_mjd(mjd: Column) -> Column:
    """Epochs of the MJD calendar nearest to an MJD."""
    return F.rint(mjd * EPOCHS_PER_DAY).cast("long")


def epoch_to_mjd_text(epoch: Column) -> Column:
    """MJD of an epoch's start to six decimals, rounded down."""
    days = F.floor(epoch / EPOCHS_PER_DAY).cast("long")
    millionths = F.floor(F.pmod(epoch, F.lit(EPOCHS_PER_DAY)) * 1_000_000 / EPOCHS_PER_DAY).cast("string")
    return F.concat(days.cast("string"), F.lit("."), F.lpad(millionths, 6, "0"))
