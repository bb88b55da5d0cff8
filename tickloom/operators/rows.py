"""Predicates over the flags and fields of a series' rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags in the order in which a row holds them: accepted, rejected, excluded, predicted, off, dormant, slip, new, unsettled.
FLAGS = "ARXPODSNU"


def valid_flags(flags: Column) -> Column:
    return flags.rlike("^" + "".join(f"{f}?" for f in FLAGS) + "$")


def is_written(flags: Column) -> Column:
    """A dormant row without a measurement is not written."""
    return ~(flags.contains("D") & flags.contains("P"))


def is_usable(flags: Column) -> Column:
    """Accepted and settled: the rows whose step-free phase is z less the step offset."""
    return flags.contains("A") & ~flags.contains("U")


def in_gate(nu: Column, scale: Column) -> Column:
    return F.abs(nu) <= 5.0 * scale


def in_rms_limit(rms: Column, limit: Column) -> Column:
    return F.coalesce(rms <= limit, F.lit(True))
