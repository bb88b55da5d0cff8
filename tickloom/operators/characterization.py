"""From archive rows to noise models: stretches, unusable days, values at the epoch's start, outliers, jumps, drift and the fit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import EPOCH_S
from ..sources.staging import staged
from . import medians, noise, series, summary

SERIES = ("channel", "clock", "ref", "stretch")


def to_epoch_start(values: DataFrame, offsets: DataFrame, keys: Sequence[str], of: Sequence[str], value: str = "value") -> DataFrame:
    """values less rate times the measurement's own offset from its epoch's start; a row without an offset goes.

    offsets has (*of, epoch, offset_s), of being some of keys. The rate is the median one-epoch change over an epoch's length;
    a series with no two neighbouring epochs stays as it is.
    """
    rates = medians.exact_median(series.one_epoch_changes(values, keys, value, raw=False), keys, "change", "_typical")
    moved = values.join(rates, list(keys), "left").join(offsets.select(*of, "epoch", "offset_s"), [*of, "epoch"])
    return moved.withColumn(value, F.col(value) - F.coalesce(F.col("_typical") / EPOCH_S * F.col("offset_s"), F.lit(0.0))).select(*values.columns)


def prepared(triples: DataFrame, offsets: DataFrame, drifting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Values (channel, clock, ref, piece, epoch, value) fit for Allan sums, and channel, clock and days_dropped.

    triples are archive rows, of which the local ones (r = s) of clocks count; offsets has (channel, ref, clock, epoch,
    offset_s) of the pairs; the clocks in drifting (clock) have each piece's parabola taken off.
    """
    keys = list(SERIES)
    local = triples.where((F.col("r") == F.col("s")) & (F.col("r") != F.col("c")))
    named = local.select("channel", F.col("c").alias("clock"), F.col("r").alias("ref"), "epoch", "z", "step_offset", "flags")
    started = series.cold_start_stretches(named, ["channel", "clock", "ref"]).where("value IS NOT NULL")
    values = staged(started.withColumn("value", F.col("value").cast("double")), "stretches")
    limits = staged(series.day_limits(series.one_epoch_changes(values, keys, "value", raw=False), keys), "limits")
    dropped = limits.where((F.col("mad") > series.NO_SIGNAL_PS) | (F.abs("med") > series.FAR_OFF_PS)).groupBy("channel", "clock").agg(F.count(F.lit(1)).alias("days_dropped"))
    usable = staged(series.drop_unusable_days(values, limits, keys), "usable")
    moved = staged(to_epoch_start(usable, offsets, keys, ["channel", "ref", "clock"]), "moved")
    clean = staged(series.drop_outliers(moved, series.day_limits(series.one_epoch_changes(moved, keys, "value", raw=False), keys), keys, "value", raw=False), "clean")
    split = series.split_at_jumps(clean, series.day_limits(series.one_epoch_changes(clean, keys, "value", raw=False), keys), keys, "value")
    pieces = staged(split.select("channel", "clock", "ref", F.concat_ws(".", "stretch", "piece").alias("piece"), "epoch", "value"), "pieces")
    flat = noise.remove_drift(pieces.join(drifting, "clock", "left_semi"), ["channel", "clock", "ref", "piece"])
    return pieces.join(drifting, "clock", "left_anti").unionByName(flat), dropped


def models(triples: DataFrame, offsets: DataFrame, drifting: DataFrame, least_rows: int) -> DataFrame:
    """channel, clock, refs, rows, days_dropped and the noise model of each clock with a local triple; null where it has too few rows."""
    values, dropped = prepared(triples, offsets, drifting)
    name = F.concat_ws("/", "channel", "clock")
    fitted = noise.characterize(values.select(name.alias("clock"), "ref", "piece", "epoch", "value"), least_rows).withColumnRenamed("clock", "_name")
    counted = values.groupBy("channel", "clock").agg(F.count(F.lit(1)).alias("rows"))
    known = summary.local_references_of(triples).join(counted, ["channel", "clock"], "left").join(dropped, ["channel", "clock"], "left")
    filled = known.fillna(0, ["rows", "days_dropped"]).withColumn("_name", name)
    return filled.join(fitted, "_name", "left").drop("_name")
