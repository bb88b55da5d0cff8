"""Stretches in which a clock's readings keep being rejected, and stretches shared by many clocks, a reference's fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import series


def inside(rows: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the span (start, end) that holds their epoch: an equality join on the days that a span touches."""
    days = spans.withColumn("_day", F.explode(F.sequence(series.day_of_epoch(F.col("start")), series.day_of_epoch(F.col("end") - 1))))
    return rows.withColumn("_day", series.day_of_epoch(F.col("epoch"))).join(days, [*keys, "_day"]).where((F.col("epoch") >= F.col("start")) & (F.col("epoch") < F.col("end"))).drop("_day")


def _single(epochs: DataFrame, *keys: str) -> DataFrame:
    return epochs.select(*keys, F.col("epoch").alias("start"), (F.col("epoch") + 1).alias("end"), F.lit(False).alias("open_ended"))


def bursts(rejections: DataFrame, least_epochs: int, least_share: float) -> DataFrame:
    """clock, start, end, rejections, rejected_epochs of spans of at least so many epochs, of which a least share has a rejection."""
    counts = rejections.groupBy("clock", "epoch").agg(F.count(F.lit(1)).alias("n"))
    spans = series.joined_spans(_single(counts, "clock"), ["clock"], least_epochs)
    held = inside(counts, spans, ["clock"]).groupBy("clock", "start", "end").agg(F.sum("n").alias("rejections"), F.count(F.lit(1)).alias("rejected_epochs"))
    length = F.col("end") - F.col("start")
    return held.where((length >= least_epochs) & (F.col("rejected_epochs") >= least_share * length))


def reject_stretches(rejections: DataFrame, disabled: DataFrame, least_epochs: int = 36, least_share: float = 0.3, shared_clocks: int = 4) -> DataFrame:
    """clock, start, end, open_ended, rejections, rejected_epochs and replaced (disabled spans taken in).

    Epochs in which many clocks are rejected are left out. disabled has (clock, start, end, open_ended).
    """
    shared = series.shared_epochs(rejections, "clock", shared_clocks)
    found = bursts(rejections.join(shared, "epoch", "left_anti"), least_epochs, least_share)
    spans = series.joined_spans(found.select("clock", "start", "end", F.lit(False).alias("open_ended")).unionByName(disabled), ["clock"], least_epochs)
    by_start = lambda df, *more: df.select("clock", F.col("start").alias("epoch"), *more)
    of_bursts = inside(by_start(found, "rejections", "rejected_epochs"), spans, ["clock"]).groupBy("clock", "start").agg(F.sum("rejections").alias("rejections"), F.sum("rejected_epochs").alias("rejected_epochs"))
    of_disabled = inside(by_start(disabled), spans, ["clock"]).groupBy("clock", "start").agg(F.count(F.lit(1)).alias("replaced"))
    joined = spans.join(of_bursts, ["clock", "start"]).join(of_disabled, ["clock", "start"], "left")
    return joined.select("clock", "start", "end", "open_ended", "rejections", "rejected_epochs", F.coalesce("replaced", F.lit(0)).alias("replaced"))


def shared_stretches(rejections: DataFrame, least_epochs: int = 36, shared_clocks: int = 4) -> DataFrame:
    """start, end, most_clocks, reference, through_reference and rejections of spans in which many clocks are rejected at once.

    rejections has refs, an array of names; the reference is the most frequent, the least name where several are.
    """
    epochs = series.shared_epochs(rejections, "clock", shared_clocks)
    spans = series.joined_spans(_single(epochs.withColumn("all", F.lit(0)), "all"), ["all"], least_epochs)
    held = inside(rejections.withColumn("all", F.lit(0)), spans, ["all"])
    most = held.groupBy("start", "end", "epoch").agg(F.countDistinct("clock").alias("n")).groupBy("start", "end").agg(F.max("n").alias("most_clocks"))
    through = series.top_name(held.select("start", "end", F.explode(F.array_distinct("refs")).alias("reference")), ["start", "end"], "reference").withColumnRenamed("n", "through_reference")
    total = held.groupBy("start", "end").agg(F.count(F.lit(1)).alias("rejections"))
    return most.join(through, ["start", "end"]).join(total, ["start", "end"])
