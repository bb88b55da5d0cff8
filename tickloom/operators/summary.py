"""Small reports over archives and stretches: who measures whom, rows an epoch, names of series, and lines of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import epoch_to_mjd_text
from . import links, rows

EPOCHS_PER_HOUR = 6


def series_name(channel: Column, names: Sequence[Column]) -> Column:
    """The name of a pair's or a triple's series, as its file has it."""
    return F.concat(F.lit("das_"), channel, F.lit("."), F.concat_ws(".", *names))


def references_of(pairs: DataFrame, skipped: Sequence[str] = ()) -> DataFrame:
    """channel, clock and refs, the sorted references that measure it; references and names that begin with a skipped text are no clocks."""
    kept = pairs.where(links.is_reference(F.col("ref")) & ~links.is_reference(F.col("clock")))
    for prefix in skipped:
        kept = kept.where(~F.col("clock").startswith(prefix))
    return _collected(kept)


def local_references_of(triples: DataFrame) -> DataFrame:
    """channel, clock and refs with a local triple (r, r, clock); references are no clocks."""
    local = triples.where((F.col("r") == F.col("s")) & ~links.is_reference(F.col("c")))
    return _collected(local.select("channel", F.col("r").alias("ref"), F.col("c").alias("clock")))


def _collected(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("channel", "clock").agg(F.array_sort(F.collect_set("ref")).alias("refs"))


def epoch_counts(pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """channel, epoch, pairs, triples, accepted and held: rows that are written, those of them that are accepted, and the rest."""
    told = lambda df, kind: df.select("channel", "epoch", "flags", F.lit(kind).alias("kind"))
    written = told(pairs, "pair").unionByName(told(triples, "triple")).where(rows.is_written(F.col("flags")))
    accepted = F.col("flags").contains("A")
    return written.groupBy("channel", "epoch").agg(F.count_if(F.col("kind") == "pair").alias("pairs"), F.count_if(F.col("kind") == "triple").alias("triples"), F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("held"))


def _given(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("-"))


def _spans(start: Column, end: Column) -> list[Column]:
    hours = F.format_string("%.1f", (end - start) / EPOCHS_PER_HOUR)
    return [epoch_to_mjd_text(start), F.when(end.isNull(), "-").otherwise(epoch_to_mjd_text(end)), F.when(end.isNull(), "-").otherwise(hours)]


def bad_stretch_lines(stretches: DataFrame, references: DataFrame) -> DataFrame:
    """line: clock, MJD from and to, hours, kind and references of stretches (clock, disabled_from, enabled_at, kind); '-' for none."""
    known = stretches.join(references.select("clock", "refs"), "clock", "left")
    parts = ["clock", *_spans(F.col("disabled_from"), F.col("enabled_at")), _given(F.col("kind")), F.concat_ws(",", "refs")]
    return known.select(F.concat_ws(" ", *parts).alias("line"))


def reject_stretch_lines(stretches: DataFrame) -> DataFrame:
    """line: clock, MJD from and to, hours, rejections, rejected epochs and disabled spans taken in; '-' where a stretch never ends."""
    parts = ["clock", *_spans(F.col("start"), F.when(~F.col("open_ended"), F.col("end"))), *(F.col(c).cast("string") for c in ("rejections", "rejected_epochs", "replaced"))]
    return stretches.select(F.concat_ws(" ", *parts).alias("line"))


def shared_stretch_lines(stretches: DataFrame) -> DataFrame:
    """line: MJD from and to, hours, most clocks at once, the reference, rejections through it and all rejections."""
    parts = [*_spans(F.col("start"), F.col("end")), *(F.col(c).cast("string") for c in ("most_clocks", "reference", "through_reference", "rejections"))]
    return stretches.select(F.concat_ws(" ", *parts).alias("line"))


def model_lines(models: DataFrame) -> DataFrame:
    """line: clock, references, rows, days dropped, noises, the four coefficients, crossover, time constant and gap limit; '-' for none."""
    text = lambda form, name: F.when(F.col(name).isNull(), "-").otherwise(F.format_string(form, name))
    parts = ["clock", F.concat_ws(",", "refs"), *(F.col(c).cast("string") for c in ("rows", "days_dropped")), *(text("%.1f", c) for c in ("noise_ps", "sigma0_ps")), *(text("%.3e", c) for c in ("white", "flicker_phase", "flicker", "walk")), text("%.0f", "crossover_s"), _given(F.col("time_constant")), _given(F.col("gap_limit"))]
    return models.select(F.concat_ws(" ", *parts).alias("line"))
