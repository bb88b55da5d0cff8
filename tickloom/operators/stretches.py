"""Stretches in which a clock does not run properly, on which every reference that measures it agrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MAD_TO_SIGMA, median_of, wrapped
from ..sources.staging import staged
from . import medians, rejects, series
from .series import DISAGREEING_PS, FAR_OFF_PS, HALF_WINDOW, LEAST_CHANGES, LEAST_COMPARED, OUTLIER_SPREADS


def _refined(spans: DataFrame, changes: DataFrame, edge: str) -> DataFrame:
    """For each span and reference: the straying change nearest to what the verdicts blurred, or the span's own edge.

    At a start the good changes are those two half windows before the edge and the first straying one counts; at an end,
    those after it and the last one. A span has 49 epochs near an edge, so this is an equality join.
    """
    at_start = edge == "start"
    base = F.col("start") - HALF_WINDOW if at_start else F.col("end") - 1 + HALF_WINDOW
    low, high = (base - 2 * HALF_WINDOW, F.col("start") + HALF_WINDOW) if at_start else (F.col("end") - 2 - HALF_WINDOW + 1, base + 2 * HALF_WINDOW)
    near = spans.select("clock", "start", "end", "open_ended", base.alias("base"), F.explode(F.sequence(low, high)).alias("epoch"))
    found = near.join(changes, ["clock", "epoch"])
    is_good = F.col("epoch") < F.col("base") if at_start else F.col("epoch") > F.col("base")
    good = F.sort_array(F.collect_list(F.when(is_good, F.col("change"))))
    tried = F.collect_list(F.when(~is_good, F.struct("epoch", "change")))
    grouped = found.groupBy("clock", "ref", "start", "end", "open_ended").agg(good.alias("good"), tried.alias("tried"))
    med = grouped.withColumn("med", median_of(F.col("good")))
    spread = med.withColumn("mad", median_of(F.sort_array(F.transform("good", lambda c: F.abs(c - F.col("med"))))))
    stray: Column = F.transform(F.filter("tried", lambda t: F.abs(t["change"] - F.col("med")) > OUTLIER_SPREADS * MAD_TO_SIGMA * F.col("mad")), lambda t: t["epoch"])
    place = F.array_min(stray) if at_start else F.array_max(stray)
    own = F.coalesce(F.when(F.size("good") >= LEAST_CHANGES, place), F.col(edge))
    best = (F.min if at_start else F.max)(own).alias(f"new_{edge}")
    return spread.groupBy("clock", "start", "end", "open_ended").agg(best)


def refine(spans: DataFrame, changes: DataFrame) -> DataFrame:
    """Spans with both ends found again: the earliest start and the latest end that any reference gives."""
    keys = ["clock", "start", "end", "open_ended"]
    both = spans.join(_refined(spans, changes, "start"), keys, "left").join(_refined(spans, changes, "end"), keys, "left")
    return both.select("clock", F.coalesce("new_start", "start").alias("start"), F.coalesce("new_end", "end").alias("end"), "open_ended")


def kinds(spans: DataFrame, changes: DataFrame) -> DataFrame:
    """Spans with kind: no_signal where references disagree, far_off, quartz, or null where they cannot be compared.

    A span may be as long as a series, so medians over it are found by counted ranges; one of an epoch has a row a reference.
    """
    inside = staged(rejects.inside(changes, spans, ["clock"]).select("clock", "start", "end", "epoch", "ref", "change"), "inside")
    by_epoch = inside.groupBy("clock", "start", "end", "epoch").agg(F.array_sort(F.collect_list(F.struct("ref", "change"))).alias("at")).where(F.size("at") >= LEAST_COMPARED)
    relative = by_epoch.withColumn("rel", F.sort_array(F.transform("at", lambda c: wrapped(c["change"] - F.col("at")[0]["change"]))))
    med = relative.withColumn("med", median_of(F.col("rel")))
    apart = med.withColumn("mad", median_of(F.sort_array(F.transform("rel", lambda c: F.abs(c - F.col("med"))))))
    span = ["clock", "start", "end"]
    spread = medians.exact_median(staged(apart.select(*span, "mad"), "spreads"), span, "mad", "spread")
    by_ref = medians.exact_median(inside, [*span, "ref"], "change", "size")
    moved = by_ref.groupBy(*span).agg(F.median(F.abs("size")).alias("typical"))
    known = spans.join(spread, ["clock", "start", "end"], "left").join(moved, ["clock", "start", "end"], "left")
    kind = F.when(F.col("spread") > DISAGREEING_PS, "no_signal").when(F.coalesce("typical", F.lit(0.0)) > FAR_OFF_PS, "far_off").when(F.col("spread").isNotNull(), "quartz")
    return known.select("clock", "start", "end", "open_ended", kind.alias("kind"))


def bad_stretches(changes: DataFrame, least_epochs: int) -> DataFrame:
    """clock, disabled_from, enabled_at (null where it never ends) and kind, from changes (ref, clock, epoch, change)."""
    changes = staged(changes, "changes")
    spreads = staged(series.sliding_spread(changes, ["ref", "clock"]), "spreads")
    judged = series.verdicts(spreads, ["ref", "clock"])
    coarse = series.joined_spans(series.runs(series.agreed(judged, ["clock"]), ["clock"]), ["clock"], least_epochs)
    coarse = staged(coarse, "spans")
    fine = staged(series.joined_spans(refine(coarse, changes), ["clock"], least_epochs).where(F.col("end") - F.col("start") >= least_epochs), "spans")
    return kinds(fine, changes).select("clock", F.col("start").alias("disabled_from"), F.when(~F.col("open_ended"), F.col("end")).alias("enabled_at"), "kind")
