"""Operators over one value a (key, epoch): changes, robust spread, outliers, islands, sliding verdicts and spans.

Every frame is partitioned by the series' keys and a block of epochs, and blocks are joined by one row each (`blocks`), so no
task holds a series; aggregates by day or epoch combine before the shuffle where the function allows it. Epochs are whole
numbers of ten minutes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import MAD_TO_SIGMA, median_of, wrapped
from ..functions.timefn import EPOCHS_PER_DAY
from . import blocks, medians

NO_SIGNAL_PS, FAR_OFF_PS, NOISY_FACTOR, NOISY_FLOOR_PS = 10_000, 25_000, 10, 5_000
#: Epochs of a series that one group folds.
FOLD_EPOCHS = blocks.BLOCK_EPOCHS
HALF_WINDOW, LEAST_CHANGES, OUTLIER_SPREADS, LEAST_COMPARED, DISAGREEING_PS = 12, 9, 5, 3, 10_000


def first_readings(readings: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each (keys, epoch) by order; only one row a group and task is shuffled."""
    rest = [c for c in readings.columns if c not in (*keys, "epoch", *order)]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return readings.groupBy(*keys, "epoch").agg(first).select(*keys, "epoch", *(f"first.{c}" for c in (*order, *rest)))


def one_epoch_changes(values: DataFrame, keys: Sequence[str], value: str = "phase", raw: bool = True) -> DataFrame:
    """keys, epoch and change: the difference from the epoch before, where both are there; wrapped if the phases are raw whole ones."""
    w = blocks.inside(keys)
    before, change = F.lag("epoch").over(w), F.col(value) - F.lag(value).over(w)
    near = blocks.with_halo(values.select(*keys, "epoch", value), 1, 0)
    return near.select(*keys, "epoch", "_own", before.alias("before"), (wrapped(change) if raw else change).alias("change")).where("_own AND epoch - before = 1").drop("before", "_own")


def folded_scale(values: DataFrame, keys: Sequence[str], value: str, above: float, start: float = 100.0, floor: float = 2.0) -> DataFrame:
    """keys, n, scale and reject_fraction after all of a series' values in order, of which an epoch has one at most.

    A step of the squared scale is max(a s + b, c), one of the fraction is affine; both stay so when composed. So the steps
    of FOLD_EPOCHS epochs become one, wherever they lie, and a series' last group has one row for each such block.
    """
    x, fits = F.col(value), F.col(value).isNotNull()
    step = F.struct("epoch", F.when(fits, 0.875).otherwise(0.0).alias("a"), F.when(fits, 0.125 * x * x).otherwise(0.0).alias("b"), F.lit(floor * floor).alias("c"), F.lit(0.875).alias("p"), F.when(x > above, 0.125).otherwise(0.0).alias("q"), F.lit(1).cast("long").alias("n"))
    none = F.struct(F.lit(0).cast("long").alias("epoch"), F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(float("-inf")).alias("c"), F.lit(1.0).alias("p"), F.lit(0.0).alias("q"), F.lit(0).cast("long").alias("n"))

    def then(f: Column, g: Column) -> Column:
        return F.struct(
            g["epoch"].alias("epoch"), (g["a"] * f["a"]).alias("a"), (g["a"] * f["b"] + g["b"]).alias("b"),
            F.when(g["a"] == 0, F.greatest(g["b"], g["c"])).otherwise(F.greatest(g["a"] * f["c"] + g["b"], g["c"])).alias("c"),
            (g["p"] * f["p"]).alias("p"), (g["p"] * f["q"] + g["q"]).alias("q"), (f["n"] + g["n"]).alias("n"),
        )

    steps = values.select(*keys, F.floor(F.col("epoch") / FOLD_EPOCHS).alias("block"), step.alias("step"))
    composed = F.aggregate(F.array_sort(F.collect_list("step")), none, then)
    blocks = steps.groupBy(*keys, "block").agg(composed.alias("step")).groupBy(*keys).agg(composed.alias("all"))
    scale = F.sqrt(F.greatest(F.col("all.a") * (start * start) + F.col("all.b"), F.col("all.c")))
    return blocks.select(*keys, "all.n", scale.alias("scale"), F.col("all.q").alias("reject_fraction"))


def median_mad(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, n, med and mad (median distance from the median) of each group."""
    med = rows.groupBy(*by).agg(F.median(value).alias("med"), F.count(value).alias("n"))
    apart = rows.join(med, list(by)).groupBy(*by).agg(F.median(F.abs(F.col(value) - F.col("med"))).alias("mad"))
    return med.join(apart, list(by)).select(*by, "n", "med", "mad")


def day_of_epoch(epoch: Column) -> Column:
    return F.floor(epoch / EPOCHS_PER_DAY).cast("long")


def day_limits(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, day, med, mad and limit: how far a change of the day may lie from the median."""
    by_day = changes.withColumn("day", day_of_epoch(F.col("epoch")))
    return median_mad(by_day, [*keys, "day"], "change").withColumn("limit", OUTLIER_SPREADS * MAD_TO_SIGMA * F.col("mad"))


def drop_unusable_days(values: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """values without the days whose changes show no signal or a clock far off; days without changes stay."""
    bad = limits.where((F.col("mad") > NO_SIGNAL_PS) | (F.abs("med") > FAR_OFF_PS)).select(*keys, "day")
    return values.withColumn("day", day_of_epoch(F.col("epoch"))).join(bad, [*keys, "day"], "left_anti").drop("day")


def drop_outliers(values: DataFrame, limits: DataFrame, keys: Sequence[str], value: str = "phase", raw: bool = True) -> DataFrame:
    """values without rows whose changes to both neighbours (or to the only one) go beyond their days' limits in opposite senses."""
    off = F.when(F.abs(F.col("change") - F.col("med")) > F.col("limit"), F.signum(F.col("change") - F.col("med"))).otherwise(0)
    judged = one_epoch_changes(values, keys, value, raw).withColumn("day", day_of_epoch(F.col("epoch"))).join(limits, [*keys, "day"]).select(*keys, "epoch", off.alias("_off"))
    before = judged.withColumnRenamed("_off", "_in")
    after = judged.select(*keys, (F.col("epoch") - 1).alias("epoch"), F.col("_off").alias("_out"))
    near = values.join(before, [*keys, "epoch"], "left").join(after, [*keys, "epoch"], "left")
    both = F.col("_in").isNotNull() & F.col("_out").isNotNull()
    outlier = F.when(both, F.col("_in") * F.col("_out") < 0).otherwise(F.coalesce("_in", "_out", F.lit(0)) != 0)
    return near.where(~outlier).select(*values.columns)


def split_at_jumps(values: DataFrame, limits: DataFrame, keys: Sequence[str], value: str = "phase") -> DataFrame:
    """values with piece: a new one wherever the change from the row before, less the expected, goes beyond its day's limit."""
    stepped = blocks.with_previous(values, keys, [value]).select("*", (F.col(value) - F.col("_before")[value]).alias("_step"), (F.col("epoch") - F.col("_before.epoch")).alias("_gap"), day_of_epoch(F.col("epoch")).alias("day"))
    limited = stepped.join(limits.select(*keys, "day", "med", "limit"), [*keys, "day"], "left")
    jump = F.coalesce((F.abs(F.col("_step") - F.col("_gap") * F.col("med")) > F.col("_gap") * F.col("limit")).cast("int"), F.lit(0))
    return blocks.numbered(limited.withColumn("_jump", jump), keys, "_jump", "piece").select(*values.columns, "piece")


def islands(rows: DataFrame, keys: Sequence[str], most_gap: int = 1) -> DataFrame:
    """keys, first, last and n of each run of epochs no more than most_gap apart."""
    single = rows.select(*keys, F.col("epoch").alias("start"), (F.col("epoch") + 1).alias("end"))
    found = blocks.merged(single, keys, most_gap, {"n": (F.count(F.lit(1)), F.sum)})
    return found.select(*keys, F.col("start").alias("first"), (F.col("end") - 1).alias("last"), "n")


def cold_start_stretches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accepted rows with stretch, a new one where a series starts anew after a dormant row; value = z - step_offset."""
    fresh = (F.col("flags").contains("N") & F.coalesce(F.col("_before.flags").contains("D"), F.lit(False))).cast("int")
    named = blocks.numbered(blocks.with_previous(rows, keys, ["flags"]).withColumn("_new", fresh), keys, "_new", "stretch")
    return named.where(F.col("flags").contains("A")).select(*keys, "epoch", "stretch", (F.col("z") - F.col("step_offset")).alias("value"))


def sliding_spread(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """med and mad of the changes within HALF_WINDOW epochs of each change, where there are LEAST_CHANGES.

    A frame holds 25 values at most, whatever the series' length.
    """
    frame = blocks.inside(keys).rangeBetween(-HALF_WINDOW, HALF_WINDOW)
    near = blocks.with_halo(changes.select(*keys, "epoch", "change"), HALF_WINDOW, HALF_WINDOW)
    held = near.select(*keys, "epoch", "_own", F.sort_array(F.collect_list("change").over(frame)).alias("near")).where(F.col("_own") & (F.size("near") >= LEAST_CHANGES))
    med = held.select(*keys, "epoch", "near", median_of(F.col("near")).alias("med"))
    apart = F.sort_array(F.transform("near", lambda c: F.abs(c - F.col("med"))))
    return med.select(*keys, "epoch", "med", median_of(apart).alias("mad"))


def verdicts(spreads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """bad for each epoch: scattered beyond any clock, beyond the series' own quiet scatter, or far off.

    The quiet scatter is a median over the whole series, found by counted ranges; spreads are read several times, so stage them.
    """
    quiet = medians.exact_median(spreads, keys, "mad", "quiet")
    noisy = F.greatest(NOISY_FACTOR * F.col("quiet"), F.lit(float(NOISY_FLOOR_PS)))
    bad = (F.col("mad") > NO_SIGNAL_PS) | (F.col("mad") > noisy) | (F.abs("med") > FAR_OFF_PS)
    return spreads.join(quiet, list(keys)).select(*keys, "epoch", bad.alias("bad"))


def agreed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """bad only where every reference that judged the epoch says so."""
    return rows.groupBy(*keys, "epoch").agg(F.bool_and("bad").alias("bad"))


def runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans (start, end, open_ended) of bad verdicts; only a good verdict ends one."""
    good = F.when(~F.col("bad"), F.col("epoch"))
    blocked = rows.select(*keys, "epoch", "bad", blocks.block_of(F.col("epoch")).alias("_block"))
    named = blocked.withColumn("_good", F.max(good).over(blocks.inside(keys).rowsBetween(Window.unboundedPreceding, 0)))
    local = named.where("bad").groupBy(*keys, "_block", "_good").agg(F.min("epoch").alias("start"), (F.max("epoch") + 1).alias("end"))
    one = blocked.groupBy(*keys, "_block").agg(F.max(good).alias("_last"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = one.select(*keys, "_block", F.max("_last").over(earlier).alias("_earlier"), F.max("_last").over(whole).alias("_last_good"))
    joined = blocks.beside(local, handed, [*keys, "_block"]).withColumn("_good", F.coalesce("_good", "_earlier"))
    span = joined.groupBy(*keys, "_good").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("_last_good").alias("_last_good"))
    return span.select(*keys, "start", "end", F.coalesce(F.col("_last_good") < F.col("start"), F.lit(True)).alias("open_ended"))


def joined_spans(spans: DataFrame, keys: Sequence[str], least_apart: int) -> DataFrame:
    """Spans joined where one starts fewer than least_apart epochs after the furthest end before it."""
    return blocks.merged(spans, keys, least_apart, {"open_ended": (F.bool_or("open_ended"), F.bool_or)})


def top_name(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """by, name and n of the most frequent name; ties go to the least name. Counts combine before the shuffle."""
    counted = rows.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("less"), name)).alias("best"))
    return best.select(*by, f"best.{name}", (-F.col("best.less")).alias("n"))


def shared_epochs(rows: DataFrame, member: str, least: int) -> DataFrame:
    """epoch and n_members where at least so many distinct members occur."""
    pairs = rows.select("epoch", member).distinct()
    return pairs.groupBy("epoch").agg(F.count(F.lit(1)).alias("n_members")).where(F.col("n_members") >= least)


def dense_bursts(rows: DataFrame, keys: Sequence[str], most_gap: int, least_share: float) -> DataFrame:
    """first, last, n_rows and n_epochs of the islands of which a least share of the epochs has rows."""
    counted = rows.groupBy(*keys, "epoch").agg(F.count(F.lit(1)).alias("n"))
    single = counted.select(*keys, F.col("epoch").alias("start"), (F.col("epoch") + 1).alias("end"), "n")
    found = blocks.merged(single, keys, most_gap, {"n_rows": (F.sum("n"), F.sum), "n_epochs": (F.count(F.lit(1)), F.sum)})
    burst = found.select(*keys, F.col("start").alias("first"), (F.col("end") - 1).alias("last"), "n_rows", "n_epochs")
    return burst.where(F.col("n_epochs") >= least_share * (F.col("last") - F.col("first") + 1))


def newest_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row with the greatest epoch of each series."""
    rest = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(F.max(F.struct("epoch", *rest)).alias("row")).select(*keys, "row.*")
