"""Joins between series: steering, dated settings, registries, reference tests, double differences and Allan sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import PERIOD_PS, half_even
from ..functions.timefn import EPOCH_US

GATE, SHARED_SHIFT = 5.0, 3.0


def is_reference(name: Column, prefix: str = "mc") -> Column:
    return name.rlike(f"^{prefix}[0-9]$")


def steering_by_epoch(events: DataFrame) -> DataFrame:
    """ref, epoch, move and rate: what events in (start - 600 s, start] of an epoch add up to at its start.

    An event lies before exactly one epoch's start, so the interval join is an equality join on that epoch.
    """
    epoch = F.ceil(F.col("applied_us") / F.lit(EPOCH_US)).cast("long")
    left_s = (epoch * EPOCH_US - F.col("applied_us")) / F.lit(1e6)
    return events.select("ref", epoch.alias("epoch"), (F.col("dx") + F.col("dy") * left_s).alias("dx"), "dy").groupBy("ref", "epoch").agg(F.sum("dx").alias("move"), F.sum("dy").alias("rate"))


def signs(keys: Sequence[str]) -> dict[str, Column]:
    """Columns of a series' key that name references which move it, each with its sign.

    A pair (ref, clock) is x_ref - x_clock and a triple (r, s, c) is x_r - x_c: a reference that is measured against another one
    counts on both sides, a self pair is moved by nothing, and a clock that is no reference is not steered. Of a triple r alone
    counts, by rule, even where c is a reference too.
    """
    if "r" in keys:
        return {"r": F.lit(1)}
    other = F.col("ref") != F.col("clock")
    return {"ref": F.when(other, 1).otherwise(0), "clock": F.when(other & is_reference(F.col("clock")), -1).otherwise(0)}


def steered(rows: DataFrame, steering: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of series (keys, epoch) with move and rate: what steering (ref, epoch, move, rate) did to the series since the epoch before."""
    out, total = rows, {"move": F.lit(0.0), "rate": F.lit(0.0)}
    for name, sign in signs(keys).items():
        own = steering.select(F.col("ref").alias(name), "epoch", *(F.col(c).alias(f"_{name}_{c}") for c in total))
        out = out.join(own, [name, "epoch"], "left")
        total = {c: t + sign * F.coalesce(f"_{name}_{c}", F.lit(0.0)) for c, t in total.items()}
    return out.select(*rows.columns, *(t.alias(c) for c, t in total.items()))


def steered_unread(rows: DataFrame, steering: DataFrame, keys: Sequence[str], gap_limit: int, carried: DataFrame | None = None) -> DataFrame:
    """channel, keys and epoch: epochs in which steering moves a series that has no row there, from its first row to gap_limit after its last.

    Series meet steering by name, once a steered epoch, and rows are taken off by key and epoch: no task holds a series.
    carried: rows that series go on from, the first of them where there is one.
    """
    key = ["channel", *keys]
    read = rows.select(*key, "epoch")
    known = read if carried is None else read.union(carried.select(*key, "epoch"))
    spans = known.groupBy(*key).agg(F.min("epoch").alias("_first"), F.max("epoch").alias("_last"))
    moved = None
    for name, sign in signs(keys).items():
        met = spans.withColumn("_sign", sign).where("_sign <> 0").join(steering.select(F.col("ref").alias(name), "epoch"), name)
        met = met.where((F.col("epoch") > F.col("_first")) & (F.col("epoch") <= F.col("_last") + gap_limit)).select(*key, "epoch")
        moved = met if moved is None else moved.union(met)
    return moved.distinct().join(known, [*key, "epoch"], "left_anti")


def steering_within(measured: DataFrame, events: DataFrame) -> DataFrame:
    """ref, epoch, measured_us and within: phase steered in (epoch start, measurement]; joined by the epoch that holds both."""
    held = events.select("ref", (F.ceil(F.col("applied_us") / F.lit(EPOCH_US)).cast("long") - 1).alias("epoch"), "applied_us", "dx", "dy")
    inside = F.when(F.col("applied_us") <= F.col("measured_us"), F.col("dx") + F.col("dy") * ((F.col("measured_us") - F.col("applied_us")) / F.lit(1e6)))
    return measured.join(held, ["ref", "epoch"], "left").groupBy("ref", "epoch", "measured_us").agg(F.coalesce(F.sum(inside), F.lit(0.0)).alias("within"))


def steered_within(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs (ref, clock, epoch, measured_us) with within: what was steered from the epoch's start to the pair's own instant, with `signs`."""
    instants = pairs.select("ref", "epoch", "measured_us").union(pairs.select(F.col("clock").alias("ref"), "epoch", "measured_us")).distinct()
    each = steering_within(instants, events)
    out, total = pairs, F.lit(0.0)
    for name, sign in signs(("ref", "clock")).items():
        own = each.select(F.col("ref").alias(name), "epoch", "measured_us", F.col("within").alias(f"_{name}_within"))
        out = out.join(own, [name, "epoch", "measured_us"], "left")
        total += sign * F.coalesce(f"_{name}_within", F.lit(0.0))
    return out.select(*pairs.columns, total.alias("within"))


def setting_intervals(entries: DataFrame, keys: Sequence[str], values: Sequence[str], date: str, order: str) -> DataFrame:
    """Dated overrides as intervals [from, to): undated first, then by date and order; a null keeps what was in force."""
    w = Window.partitionBy(*keys).orderBy(F.col(date).asc_nulls_first(), order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    held = entries.select(*keys, F.col(date).alias("from"), F.col(order).alias("_order"), *(F.last(v, True).over(so_far).alias(v) for v in values))
    later = Window.partitionBy(*keys).orderBy(F.col("from").asc_nulls_first(), "_order")
    ended = held.withColumn("to", F.lead("from").over(later))
    return ended.where(F.col("to").isNull() | ~F.col("from").eqNullSafe(F.col("to"))).drop("_order")


def setting_changes(intervals: DataFrame, keys: Sequence[str], values: Sequence[str], after: Column, until: Column) -> DataFrame:
    """keys, at, values and old values of the dates in (after, until] from which other settings are in force than before.

    Settings are compared as one struct each, nulls being equal; an interval that repeats the one before is no change, the
    first one of a key is.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("from").asc_nulls_first())
    both = intervals.select(*keys, F.col("from").alias("at"), F.struct(*values).alias("new"), F.lag(F.struct(*values)).over(w).alias("old"))
    changed = both.where((F.col("at") > after) & (F.col("at") <= until) & ~F.col("new").eqNullSafe(F.col("old")))
    return changed.select(*keys, "at", *(F.col(f"new.{v}").alias(v) for v in values), *(F.col(f"old.{v}").alias(f"old_{v}") for v in values))


def settings_at(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], values: Sequence[str], at: str) -> DataFrame:
    """rows with the settings in force at each row, null before the first.

    The rows and the intervals' starts are merged in one order and the newest start is carried on, so each side is shuffled
    once by key and nothing is compared pairwise.
    """
    packed = F.struct(*values)
    starts = intervals.select(*keys, F.col("from").alias("_at"), F.lit(0).alias("_side"), packed.alias("_set"), F.lit(None).cast(rows.select(F.struct("*").alias("r")).schema["r"].dataType).alias("_row"))
    asked = rows.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(starts.schema["_set"].dataType).alias("_set"), F.struct("*").alias("_row"))
    w = Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    merged = starts.unionByName(asked).withColumn("_in", F.last("_set", True).over(w)).where("_side = 1")
    return merged.select("_row.*", *(F.col(f"_in.{v}").alias(v) for v in values))


def limits_with_fallback(pairs: DataFrame, by_pair: DataFrame, by_ref: DataFrame, default: Column) -> DataFrame:
    """pairs (ref, clock) with limit: the pair's own, else its reference's, else the default."""
    own = by_pair.select("ref", "clock", F.col("limit").alias("_own"))
    of_ref = by_ref.select("ref", F.col("limit").alias("_ref"))
    return pairs.join(own, ["ref", "clock"], "left").join(of_ref, "ref", "left").select(*pairs.columns, F.coalesce("_own", "_ref", default).alias("limit"))


def configured(rows: DataFrame, config: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is configured, and the distinct keys that are not."""
    return rows.join(config, key, "left_semi"), rows.select(key).distinct().join(config, key, "left_anti")


def pair_registry(readings: DataFrame) -> DataFrame:
    """ref, clock and the first epoch in which the pair was measured."""
    return readings.groupBy("ref", "clock").agg(F.min("epoch").alias("since"))


def triple_registry(pairs: DataFrame, locations: DataFrame) -> DataFrame:
    """Triples (r, s, c): r and s measure each other, s measures c, and s and c stand in one place; since when."""
    at = locations.where("location IS NOT NULL")
    legs = pairs.select(F.col("ref").alias("s"), F.col("clock").alias("c"), "since")
    placed = legs.join(at.select(F.col("name").alias("s"), F.col("location").alias("_s")), "s").join(at.select(F.col("name").alias("c"), F.col("location").alias("_c")), "c").where("_s = _c")
    out = pairs.select(F.col("ref").alias("r"), F.col("clock").alias("s"), F.col("since").alias("_out"))
    back = pairs.select(F.col("clock").alias("r"), F.col("ref").alias("s"), F.col("since").alias("_back"))
    return placed.join(out.join(back, ["r", "s"]), "s").select("r", "s", "c", F.greatest("since", "_out", "_back").alias("since"))


def self_test(rows: DataFrame) -> DataFrame:
    """Self pairs beyond their gate, with the pairs of that reference that moved alike: epoch, ref, clock, excluded."""
    failed = rows.where((F.col("ref") == F.col("clock")) & (F.abs("nu") > GATE * F.col("scale"))).select("epoch", "ref", F.col("nu").alias("_nu"), F.col("scale").alias("_scale"))
    alike = F.abs(F.col("nu") - F.col("_nu")) <= SHARED_SHIFT * F.hypot("scale", "_scale")
    return rows.join(failed, ["epoch", "ref"]).select("epoch", "ref", "clock", ((F.col("ref") == F.col("clock")) | alike).alias("excluded"))


def two_way(rows: DataFrame) -> DataFrame:
    """Links seen both ways, a < b: what the innovations add up to, half their difference, and whether the sum is in the gate."""
    there = rows.where("ref < clock").select("epoch", F.col("ref").alias("a"), F.col("clock").alias("b"), F.col("nu").alias("nu_ab"), F.col("scale").alias("scale_ab"))
    back = rows.where("ref > clock").select("epoch", F.col("clock").alias("a"), F.col("ref").alias("b"), F.col("nu").alias("nu_ba"), F.col("scale").alias("scale_ba"))
    scale = F.hypot("scale_ab", "scale_ba")
    total = F.col("nu_ab") + F.col("nu_ba")
    return there.join(back, ["epoch", "a", "b"]).select("epoch", "a", "b", total.alias("total"), ((F.col("nu_ab") - F.col("nu_ba")) / 2).alias("value"), (scale / 2).alias("scale"), (F.abs(total) <= GATE * scale).alias("in_gate"))


def faulty_references(links: DataFrame) -> DataFrame:
    """References with two tested links or more, all of which fail: epoch, ref, tested."""
    ends = links.select("epoch", F.explode(F.array("a", "b")).alias("ref"), "in_gate")
    return ends.groupBy("epoch", "ref").agg(F.count(F.lit(1)).alias("tested"), F.count_if("in_gate").alias("passed")).where("tested >= 2 AND passed = 0").select("epoch", "ref", "tested")


def triangles(links: DataFrame) -> DataFrame:
    """Three links a < b < c of an epoch, what they close to, and whether that is in the gate."""
    ab = links.select("epoch", "a", "b", F.col("value").alias("ab"), F.col("scale").alias("s_ab"))
    bc = links.select("epoch", F.col("a").alias("b"), F.col("b").alias("c"), F.col("value").alias("bc"), F.col("scale").alias("s_bc"))
    ac = links.select("epoch", "a", F.col("b").alias("c"), F.col("value").alias("ac"), F.col("scale").alias("s_ac"))
    closed = F.col("ab") + F.col("bc") - F.col("ac")
    scale = F.sqrt(F.col("s_ab") ** 2 + F.col("s_bc") ** 2 + F.col("s_ac") ** 2)
    return ab.join(bc, ["epoch", "b"]).join(ac, ["epoch", "a", "c"]).select("epoch", "a", "b", "c", closed.alias("closure"), (F.abs(closed) <= GATE * scale).alias("in_gate"))


def slip_differences(rows: DataFrame, links: DataFrame) -> DataFrame:
    """For a clock and two references that measure it: D, and the whole periods nearest to it."""
    one = rows.select("epoch", "clock", F.col("ref").alias("a"), F.col("nu").alias("nu_a"))
    two = rows.select("epoch", "clock", F.col("ref").alias("b"), F.col("nu").alias("nu_b"))
    d = F.col("nu_a") - F.col("nu_b") - F.col("value")
    return one.join(two, ["epoch", "clock"]).where("a < b").join(links.select("epoch", "a", "b", "value"), ["epoch", "a", "b"]).select("epoch", "clock", "a", "b", d.alias("d"), F.rint(d / PERIOD_PS).cast("long").alias("periods"))


def double_differences(triples: DataFrame, z: DataFrame, round_trip: DataFrame) -> DataFrame:
    """dd of each triple and epoch: z(s,c) + (z(r,s) - z(s,r)) / 2, half to even; local triples are their pair.

    Where one direction is missing the round trip predicted for (r, s), a whole number, stands in: used tells which went in.
    """
    pair = lambda a, b, n: z.select(F.col("ref").alias(a), F.col("clock").alias(b), "epoch", F.col("z").alias(n))
    legs = triples.join(pair("s", "c", "z_sc"), ["s", "c"]).join(pair("r", "s", "z_rs"), ["r", "s", "epoch"], "left").join(pair("s", "r", "z_sr"), ["s", "r", "epoch"], "left").join(round_trip, ["r", "s", "epoch"], "left")
    local = F.col("r") == F.col("s")
    both, out, back = F.col("z_rs") - F.col("z_sr"), 2 * F.col("z_rs") - F.col("round_trip"), F.col("round_trip") - 2 * F.col("z_sr")
    dd = F.when(local, F.col("z_sc")).otherwise(F.col("z_sc") + half_even(F.coalesce(both, out, back)))
    used = F.when(local, "pair").when(both.isNotNull(), "both").when(out.isNotNull(), "out").when(back.isNotNull(), "back")
    return legs.select("r", "s", "c", "epoch", dd.alias("dd"), used.alias("used")).where("dd IS NOT NULL")


def allan_sums(values: DataFrame, keys: Sequence[str], grid: Sequence[int], value: str = "value", most: Column | None = None) -> DataFrame:
    """keys, m, terms and squares: sums over x(k+2m) - 2x(k+m) + x(k) where all three are there, for m up to most.

    Each value is sent to the (at most three) sums it is part of for each m, which combine by key before the result.
    """
    steps = F.array(*(F.lit(m) for m in grid))
    steps = F.filter(steps, lambda m: m <= most) if most is not None else steps
    spread = values.select(*keys, "epoch", F.col(value).alias("x"), F.explode(steps).alias("m"))
    parts = spread.select(*keys, "m", F.explode(F.array(F.struct(F.col("epoch").alias("k"), F.col("x").alias("d")), F.struct((F.col("epoch") - F.col("m")).alias("k"), (-2 * F.col("x")).alias("d")), F.struct((F.col("epoch") - 2 * F.col("m")).alias("k"), F.col("x").alias("d")))).alias("p"))
    terms = parts.groupBy(*keys, "m", "p.k").agg(F.sum("p.d").alias("d"), F.count(F.lit(1)).alias("n")).where("n = 3")
    return terms.groupBy(*keys, "m").agg(F.count(F.lit(1)).alias("terms"), F.sum(F.col("d") * F.col("d")).alias("squares"))


def allan_variances(sums: DataFrame, keys: Sequence[str], epoch_s: float = 600.0) -> DataFrame:
    """Variances per (keys, m): squares over terms, over 2 tau^2; combined over whatever is not in keys by terms."""
    tau = F.col("m") * epoch_s
    return sums.groupBy(*keys, "m").agg(F.sum("terms").alias("terms"), F.sum("squares").alias("squares")).select(*keys, "m", "terms", (F.col("squares") / F.col("terms") / (2 * tau * tau)).alias("variance"))


def quadratic_residual(values: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """keys, n and rms distance from the least-squares parabola, from power sums of the epoch about its mean."""
    mean = values.groupBy(*keys).agg(F.avg("epoch").alias("_mean"), F.avg(value).alias("_level"), F.greatest(F.max("epoch") - F.min("epoch"), F.lit(1)).alias("_span"))
    t, y = (F.col("epoch") - F.col("_mean")) / F.col("_span"), F.col(value) - F.col("_level")
    sums = values.join(mean, list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.sum(t**p).alias(f"t{p}") for p in (1, 2, 3, 4)), *(F.sum(y * t**p).alias(f"y{p}") for p in (0, 1, 2)), F.sum(y * y).alias("yy"))
    n, t1, t2, t3, t4, y0, y1, y2 = (F.col(c) for c in ("n", "t1", "t2", "t3", "t4", "y0", "y1", "y2"))
    det = lambda a, b, c, d, e, f, g, h, i: a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    whole = det(n, t1, t2, t1, t2, t3, t2, t3, t4)
    a = det(y0, t1, t2, y1, t2, t3, y2, t3, t4) / whole
    b = det(n, y0, t2, t1, y1, t3, t2, y2, t4) / whole
    c = det(n, t1, y0, t1, t2, y1, t2, t3, y2) / whole
    left = F.col("yy") - a * y0 - b * y1 - c * y2
    return sums.where("n >= 4").select(*keys, "n", F.sqrt(F.greatest(left, F.lit(0.0)) / n).alias("rms"))
