"""Histories of pairs and triples as keyed folds over sorted rows.

Pairs of references depend on each other in every epoch, other clocks only on what the references' pairs showed, and triples
only on accepted pairs. So three grouped folds and the joins between them do the whole history:

1. `reference_rows`, by channel: the pairs whose clock is a reference (ten names at most), screened against each other;
2. `clock_rows`, by channel and clock: each other clock's pairs, with a short array of the epoch's reference facts joined on;
3. `triple_rows`, by channel and triple: double differences, made by joins.

A fold walks through one key's rows in order and keeps one small state a series; Python is handed many keys at once. Epochs without readings are walked through only
while some series is still tracked, and a row goes on from a row of exactly the epoch before. Null phases are missing
readings; a disabled clock's readings are kept in rows of flag O and not filtered.

Rows hold all that a series carries on, so a fold can start from the newest rows of an earlier run (`carried`): a history cut
at any epoch and gone on with has the same rows as one made in one go, and a group is no longer than a run.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import replace
from itertools import zip_longest
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.timefn import EPOCH_US
from . import links, screening
from .estimator import Reading, Settings, Track, unwrapped

SETTINGS = "struct<states int, m double, m_sigma double, sigma0 double, gap_limit int, breaks_at int, fraction_epochs double, fraction_limit double, rms_limit int>"
BUFFER = "array<struct<epoch long, value double>>"
STATE = f"x_fs long, y double, d double, innovation double, scale double, step_offset long, in_segment int, since_accept int, rejects_in_row int, reject_fraction double, buffer {BUFFER}, states int, m double, m_sigma double, flags string"
PAIR = f"channel string, ref string, clock string, epoch long, cycles long, z long, rms int, predicted_fs long, started_cold boolean, nu double, prior_scale double, excluded boolean, ref_held boolean, {STATE}"
TRIPLE = f"channel string, r string, s string, c string, epoch long, z long, sigma double, used string, started_cold boolean, {STATE}"
PAIR_KEYS, TRIPLE_KEYS = ("channel", "ref", "clock"), ("channel", "r", "s", "c")
#: Rows that one task of a fold is dealt, about.
TASK_ROWS = 50_000
_PLAIN = ("x_fs", "y", "d", "innovation", "scale", "step_offset", "in_segment", "since_accept", "rejects_in_row", "reject_fraction", "states", "m", "m_sigma", "flags")


def _schema(text: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(text))


_state = attrgetter(*_PLAIN[:10], "buffer", *_PLAIN[10:])  # the columns of STATE, in its order


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _restored(row: dict) -> Track:
    """The track that a row keeps."""
    return Track(epoch=row["epoch"], buffer=[(b["epoch"], b["value"]) for b in row["buffer"]], **{n: row[n] for n in _PLAIN})


def _by_epoch(table: pa.Table, keys: Sequence[str]) -> dict[tuple, dict[int, list[dict]]]:
    """The rows of each key and epoch. Settings that repeat are one object; facts stay in Arrow, an epoch's are `Facts`."""
    columns, table = {}, table.combine_chunks()
    for name in table.column_names:
        column = table[name].combine_chunks()
        if name == "facts":
            columns[name] = _facts(column)
        elif name == "settings":
            columns[name] = _settings(column)
        else:
            columns[name] = _cells(column)
    found = defaultdict(lambda: defaultdict(list))
    for key, values in zip(zip(*(columns[k] for k in keys), strict=True), zip(*columns.values(), strict=True), strict=True):
        row = dict(zip(columns, values, strict=True))
        found[key][row["epoch"]].append(row)
    return found


def _cells(column: pa.Array) -> list:
    """The column's values; those of short lists of names are shared, and numbers pass through numpy, as both are several times faster."""
    if pa.types.is_string(column.type) and not column.null_count:
        coded = column.dictionary_encode()
        return np.array(coded.dictionary.to_pylist(), object)[coded.indices.to_numpy()].tolist()
    if not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_pylist()
    cells = column.fill_null(0).to_numpy().tolist()
    for i in np.flatnonzero(column.is_null().to_numpy(zero_copy_only=False)).tolist() if column.null_count else ():
        cells[i] = None
    return cells


def _settings(column: pa.Array) -> list[Settings | None]:
    known: dict[tuple, Settings] = {}
    names, there, out = [f.name for f in column.type], column.is_valid().to_pylist(), []
    if not column.null_count and all(len(f.unique()) == 1 for f in column.flatten()):
        return [Settings(**column[0].as_py())] * len(column)
    for ok, values in zip(there, zip(*(f.to_pylist() for f in column.flatten()), strict=True), strict=True):
        if ok and values not in known:
            known[values] = Settings(**dict(zip(names, values, strict=True)))
        out.append(known[values] if ok else None)
    return out


class Facts:
    """What the references' pairs showed in an epoch: reach and alarmed at once, all of it when asked for."""

    __slots__ = ("reach", "alarmed", "_cell")

    def __init__(self, reach: float, alarmed: bool, cell: pa.ListScalar):
        self.reach, self.alarmed, self._cell = reach, alarmed, cell

    def all(self) -> list[dict]:
        return self._cell.as_py()


def _facts(column: pa.ListArray) -> list[Facts | None]:
    """reach: the largest innovation. alarmed: a reference is held, or its own pair is beyond its gate."""
    n, each = len(column), column.flatten()
    lengths = np.asarray(column.value_lengths().fill_null(0))
    if not len(each):
        return [None] * n
    row = np.repeat(np.arange(n), lengths)
    nu, scale = (each.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("nu", "prior_scale"))
    own = np.asarray(each.field("ref")) == np.asarray(each.field("clock"))
    alarm = each.field("ref_held").to_numpy(zero_copy_only=False).astype(bool) | (own & ~np.isnan(nu) & ~(np.abs(nu) <= screening.GATE * scale))
    reach, alarmed = np.zeros(n), np.zeros(n, bool)
    np.maximum.at(reach, row, np.nan_to_num(np.abs(nu)))
    np.logical_or.at(alarmed, row, alarm)
    return [Facts(r, a, column[i]) if k else None for i, (r, a, k) in enumerate(zip(reach.tolist(), alarmed.tolist(), lengths.tolist(), strict=True))]


def _epochs(measured: list[int], active) -> Iterator[int]:
    """Every epoch with rows, and those between while active() says that some series is still tracked."""
    for here, following in zip_longest(measured, measured[1:]):
        yield here
        between = here + 1
        while following is not None and between < following and active():
            yield between
            between += 1


def _from(before: int | None, rows: dict[int, list[dict]]) -> list[int]:
    """The measured epochs, after the one from which carried rows go on. Rows without settings only tell of steering."""
    later = sorted(e for e, here in rows.items() if (before is None or e > before) and any(r["settings"] for r in here))
    return later if before is None or not later else [before, *later]


def _pair_fold(channel: str, rows: dict[int, list[dict]], carried: list[dict], is_reference: bool) -> Iterator[tuple]:
    """The rows of PAIR, as tuples in its order."""
    tracks: dict[tuple[str, str], Track] = {(r["ref"], r["clock"]): _restored(r) for r in carried if "O" not in r["flags"]}
    settings: dict[tuple[str, str], Settings] = {(r["ref"], r["clock"]): Settings(**r["settings"]) for r in carried}
    last_z: dict[tuple[str, str], int] = {(r["ref"], r["clock"]): r["last_z"] for r in carried if r["last_z"] is not None}
    before = max((r["epoch"] for r in carried), default=None)
    for epoch in _epochs(_from(before, rows), lambda: any(t.tracked for t in tracks.values())):
        if epoch == before:
            continue
        for pair, track in tracks.items():
            if track.epoch is not None and track.epoch + 1 < epoch:
                tracks[pair] = Track()
        read = {(r["ref"], r["clock"]): r for r in rows.get(epoch, []) if r["phase"] is not None}
        here = {p: r for p, r in read.items() if not r["disabled"]}
        for pair, r in sorted(read.items()):
            if r["disabled"]:  # the reading and the last phase are kept, and the series starts anew when it is enabled
                tracks[pair], settings[pair] = Track(), r["settings"]
                yield channel, *pair, epoch, None, last_z.get(pair), r["rms"], None, False, None, None, False, False, *_state(Track(flags="O"))
        facts = next((r["facts"] for r in rows.get(epoch, []) if r.get("facts")), None)
        for pair, r in here.items():
            settings[pair] = r["settings"]
            if pair not in tracks:
                tracks[pair] = Track()
        steered = {(r["ref"], r["clock"]): (r["move"] or 0.0, r["rate"] or 0.0) for r in rows.get(epoch, []) if r["move"] or r["rate"]}
        predicted = {p: t.predict(*steered.get(p, (0.0, 0.0))) for p, t in tracks.items()}
        found, scale, nu = {}, {}, {}
        for pair, r in here.items():
            found[pair] = unwrapped(r["phase"], r["offset_us"], 1_000_000, r["within"] or 0.0, predicted[pair], tracks[pair].anchor)
        for pair, p in predicted.items():
            if p is not None:
                scale[pair] = tracks[pair].scale
                if pair in found:
                    nu[pair] = p.innovation(found[pair][1])
        settled = {p for p, t in tracks.items() if t.epoch is not None and screening.UNSETTLED.isdisjoint(t.flags)}
        screened = _screened_references if is_reference else _screened_clock
        excluded, held, corrections = screened(here, nu, scale, facts, settled) if here else (set(), set(), {})
        for pair in sorted(tracks):
            if pair in read and pair not in here:
                continue
            track, r, p = tracks[pair], here.get(pair), predicted[pair]
            reading, cycles, z = None, None, None
            if r is not None:
                k = corrections.get(pair, 0)
                cycles, z = found[pair][0] + k, found[pair][1] + k * 200_000
                reading = Reading(z, float(r["rms"]), r["rms"], slip=pair in corrections)
                last_z[pair] = z
            prior = track.scale if p is not None else None
            cold = track.step(epoch, settings[pair], p, reading, excluded=pair in excluded, held=pair[0] in held and pair[0] != pair[1])
            if "D" in track.flags and "P" in track.flags:
                tracks[pair] = Track()
                continue
            yield channel, *pair, epoch, cycles, z, r["rms"] if r else None, p.x_fs if p else None, cold, nu.get(pair), prior, pair in excluded, pair[0] in held, *_state(track)


def _quiet(nu: Iterable[float], scale: Iterable[float]) -> bool:
    """Whether innovations are all so small that no test can fail: sums around triangles are the first to, at GATE sqrt(3 / 2) / 3 scales."""
    most = max(map(abs, nu), default=0.0)
    return most <= 2 * min(scale, default=np.inf) and 6 * most < screening.PERIOD_PS


def _screened_references(here: dict, nu: dict, scale: dict, facts: Facts | None, settled: set) -> tuple[set, set, dict]:
    """Pairs that are excluded, references that are held, and whole periods to add to pairs, among the references' own pairs."""
    if _quiet(nu.values(), scale.values()):
        return set(), set(), {}
    panel = screening.Panel({clock for _, clock in here}, nu, scale)
    screening.screen(panel)
    excluded, corrections = panel.excluded, {}
    for i, clock in enumerate(panel.names):
        known = np.array([(name, clock) in settled for name in panel.names], bool)
        slip, unsure = screening.slips(panel, panel.nu[:, i], panel.scale[:, i], panel.usable[:, i], known)
        if slip:
            corrections[panel.names[slip[0]], clock] = slip[1]
        excluded |= {(panel.names[j], clock) for j in np.flatnonzero(unsure)}
    return excluded, {panel.names[j] for j in np.flatnonzero(panel.held)}, corrections


def _screened_clock(here: dict, nu: dict, scale: dict, facts: Facts | None, settled: set) -> tuple[set, set, dict]:
    """The same for one other clock's pairs, from what the references' own pairs showed."""
    if not nu:
        return set(), set(), {}
    reach = max(nu.values()) - min(nu.values()) + (facts.reach if facts else 0.0)
    if not (facts and facts.alarmed) and 2 * reach < screening.PERIOD_PS:  # no reference is held or has moved by itself, and no two pairs are half a period apart
        return set(), set(), {}
    clock, facts = next(iter(nu))[1], facts.all() if facts else []
    said = [f for f in facts if f["nu"] is not None]
    of_links = lambda column: {(f["ref"], f["clock"]): f[column] for f in said}
    panel = screening.Panel({f["ref"] for f in facts}, of_links("nu"), of_links("prior_scale"))
    for f in said:
        if f["excluded"] and f["clock"] in panel.names:
            panel.usable[panel.names.index(f["ref"]), panel.names.index(f["clock"])] = False
    held = {f["ref"] for f in facts if f["ref_held"]}
    own_nu, own_scale = (np.array([v.get((name, clock), np.nan) for name in panel.names], float) for v in (nu, scale))
    usable = ~np.isnan(own_nu) & ~np.array([name in held for name in panel.names], bool) & ~panel.self_shift(own_nu[:, None], own_scale[:, None])[:, 0]
    excluded = {(name, clock) for name, seen, ok in zip(panel.names, own_nu, usable, strict=True) if not np.isnan(seen) and not ok}
    slip, unsure = screening.slips(panel, own_nu, own_scale, usable, np.array([(name, clock) in settled for name in panel.names], bool))
    corrections = {(panel.names[slip[0]], clock): slip[1]} if slip else {}
    return excluded | {(panel.names[j], clock) for j in np.flatnonzero(unsure)}, held, corrections


def tasks(spark: SparkSession, rows: int) -> int:
    """Partitions for a fold of so many rows: Spark's own choice goes by bytes, which are few, and not by the work of a row."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def _by_bucket(rows: DataFrame, keys: Sequence[str], fold: Callable[[tuple, dict, list], Iterable[tuple]], out: str, carried: DataFrame | None, parts: int | None) -> DataFrame:
    """Rows of `out` that `fold` makes of each key's rows by epoch and its carried rows.

    A call of Python takes a bucket of keys, as handing over a short series costs more than folding it: four buckets a
    partition, so that one holds a quarter of TASK_ROWS or one series.
    """
    schema, parts = _schema(out), parts or tasks(rows.sparkSession, 0)

    def dealt(some: DataFrame) -> DataFrame:
        return some.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(4 * parts))).repartition(parts, "_bucket")

    def folded(table: pa.Table, old: pa.Table | None) -> pa.Table:
        by_key, gone_on = _by_epoch(table.drop_columns("_bucket"), keys), defaultdict(list)
        for row in old.drop_columns("_bucket").to_pylist() if old else []:
            gone_on[tuple(row[k] for k in keys)].append(row)
        return _table([r for key in by_key for r in fold(key, by_key[key], gone_on[key])], schema)

    if carried is None:
        return dealt(rows).groupBy("_bucket").applyInArrow(lambda table: folded(table, None), out)
    return dealt(rows).groupBy("_bucket").cogroup(dealt(carried).groupBy("_bucket")).applyInArrow(lambda table, old: folded(table, old), out)


def _folded(rows: DataFrame, keys: list[str], is_reference: bool, carried: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    return _by_bucket(rows, keys, lambda key, by_epoch, old: _pair_fold(key[0], by_epoch, old, is_reference), PAIR, carried, parts)


def newest(rows: DataFrame, keys: Sequence[str], until: int | None = None) -> DataFrame:
    """The row of each series that a run goes on from: the newest one, up to an epoch; last_z: the series' newest phase."""
    kept = rows if until is None else rows.where(F.col("epoch") <= until)
    rest = [c for c in rows.columns if c not in keys]
    found = kept.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("row"), F.max_by("z", F.when(F.col("z").isNotNull(), F.col("epoch"))).alias("last_z"))
    return found.select(*keys, "row.*", "last_z")


def reference_rows(rows: DataFrame, carried: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """PAIR rows of the pairs whose clock is a reference; rows as `pair_inputs` gives them. carried: as `newest` gives them, with settings. parts: partitions (`tasks`)."""
    return _folded(rows, ["channel"], True, carried, parts)


def reference_facts(reference_rows: DataFrame) -> DataFrame:
    """channel, epoch and facts: what a clock's fold has to know of the references, at most a hundred short structs."""
    fact = F.struct("ref", "clock", "nu", "prior_scale", "excluded", "ref_held")
    measured = reference_rows.where("z IS NOT NULL")
    return measured.groupBy("channel", "epoch").agg(F.array_sort(F.collect_list(fact)).alias("facts"))


def clock_rows(rows: DataFrame, facts: DataFrame, carried: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """PAIR rows of all other clocks' pairs."""
    return _folded(rows.join(facts, ["channel", "epoch"], "left"), ["channel", "clock"], False, carried, parts)


def with_settings(rows: DataFrame, settings: DataFrame, limits: tuple[DataFrame, DataFrame, Column] | None = None) -> DataFrame:
    """Rows (clock, epoch, ...) with `settings`, without those whose clock has none.

    settings has (clock, settings), or dated intervals (clock, from, settings): then those in force at the row's epoch. limits:
    limits on rms by pair, by reference and by default, in place of the settings' own, for rows that have a ref.
    """
    if "from" in settings.columns:
        given = links.settings_at(rows, settings, ["clock"], ["settings"], "epoch").where("settings IS NOT NULL")
    else:
        given = rows.join(settings.select("clock", "settings"), "clock").select(*rows.columns, "settings")
    given = given.withColumn("settings", F.col("settings").cast(SETTINGS))
    if limits is None:
        return given
    pairs = given.select("ref", "clock").distinct()
    of_pair = links.limits_with_fallback(pairs, *limits).withColumnRenamed("limit", "_limit")
    return given.join(of_pair, ["ref", "clock"]).withColumn("settings", F.col("settings").withField("rms_limit", F.col("_limit").cast("int"))).drop("_limit")


def _with_unread(rows: DataFrame, steering: DataFrame, keys: Sequence[str], gap_limit: int, carried: DataFrame | None) -> DataFrame:
    """rows with move and rate, and rows without settings or readings for epochs in which only steering moves a series."""
    by_epoch = links.steering_by_epoch(steering)
    unread = links.steered_unread(rows, by_epoch, keys, gap_limit, carried)
    return links.steered(rows.unionByName(unread, allowMissingColumns=True), by_epoch, keys)


def pair_inputs(readings: DataFrame, settings: DataFrame, steering: DataFrame | None = None, disabled: DataFrame | None = None, limits: tuple[DataFrame, DataFrame, Column] | None = None, gap_limit: int = 40, carried: DataFrame | None = None) -> DataFrame:
    """Readings (channel, ref, clock, epoch, delta_us, phase, rms) with settings, dated or not (`with_settings`), and steering columns.

    steering has events (ref, applied_us, dx, dy): move and rate are what they did to a pair since the last epoch, within what
    they did from the epoch's start to the reading. Where it moves a pair that has no reading, up to gap_limit epochs after the
    last one, there is a row without settings, so that the prediction goes along. disabled has (clock, epoch). carried: rows
    that the fold goes on from.
    """
    rows = with_settings(readings.select("channel", "ref", "clock", "epoch", F.col("delta_us").alias("offset_us"), "phase", "rms"), settings, limits)
    if steering is None:
        rows = rows.select("*", *(F.lit(0.0).alias(c) for c in ("move", "rate", "within")))
    else:
        timed = _with_unread(rows, steering, PAIR_KEYS[1:], gap_limit, carried).withColumn("measured_us", F.col("epoch") * EPOCH_US + F.coalesce("offset_us", F.lit(0)))
        rows = links.steered_within(timed, steering).drop("measured_us")
    if disabled is None:
        return rows.withColumn("disabled", F.lit(False))
    off = disabled.select("clock", "epoch", F.lit(True).alias("_off")).distinct()
    return rows.join(off, ["clock", "epoch"], "left").select(*rows.columns, F.coalesce("_off", F.lit(False)).alias("disabled"))


def triple_inputs(pairs: DataFrame, triples: DataFrame, settings: DataFrame, locations: DataFrame | None = None, earlier: DataFrame | None = None, steering: DataFrame | None = None, gap_limit: int = 40, carried: DataFrame | None = None) -> DataFrame:
    """Double differences of accepted pairs: channel, r, s, c, epoch, z, sigma, used, restarted, settings, move, rate.

    z(s,c) + (z(r,s) - z(s,r)) / 2; where one direction is missing, the round trip that both pairs predict stands in. triples
    may have `since`, their first epoch. locations: dated intervals (clock, from, location), of which s and c must have the same
    at the epoch. earlier: pair rows of a run before this one, for links of epochs that it still walks through. steering, gap_limit
    and carried: as for `pair_inputs`; a triple is moved by r alone, and its z is one at the epoch's start already.
    """
    accepted = F.col("flags").contains("A")
    told = lambda rows: rows.select("channel", "ref", "clock", "epoch", F.when(accepted, F.col("z")).alias("z"), F.when(accepted, F.col("rms")).alias("rms"), F.col("predicted_fs").alias("p"), F.col("started_cold").alias("cold"))
    legs = told(pairs).select("channel", F.col("ref").alias("s"), F.col("clock").alias("c"), "epoch", *(F.col(n).alias(f"sc_{n}") for n in ("z", "rms", "p", "cold")))
    both = told(pairs if earlier is None else pairs.unionByName(earlier)).where("ref <> clock").join(triples.select(F.col("r").alias("clock")).union(triples.select("s")).distinct(), "clock", "left_semi")
    low, high = F.least("ref", "clock").alias("low"), F.greatest("ref", "clock").alias("high")
    up = F.when(F.col("ref") < F.col("clock"), F.struct("z", "rms", "p", "cold")).alias("up")
    down = F.when(F.col("ref") > F.col("clock"), F.struct("z", "rms", "p", "cold")).alias("down")
    link = both.select("channel", low, high, "epoch", up, down).groupBy("channel", "low", "high", "epoch").agg(F.max("up").alias("up"), F.max("down").alias("down"))
    local, forth = F.col("r") == F.col("s"), F.col("r") < F.col("s")
    placed = triples.withColumn("low", F.least("r", "s")).withColumn("high", F.greatest("r", "s"))
    joined = legs.join(placed, ["s", "c"])
    if "since" in triples.columns:
        joined = joined.where("epoch >= since")
    if locations is not None:
        for side, name in (("s", "_s"), ("c", "_c")):
            joined = links.settings_at(joined, locations.withColumnRenamed("clock", side), [side], ["location"], "epoch").withColumnRenamed("location", name)
        joined = joined.where("_s = _c")
    joined = joined.join(link, ["channel", "low", "high", "epoch"], "left")
    rs, sr = F.when(forth, F.col("up")).otherwise(F.col("down")), F.when(forth, F.col("down")).otherwise(F.col("up"))
    there, back, trip = rs["z"], sr["z"], rs["p"] + sr["p"]
    both_fs = 500 * (there - back)
    fs = F.when(local, F.lit(0)).otherwise(F.coalesce(both_fs, 1000 * there - trip / 2, trip / 2 - 1000 * back))
    used = F.when(local | both_fs.isNotNull(), "111").when((1000 * there - trip).isNotNull(), "110").when((trip - 1000 * back).isNotNull(), "101")
    square = lambda c: c.cast("double") * c
    own = square(F.col("sc_rms"))
    variance = F.when(used == "111", own + F.lit(0.25) * (square(rs["rms"]) + square(sr["rms"]))).when(used == "110", own + square(rs["rms"])).otherwise(own + square(sr["rms"]))
    cold = lambda c: F.coalesce(c, F.lit(False))
    restarted = F.when(local, cold(F.col("sc_cold"))).otherwise(cold(F.col("sc_cold")) | cold(rs["cold"]) | cold(sr["cold"]))
    z = F.col("sc_z") + F.rint(fs / 1000.0).cast("long")
    rows = joined.select("channel", "r", "s", F.col("c").alias("clock"), "epoch", F.when(used.isNotNull(), z).alias("z"), F.when(local, F.col("sc_rms").cast("double")).otherwise(F.sqrt(variance)).alias("sigma"), used.alias("used"), restarted.alias("restarted"))
    given = with_settings(rows, settings).withColumnRenamed("clock", "c").select("channel", "r", "s", "c", "epoch", "z", "sigma", "used", "restarted", "settings")
    if steering is None:
        return given.select("*", F.lit(0.0).alias("move"), F.lit(0.0).alias("rate"))
    return _with_unread(given, steering, TRIPLE_KEYS[1:], gap_limit, carried)


def triple_rows(rows: DataFrame, carried: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """TRIPLE rows from `triple_inputs`: the same transition, with no limit on rms and no screening. carried: as for pairs."""
    def walk(key: tuple, by_epoch: dict[int, list[dict]], carried: list[dict]) -> Iterator[tuple]:
        track, settings, given, before = Track(), None, None, None
        for r in carried:
            track, settings, before = _restored(r), Settings(**(r["settings"] | {"rms_limit": None})), r["epoch"]
        for epoch in _epochs(_from(before, by_epoch), lambda: track.tracked):
            if epoch == before:
                continue
            if track.epoch is not None and track.epoch + 1 < epoch:
                track = Track()
            r = by_epoch.get(epoch, [None])[0]
            if r and r["settings"] and r["settings"] is not given:
                given, settings = r["settings"], replace(r["settings"], rms_limit=None)
            reading = Reading(r["z"], r["sigma"]) if r and r["z"] is not None else None
            moved = track.predict(r["move"], r["rate"]) if r else track.predict()
            cold = track.step(epoch, settings, moved, reading, restarted=bool(r and r["restarted"]))
            if "D" in track.flags and "P" in track.flags:
                track = Track()
                continue
            yield *key, epoch, reading.z if reading else None, reading.floor if reading else None, r["used"] if reading else None, cold, *_state(track)

    return _by_bucket(rows, TRIPLE_KEYS, walk, TRIPLE, carried, parts)
