"""From readings to the archive: pairs, then triples, in runs that go on from what the archive holds.

A run takes the readings after an epoch, up to another, starts every series from its newest archived row and commits pairs and
triples as one version of the archive. Its memory is that of a run, not of a history; `in_runs` makes a long history run by
run. Settings, limits on rms, locations and switched-off clocks are those in force at each epoch.

Defined results: readings of clocks without settings in force are left out; where nothing is to be done a version without new
rows is committed; redoing from an epoch (`run` with an `after` before the archive's end) replaces all later rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import archive
from ..sources.staging import staged
from . import folds, links


@dataclass(frozen=True)
class Setup:
    """What holds for a deployment: settings (clock, settings), or dated (clock, from, settings), and what else there is of it.

    locations: dated (clock, from, location), without which all stand in one place; limits: on rms by pair, by reference and by
    default; steering: events (ref, applied_us, dx, dy); disabled: (clock, epoch). gap_limit: the largest of all settings.
    """

    settings: DataFrame
    locations: DataFrame | None = None
    limits: tuple[DataFrame, DataFrame, Column] | None = None
    steering: DataFrame | None = None
    disabled: DataFrame | None = None
    gap_limit: int = 40


def pair_history(readings: DataFrame, setup: Setup, carried: DataFrame | None = None) -> DataFrame:
    """PAIR rows of readings (channel, ref, clock, epoch, delta_us, phase, rms), gone on from `carried` rows (`folds.newest`).

    The references' rows are written first, as the other clocks' fold needs them as well as the result.
    """
    rows = folds.pair_inputs(readings, setup.settings, setup.steering, setup.disabled, setup.limits, setup.gap_limit, carried)
    is_own = links.is_reference(F.col("clock"))
    old = {True: None, False: None}
    if carried is not None:
        given = staged(folds.with_settings(carried, setup.settings, setup.limits), "carried")
        old = {True: given.where(is_own), False: given.where(~is_own)}
    parts = folds.tasks(readings.sparkSession, readings.count())
    refs = staged(folds.reference_rows(rows.where(is_own), old[True], parts), "references")
    return refs.unionByName(folds.clock_rows(rows.where(~is_own), folds.reference_facts(refs), old[False], parts))


def triple_history(pairs: DataFrame, registry: DataFrame, setup: Setup, carried: DataFrame | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """TRIPLE rows of PAIR rows that have been written; registry: triples (r, s, c, since)."""
    registry = staged(registry, "registry")
    legs = pairs.groupBy(F.col("ref").alias("s"), F.col("clock").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    n_rows = legs.join(registry, ["s", "c"]).agg(F.sum("n")).first()[0] or 0
    rows = folds.triple_inputs(pairs, registry, setup.settings, setup.locations, earlier, setup.steering, setup.gap_limit, carried)
    old = None if carried is None else folds.with_settings(carried.withColumnRenamed("c", "clock"), setup.settings).withColumnRenamed("clock", "c")
    return folds.triple_rows(rows, old, folds.tasks(pairs.sparkSession, n_rows))


def known_triples(known: DataFrame, setup: Setup) -> DataFrame:
    """Triples (r, s, c, since) of pairs (ref, clock, since); whether s and c stand in one place is asked at each epoch."""
    names = known.select(F.col("ref").alias("name")).union(known.select("clock")).distinct().withColumn("location", F.lit(1))
    return links.triple_registry(known, names)


def run(spark: SparkSession, readings: DataFrame, setup: Setup, folder: str, after: int | None = None, until: int | None = None) -> int:
    """Do the epochs (after, until] and commit them; the archive's version. What the archive holds after `after` is replaced."""
    some = readings
    if after is not None:
        some = some.where(F.col("epoch") > after)
    if until is not None:
        some = some.where(F.col("epoch") <= until)
    held = {kind: None if after is None else archive.committed(spark, folder, kind) for kind in ("pairs", "triples")}
    old_pairs = held["pairs"]
    pairs = pair_history(some, setup, None if old_pairs is None else folds.newest(old_pairs, folds.PAIR_KEYS, after))
    pairs = staged(pairs, "pairs")
    known = links.pair_registry(pairs.where("z IS NOT NULL"))
    earlier = old_triples = None
    if old_pairs is not None:
        known = known.union(links.pair_registry(old_pairs.where((F.col("epoch") <= after) & F.col("z").isNotNull()))).groupBy("ref", "clock").agg(F.min("since").alias("since"))
        recent = (F.col("epoch") <= after) & (F.col("epoch") > after - setup.gap_limit - 2)
        earlier = old_pairs.where(recent & links.is_reference(F.col("clock"))).select(*pairs.columns)
    if held["triples"] is not None:
        old_triples = folds.newest(held["triples"], folds.TRIPLE_KEYS, after)
    triples = triple_history(pairs, known_triples(known, setup), setup, old_triples, earlier)
    return archive.commit(spark, folder, {"pairs": pairs, "triples": triples}, after)


def in_runs(spark: SparkSession, readings: DataFrame, setup: Setup, folder: str, first: int, last: int, epochs: int = 144) -> Iterator[int]:
    """The epochs [first, last] in runs of so many epochs, each of which starts from the rows of the one before; their versions."""
    for after in range(first - 1, last, epochs):
        yield run(spark, readings, setup, folder, None if after < first else after, min(after + epochs, last))
