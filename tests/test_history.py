"""Histories made run by run against the same made in one go, dated settings, and versions of the archive."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import folds, history, links
from tickloom.sources import archive

FIRST, LAST = 1000, 1069
READING = "channel string, ref string, clock string, epoch long, delta_us long, phase long, rms int"


@pytest.fixture(scope="module")
def readings(spark):
    """Two channels, three references and three clocks with gaps, jumps, slips, bad rms and phases that are missing."""
    rng, names, rows = random.Random(11), ["mc1", "mc2", "mc3"], []
    for channel in "ab":
        for e in range(FIRST, LAST + 1):
            for i, ref in enumerate(names):
                for j, clock in enumerate([*names, "u1", "u2", "u3"]):
                    if rng.random() < 0.06 or (clock == "u2" and 1020 <= e < 1030) or (clock == "u3" and e % 9 > 5) or (channel == "b" and 1031 <= e < 1036):
                        continue
                    drift = rng.randint(-2, 2) + (0 if clock in names else (j - i) * 300 * (e - FIRST))
                    jump = 5000 if clock == "u1" and e >= 1040 else 200_000 if (ref, clock) == ("mc2", "u2") and e == 1045 else rng.choice([0] * 60 + [700])
                    rows.append((channel, ref, clock, e, 1_000_000 * (i + j), None if rng.random() < 0.03 else (drift + jump) % 200_000, 90 if rng.random() < 0.02 else 3))
    return spark.createDataFrame(rows, READING).cache()


@pytest.fixture(scope="module")
def setup(spark):
    """Settings, limits and a location that change in mid-series, a clock that is switched off for a while, and steering."""
    plain, two = (1, None, 30.0, 5.0, 4, 12, 144.0, 0.5, 50), (2, 20.0, 30.0, 50.0, 6, 12, 144.0, 0.5, 50)
    dated = [(c, None, plain) for c in ("mc1", "mc2", "mc3")] + [("u1", None, two), ("u1", 1025, (2, 15.0, 30.0, 50.0, 6, 12, 144.0, 0.5, 50)), ("u2", None, two), ("u3", 1010, two), ("u3", 1050, (2, 20.0, 25.0, 40.0, 3, 12, 144.0, 0.5, 50))]
    places = [(c, None, 1) for c in ("mc1", "mc2", "u1", "u2", "u3")] + [("mc3", None, 2), ("u1", 1033, 2), ("u2", 1055, None)]
    by_pair, by_ref = (spark.createDataFrame(*given) for given in (([("mc1", "u1", 80)], "ref string, clock string, limit int"), ([("mc2", 95)], "ref string, limit int")))
    return history.Setup(
        settings=spark.createDataFrame(dated, f"clock string, from long, settings {folds.SETTINGS}"),
        locations=spark.createDataFrame(places, "clock string, from long, location int"),
        limits=(by_pair, by_ref, F.lit(50)),
        steering=spark.createDataFrame([("mc1", 1015 * 600_000_000 + 7, 20.0, 0.001), ("mc2", 1041 * 600_000_000, -8.0, 0.0)], "ref string, applied_us long, dx double, dy double"),
        disabled=spark.range(1058, 1061).select(F.lit("u2").alias("clock"), F.col("id").alias("epoch")),
        gap_limit=6,
    )


def rows_of(spark, folder, number=None):
    return {kind: sorted((str(sorted(r.asDict(True).items())) for r in archive.committed(spark, folder, kind, number).collect())) for kind in ("pairs", "triples")}


@pytest.fixture(scope="module")
def whole(spark, readings, setup, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('whole')}"
    assert history.run(spark, readings, setup, folder) == 0
    return folder


def test_runs_that_go_on_from_stored_rows_equal_one_run(spark, readings, setup, whole, tmp_path):
    expected = rows_of(spark, whole)
    flags = "".join(r.flags for r in archive.committed(spark, whole, "pairs").collect())
    assert set("ARPDNUOX") <= set(flags) and len(expected["triples"]) > 500
    for step in (24,):
        folder = f"file://{tmp_path}/by{step}"
        versions = list(history.in_runs(spark, readings, setup, folder, FIRST, LAST, step))
        assert versions == list(range(-(-(LAST - FIRST + 1) // step))) and rows_of(spark, folder) == expected


def test_redoing_from_an_epoch_replaces_what_comes_after(spark, readings, setup, whole, tmp_path):
    folder = f"file://{tmp_path}/redone"
    wrong = readings.withColumn("phase", F.when(F.col("epoch") > 1042, (F.col("phase") * 7 + 1) % 200_000).otherwise(F.col("phase")))
    history.run(spark, wrong, setup, folder)
    assert rows_of(spark, folder) != rows_of(spark, whole)
    assert history.run(spark, readings, setup, folder, after=1042) == 1
    assert rows_of(spark, folder) == rows_of(spark, whole)
    assert rows_of(spark, folder, 0) != rows_of(spark, whole)  # the version before can still be read


def test_a_job_that_ends_between_two_kinds_changes_nothing(spark, readings, setup, whole, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/killed"
    history.run(spark, readings, setup, folder, until=1010)
    before, write = rows_of(spark, folder), archive.write

    def stop_at_triples(rows, to, kind, mode="append"):
        if kind == "triples":
            raise KeyboardInterrupt
        write(rows, to, kind, mode)

    monkeypatch.setattr(archive, "write", stop_at_triples)
    with pytest.raises(KeyboardInterrupt):
        history.run(spark, readings, setup, folder, after=1010, until=1030)
    assert archive.version(spark, folder) == 0 and rows_of(spark, folder) == before
    monkeypatch.undo()
    (tmp_path / "killed" / "manifests" / "1").mkdir()  # a manifest that was not finished is none
    assert archive.version(spark, folder) == 0


def test_dated_settings_hold_from_their_epoch(spark, readings, setup, whole):
    pairs, triples = (archive.committed(spark, whole, kind) for kind in ("pairs", "triples"))
    segments = {(r.channel, r.ref, r.epoch) for r in pairs.where("clock = 'u1' AND flags LIKE '%N%' AND m = 15").collect()}
    assert {e for _, _, e in segments} >= {1025} and pairs.where("clock = 'u1' AND epoch < 1025 AND m = 15").isEmpty()
    assert pairs.where("clock = 'u3' AND epoch < 1010").isEmpty() and not pairs.where("clock = 'u3' AND epoch >= 1010").isEmpty()  # no settings before
    off = pairs.where("clock = 'u2' AND flags = 'O'").collect()
    assert {r.epoch for r in off} == {1058, 1059, 1060}
    told = {(r.s, r.c, r.epoch >= 1033) for r in triples.where("c = 'u1'").collect()}
    assert told == {("mc1", "u1", False), ("mc2", "u1", False), ("mc3", "u1", True)}  # it moved from one place to another
    assert triples.where("c = 'u2' AND epoch >= 1055").isEmpty()


def test_change_points(spark):
    dated = [("k", None, "a", 1), ("k", 10, "a", 1), ("k", 20, "b", None), ("k", 30, "b", None), ("k", 40, "b", 2), ("q", 20, None, None)]
    intervals = spark.createDataFrame(dated, "clock string, from long, v string, w int")
    found = links.setting_changes(intervals, ["clock"], ["v", "w"], F.lit(10), F.lit(40)).collect()
    assert sorted(map(tuple, found), key=str) == [("k", 20, "b", None, "a", 1), ("k", 40, "b", 2, "b", None), ("q", 20, None, None, None, None)]
    assert [r.at for r in links.setting_changes(intervals, ["clock"], ["v", "w"], F.lit(20), F.lit(39)).collect()] == []
