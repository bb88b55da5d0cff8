"""From archive rows to noise models, reports and kinds of bad stretches."""

import random
import statistics

import numpy as np
import pytest

from tickloom.operators import characterization, summary
from tickloom.plans import queries

SF = "/root/testdata/sf0.01"
TRIPLE = "channel string, r string, s string, c string, epoch long, z long, step_offset long, flags string"
OFFSET = "channel string, ref string, clock string, epoch long, offset_s double"
START = 2_900_016  # a day's first epoch


def test_values_move_to_the_start_of_their_epochs(spark):
    rng = random.Random(5)
    own = {k: {e: 7.0 * e + rng.gauss(0, 3) for e in sorted(rng.sample(range(90), n))} for k, n in (("a", 80), ("b", 60))} | {"lone": {1: 5.0, 9: 6.0}}
    offsets = {(k, e): rng.random() * 500 for k, v in own.items() for e in v if rng.random() < 0.9 or k == "lone"}
    values = spark.createDataFrame([(k, e, v) for k, vs in own.items() for e, v in vs.items()], "ref string, epoch long, value double")
    given = spark.createDataFrame([(k, e, o) for (k, e), o in offsets.items()], "ref string, epoch long, offset_s double")
    got = {(r.ref, r.epoch): r.value for r in characterization.to_epoch_start(values, given, ["ref"], ["ref"]).collect()}
    want = {}
    for (k, e), o in offsets.items():
        changes = [v - own[k][x - 1] for x, v in own[k].items() if x - 1 in own[k]]
        want[k, e] = own[k][e] - (statistics.median(changes) / 600 * o if changes else 0.0)
    assert got == pytest.approx(want, rel=1e-9)


def test_clocks_of_known_noise_from_archive_rows(spark):
    rng = np.random.default_rng(6)
    days, n = 12, 12 * 144
    triples, offsets = [], []
    for clock, rate, white, walk in (("hm1", 40.0, 20.0, 0.0), ("cs1", -900.0, 30.0, 60.0)):
        for ref in ("mc1", "mc2"):
            drift = np.cumsum(rng.normal(0, walk, n)) if walk else np.zeros(n)
            at = rng.uniform(1, 500, n)
            z = np.rint(rate * (np.arange(n) + at / 600) + drift + rng.normal(0, white, n)).astype(int)
            z[500:] += 50_000  # a jump, which parts the series
            z[144 * 7 : 144 * 8] = rng.integers(0, 200_000, 144)  # a day without signal
            for e in range(n):
                flags = "AN" if e in (0, 300) else "D" if e in (298, 299) else "R" if e % 97 == 5 else "A"
                triples.append(("a", ref, ref, clock, START + e, int(z[e]) + (1000 if e >= 1200 else 0), 1000 if e >= 1200 else 0, flags))
                offsets.append(("a", ref, clock, START + e, float(at[e])))
    triples += [("a", "mc1", "mc2", "hm1", START + e, 5, 0, "A") for e in range(300)] + [("a", "mc1", "mc1", "few", START + e, 5, 0, "A") for e in range(9)] + [("a", "mc1", "mc1", "mc1", START, 5, 0, "A")]
    offsets += [("a", "mc1", "few", START + e, 1.0) for e in range(9)]
    frame = spark.createDataFrame(triples, TRIPLE).repartition(4).cache()
    found = characterization.models(frame, spark.createDataFrame(offsets, OFFSET), spark.createDataFrame([("hm1",)], "clock string"), 500)
    got = {r.clock: r for r in found.collect()}
    assert set(got) == {"hm1", "cs1", "few"} and got["few"].rows == 9 and got["few"].white is None
    assert got["hm1"].refs == ["mc1", "mc2"] and got["hm1"].days_dropped == 2 and got["hm1"].noise_ps == pytest.approx(20, rel=0.1)
    assert got["cs1"].days_dropped == 2 and got["cs1"].noise_ps < 60 and got["cs1"].flicker_phase > 10 * got["hm1"].flicker_phase
    lines = sorted(r.line for r in summary.model_lines(found).collect())
    assert lines[1] == "few mc1 9 0 - - - - - - - - -" and lines[2].startswith(f"hm1 mc1,mc2 {got['hm1'].rows} 2 {got['hm1'].noise_ps:.1f} ")


def test_reports(spark):
    bad = spark.createDataFrame([("hm1", 8_775_540, 8_775_612, "quartz"), ("cs1", 8_775_540, None, None)], "clock string, disabled_from long, enabled_at long, kind string")
    refs = spark.createDataFrame([("hm1", ["mc1", "mc2"]), ("cs1", ["mc1"])], "clock string, refs array<string>")
    assert {r.line for r in summary.bad_stretch_lines(bad, refs).collect()} == {"hm1 60941.250000 60941.750000 12.0 quartz mc1,mc2", "cs1 60941.250000 - - - mc1"}
    own = spark.createDataFrame([("hm1", 8_775_540, 8_775_612, False, 90, 60, 2), ("hm2", 8_775_540, 8_775_612, True, 90, 60, 0)], "clock string, start long, end long, open_ended boolean, rejections long, rejected_epochs long, replaced long")
    assert {r.line for r in summary.reject_stretch_lines(own).collect()} == {"hm1 60941.250000 60941.750000 12.0 90 60 2", "hm2 60941.250000 - - 90 60 0"}
    shared = spark.createDataFrame([(8_775_540, 8_775_546, 40, "mc3", 90, 120)], "start long, end long, most_clocks long, reference string, through_reference long, rejections long")
    assert summary.shared_stretch_lines(shared).first().line == "60941.250000 60941.291666 1.0 40 mc3 90 120"


def test_bad_stretches_of_every_kind_are_found(spark):
    found = {r.kind: (r.disabled_from, r.enabled_at) for r in queries.bad_stretches(spark, SF).collect()}
    assert set(found) == {"quartz", "no_signal", "far_off"}
    for kind, part in (("quartz", 2), ("no_signal", 4), ("far_off", 6)):
        first, last = found[kind]
        assert first // 40 % 8 in (part - 1, part) and 20 <= last - first <= 44
