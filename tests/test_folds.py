"""The estimator's transition, and the staged folds, whatever the partitions."""

import random
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import folds, history, links, screening
from tickloom.operators.estimator import Reading, Settings, State, Three, Track, unwrap
from tickloom.plans import proxies, queries
from tickloom.sources.staging import staged

S1 = Settings(states=1, m=None, m_sigma=30.0, sigma0=2.0, gap_limit=3, rms_limit=50)
S3 = Settings(states=3, m=100.0, m_sigma=50.0, sigma0=5.0, gap_limit=40)


def run(settings, values, **kw):
    track, rows = Track(), []
    for epoch, z in enumerate(values):
        track.step(epoch, settings, track.predict(), None if z is None else Reading(z, 1.0, 1), **kw)
        rows.append(track.flags)
        if "D" in track.flags and "P" in track.flags:
            track = Track()
    return track, rows


def test_three_steady_readings_start_a_series():
    track, rows = run(S3, [100, 110, 120, 130])
    assert rows == ["RD", "RD", "ANU", "AU"] and track.y == pytest.approx(10 / 600) and track.step_offset == 0
    assert run(S3, [100, 110, 400])[1][-1] == "RD"
    assert run(S3, [100, None, 120, 130, 140])[1] == ["RD", "PD", "RD", "RD", "ANU"]


def test_three_values_are_taken_apart_exactly():
    rng = random.Random(8)
    for _ in range(200):
        epochs = sorted(rng.sample(range(9), 3))
        values = [rng.uniform(-1e5, 1e5) for _ in epochs]
        seen = Three.of(list(zip(epochs, values, strict=True)))
        (slope, start), at = np.polyfit(np.array(epochs) * 600.0, values, 1), np.array(epochs) * 600.0
        assert float(seen.slope) == pytest.approx(slope, rel=1e-6, abs=1e-9) and float(seen.newest) == pytest.approx(start + slope * at[2], abs=1e-5)
        assert float(seen.off_line) == pytest.approx(max(abs(values - start - slope * at)), abs=1e-5)
        assert float(seen.off_level) == pytest.approx(max(abs(v - sum(values) / 3) for v in values)) and seen.in_a_row == (epochs[2] - epochs[0] == 2)
    line = Three.of([(1, 0.1), (2, 0.2), (4, 0.4)])
    assert abs(line.bend) < 1e-15 and Three.of([(1, 3.0), (3, 3.0), (4, 3.0)]).off_line == 0


def test_gap_beyond_the_limit_ends_it():
    assert run(S1, [1, 1, 1, None, None, None, None, 1])[1] == ["RD", "RD", "AN", "P", "P", "P", "PD", "RD"]


def test_phase_and_frequency_steps():
    track, rows = run(S1, [0, 0, 0, 1000, 1001, 999])
    assert rows[3:] == ["R", "R", "A"] and track.step_offset == 1000 and track.x_fs == 999_000
    two = Settings(states=2, m=10.0, m_sigma=50.0, sigma0=5.0)
    assert run(two, [0, 0, 0, 0, 600, 1200, 1800])[1][-1] == "ANU"


def test_twelve_rejects_end_it_and_rms_clears_the_buffer():
    jumping = [0, 0, 0] + [10_000 * (-1) ** k * (k + 1) for k in range(12)]
    assert run(S1, jumping)[1][-1] == "RD"
    track = Track()
    for e in range(3):
        track.step(e, S1, track.predict(), Reading(0, 1.0, 1))
    track.step(3, S1, track.predict(), Reading(0, 1.0, 51))
    assert track.flags == "R" and track.buffer == [] and track.rejects_in_row == 1
    track.step(4, S1, track.predict(), Reading(0, 1.0, 1), excluded=True)
    assert track.flags == "X" and track.rejects_in_row == 1


def test_unwrapping_rounds_half_to_even():
    assert unwrap(10, Fraction(0), Fraction(0), State(Fraction(400_020)), None) == (2, 400_010)
    assert unwrap(0, Fraction(0), Fraction(0), State(Fraction(100_000)), None)[0] == 0
    assert unwrap(0, Fraction(0), Fraction(0), State(Fraction(300_000)), None)[0] == 2
    assert unwrap(5, Fraction(0), Fraction(1, 2), None, None) == (0, 4)


def deployment(seed, spoil):
    """Innovations of four references that agree up to noise, with what spoil does to them."""
    rng = random.Random(seed)
    names = ["mc2", "mc4", "mc6", "mc9"]
    nu = {(a, b): rng.uniform(-0.5, 0.5) for a in names for b in names if rng.random() > 0.05}
    scale = {(a, b): rng.uniform(0.8, 1.2) for a in names for b in names}
    for pair, by in spoil.items():
        if pair in nu:
            nu[pair] += by
    return names, nu, scale


def test_one_bad_direction_is_told_by_the_way_around():
    names, nu, scale = deployment(3, {("mc4", "mc9"): 31.0})
    nu = dict.fromkeys([(a, b) for a in names for b in names], 0.1) | nu | {("mc4", "mc9"): 31.0}
    panel = screening.Panel(names, nu, scale)
    screening.screen(panel)
    assert panel.excluded == {("mc4", "mc9")} and panel.findings == [("reciprocity_fail", ("mc4", "mc9"))] and not panel.held.any()


def test_a_reference_all_of_whose_links_fail_is_held():
    names, nu, scale = deployment(12, {("mc6", b): 40.0 for b in ("mc2", "mc4", "mc9")})
    panel = screening.Panel(names, nu, scale)
    screening.screen(panel)
    assert [n for n, h in zip(panel.names, panel.held, strict=True) if h] == ["mc6"] and panel.excluded >= {p for p in nu if p[0] == "mc6" != p[1]}


def test_a_link_in_every_bad_triangle_fails():
    names, nu, scale = deployment(7, {("mc2", "mc6"): 25.0, ("mc6", "mc2"): -25.0})
    nu |= dict.fromkeys([(a, b) for a in names for b in names if (a, b) not in nu], 0.0)
    panel = screening.Panel(names, nu, scale)
    screening.screen(panel)
    assert panel.excluded == {("mc2", "mc6"), ("mc6", "mc2")} and panel.findings[-1] == ("closure_fail", ("mc2", "mc6"))


def test_slips_of_a_clock():
    names, nu, scale = deployment(5, {})
    panel = screening.Panel(names, dict.fromkeys([(a, b) for a in names for b in names], 0.0), scale)
    seen, ones, yes = np.zeros(4), np.ones(4), np.ones(4, bool)
    seen[2] = 3 * 200_000 + 1.0
    assert screening.slips(panel, seen, ones, yes, yes)[0] == (2, -3)
    two = np.array([True, False, True, False])
    slip, unsure = screening.slips(panel, seen, ones, two, yes)
    assert slip is None and unsure.tolist() == [True, False, True, False]
    assert screening.slips(panel, seen, ones, two, np.array([True, True, False, True]))[0] == (2, -3)
    assert screening.slips(panel, np.zeros(4), ones, yes, yes)[0] is None


def test_tests_of_an_epoch_agree_with_the_relational_ones(spark):
    """Self tests, reciprocity, faults and triangles of random epochs as the DataFrame operators give them."""
    rng, rows, panels = random.Random(17), [], {}
    for epoch in range(60):
        names, nu, scale = deployment(epoch + 100, {(rng.choice(["mc2", "mc4"]), rng.choice(["mc2", "mc6", "mc9"])): rng.choice((0.0, 4.0, 9.0, 60.0)) for _ in range(3)})
        rows += [(epoch, a, b, v, scale[a, b]) for (a, b), v in nu.items()]
        panels[epoch] = screening.Panel(names, nu, scale)
    table = spark.createDataFrame(rows, "epoch long, ref string, clock string, nu double, scale double")
    shifted = {(r.epoch, r.ref, r.clock) for r in links.self_test(table).where("excluded AND ref <> clock").collect()}
    assert shifted == {(e, *p) for e, panel in panels.items() for p in panel.pairs(panel.self_shift(panel.nu, panel.scale)) if p[0] != p[1]}
    left = table.join(spark.createDataFrame(sorted(shifted) or [(-1, "", "")], "epoch long, ref string, clock string"), ["epoch", "ref", "clock"], "left_anti")
    two_way = links.two_way(left).cache()
    for panel in panels.values():
        screening.screen(panel)
    told = {(e, what, *names) for e, panel in panels.items() for what, names in panel.findings}
    assert {(r.epoch, "reciprocity_fail", r.a, r.b) for r in two_way.where("NOT in_gate").collect()} == {t for t in told if t[1] == "reciprocity_fail"}
    assert {(r.epoch, "reference_fault", r.ref) for r in links.faulty_references(two_way).collect()} == {t for t in told if t[1] == "reference_fault"}
    failing = {r.epoch for r in two_way.where("NOT in_gate").collect()}
    closed = defaultdict(lambda: ([], []))
    for r in links.triangles(two_way).collect():
        closed[r.epoch][r.in_gate].append({r.a, r.b, r.c})
    expected = set()
    for epoch, (bad, good) in closed.items():
        if epoch not in failing and bad:
            expected |= {(epoch, "closure_fail", a, b) for a, b in combinations(("mc2", "mc4", "mc6", "mc9"), 2) if all({a, b} <= t for t in bad) and not any({a, b} <= t for t in good)}
    assert expected == {t for t in told if t[1] == "closure_fail" and t[0] not in failing} and {t[1] for t in told} >= {"self_fail", "self_missing", "reciprocity_fail"} - {"self_missing"}


def test_steering_reaches_both_sides_of_a_pair_at_its_own_instant(spark):
    """A pair is x_ref - x_clock; u1 is no reference, so its events move nothing. Epochs without a reading have rows of their own."""
    data = readings(spark, 4).where("NOT (ref = 'mc1' AND clock = 'u2' AND epoch = 1002)")
    settings = spark.createDataFrame([(c, (1, None, 30.0, 5.0, 40, 12, 144.0, 0.5, 50)) for c in ("mc1", "mc2", "mc3", "u1", "u2")], f"clock string, settings {folds.SETTINGS}")
    start = 1001 * 600_000_000
    events = [("mc1", start + 500_000, 40.0, 2.0), ("u1", start + 2_500_000, -7.0, 0.0), ("mc2", start - 30_000_000, 5.0, 1.0), ("u1", start - 600_000_000, 9.0, 0.0)]
    rows = folds.pair_inputs(data, settings, spark.createDataFrame(events, "ref string, applied_us long, dx double, dy double"), gap_limit=2).collect()
    assert len([r for r in rows if r.settings]) == data.count()
    unread = {(r.ref, r.clock, r.epoch) for r in rows if not r.settings}
    seen = {(r.ref, r.clock): sorted(q.epoch for q in rows if q.settings and (q.ref, q.clock) == (r.ref, r.clock)) for r in rows}
    expected = {(*p, e) for p, epochs in seen.items() for name, e in (("mc1", 1002), ("mc2", 1001)) if name in p and p[0] != p[1] and epochs[0] < e <= epochs[-1] + 2 and e not in epochs}
    assert unread == expected and ("mc1", "u2", 1002) in unread

    def inside(name, epoch, at):
        return sum(dx + dy * (at - us) / 1e6 for n, us, dx, dy in events if n == name and n != "u1" and epoch * 600_000_000 < us <= at)

    def before(name, epoch):
        end = epoch * 600_000_000
        own = [(dx + dy * (end - us) / 1e6, dy) for n, us, dx, dy in events if n == name and n != "u1" and end - 600_000_000 < us <= end]
        return sum(x for x, _ in own), sum(y for _, y in own)

    for r in rows:
        at, other = r.epoch * 600_000_000 + (r.offset_us or 0), r.ref != r.clock
        assert r.within == pytest.approx(other * (inside(r.ref, r.epoch, at) - inside(r.clock, r.epoch, at)))
        assert (r.move, r.rate) == pytest.approx(tuple(other * (q - c) for q, c in zip(before(r.ref, r.epoch), before(r.clock, r.epoch), strict=True)))
    assert len({r.within for r in rows}) > 3


def test_steered_series_have_no_innovations(spark):
    """Clocks without noise, x_ref - x_clock, under steering of phase and rate between, within and beside readings: nothing is left over."""
    first, n, names = 2000, 60, ["mc1", "mc2", "u1"]
    rates = {"mc1": 0.0, "mc2": 0.0125, "u1": -0.02}
    events = [("mc1", (first + 20) * 600_000_000 - 77_000_000, 64.0, 0.5), ("mc2", (first + 31) * 600_000_000 + 1_500_000, -96.0, -0.25), ("mc1", (first + 41) * 600_000_000 + 300_000_000, 0.0, 0.125)]

    def x(name, us):
        return rates[name] * (us / 1e6 - first * 600) + sum(dx + dy * (us - at) / 1e6 for ref, at, dx, dy in events if ref == name and at <= us)

    rows = []
    for e in range(first, first + n):
        for i, ref in enumerate(names[:2]):
            for j, clock in enumerate(names):
                if (ref, clock) in (("mc1", "u1"), ("mc1", "mc2")) and e - first in (20, 21, 42):
                    continue  # steered, and not read
                offset = 4_000_000 * (i + j)
                at = e * 600_000_000 + offset
                rows.append(("a", ref, clock, e, offset, round(x(ref, at) - x(clock, at)) % 200_000, 2))
    data = spark.createDataFrame(rows, "channel string, ref string, clock string, epoch long, delta_us long, phase long, rms int")
    settings = spark.createDataFrame([(c, (2, 20.0, 30.0, 4.0, 40, 12, 144.0, 0.5, 50)) for c in names], f"clock string, settings {folds.SETTINGS}")
    setup = history.Setup(settings=settings, steering=spark.createDataFrame(events, "ref string, applied_us long, dx double, dy double"))
    pairs = staged(history.pair_history(data, setup), "pairs")
    late = [r for r in pairs.where(f"epoch >= {first + 4}").collect() if r.ref != r.clock]
    assert not [(r.ref, r.clock, r.epoch, r.innovation, r.flags) for r in late if r.flags.strip("U") not in ("A", "P")] and max(abs(r.innovation or 0.0) for r in late) <= 2.5
    assert {(r.ref, r.clock, r.epoch - first) for r in late if "P" in r.flags} == {("mc1", c, e) for c in ("u1", "mc2") for e in (20, 21, 42)}
    known = links.pair_registry(pairs.where("z IS NOT NULL"))
    triples = history.triple_history(pairs, history.known_triples(known, setup), setup).where(f"epoch >= {first + 6} AND c = 'u1'").collect()
    assert {(r.r, r.s) for r in triples} == {("mc1", "mc1"), ("mc1", "mc2"), ("mc2", "mc1"), ("mc2", "mc2")}
    assert not [(r.r, r.s, r.c, r.epoch, r.innovation, r.flags) for r in triples if r.flags.strip("U") not in ("A", "P")] and max(abs(r.innovation or 0.0) for r in triples) <= 4
    assert min(r.epoch for r in triples if "P" in r.flags) == first + 20


def readings(spark, epochs=60):
    names, clocks, rows = ["mc1", "mc2", "mc3"], ["mc1", "mc2", "mc3", "u1", "u2"], []
    for e in range(epochs):
        for i, ref in enumerate(names):
            for j, clock in enumerate(clocks):
                if (e * 7 + i * 3 + j) % 23 == 0 or (clock == "u2" and 20 <= e < 24):
                    continue
                drift = (e * 5 + i + j) % 3 if clock in names else (j - i) * 300 * e + (e * 31 + i * 17 + j * 5) % 7
                jump = 5000 if clock == "u1" and e >= 40 else 200_000 if (ref, clock, e) == ("mc2", "u2", 30) else 0
                rows.append(("a", ref, clock, 1000 + e, 1_000_000 * (i + j), (drift + jump) % 200_000, 3))
    return spark.createDataFrame(rows, "channel string, ref string, clock string, epoch long, delta_us long, phase long, rms int")


def test_staged_folds_track_every_series(spark):
    data = readings(spark)
    settings = spark.createDataFrame([(c, (1, None, 30.0, 5.0, 40, 12, 144.0, 0.5, 50)) for c in ("mc1", "mc2", "mc3")] + [(c, (2, 20.0, 30.0, 50.0, 40, 12, 144.0, 0.5, 50)) for c in ("u1", "u2")], f"clock string, settings {folds.SETTINGS}")
    inputs = folds.pair_inputs(data, settings)
    refs = folds.reference_rows(inputs.where("clock LIKE 'mc%'")).cache()
    clocks = folds.clock_rows(inputs.where("clock NOT LIKE 'mc%'"), folds.reference_facts(refs)).cache()
    last = {(r.ref, r.clock): r for r in refs.union(clocks).where("epoch = 1059").collect()}
    assert len(last) == 15 and all("D" not in r.flags for r in last.values())
    assert abs(last["mc1", "u1"].step_offset - 5000) < 20
    again = folds.clock_rows(inputs.repartition(7).where("clock NOT LIKE 'mc%'"), folds.reference_facts(refs))
    assert sorted(map(tuple, clocks.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    triples = spark.createDataFrame([("mc2", "mc1", "u1"), ("mc1", "mc1", "u1")], "r string, s string, c string")
    made = folds.triple_inputs(refs.union(clocks), triples, settings).cache()
    local = made.where("r = s").join(clocks.select("epoch", F.col("ref").alias("s"), F.col("clock").alias("c"), F.col("z").alias("own"), "flags"), ["epoch", "s", "c"])
    assert local.where("z IS NOT NULL AND z <> own").count() == 0
    out = folds.triple_rows(made)
    assert {r.flags for r in out.where("epoch = 1030").collect()} <= {"A", "AU", "P", "PU", "RD"} and out.count() > 100


def test_disabled_readings_are_kept_and_the_series_starts_anew(spark):
    data = readings(spark, 30).where("ref = 'mc1' AND clock = 'u1'")
    settings = spark.createDataFrame([("u1", (2, 20.0, 30.0, 50.0, 40, 12, 144.0, 0.5, 50))], f"clock string, settings {folds.SETTINGS}")
    off = spark.range(1010, 1015).select(F.lit("u1").alias("clock"), F.col("id").alias("epoch"))
    inputs = folds.pair_inputs(data, settings, disabled=off).withColumn("facts", F.lit(None).cast("array<struct<ref string>>"))
    rows = {r.epoch: r for r in folds._folded(inputs, ["channel", "clock"], False).collect()}
    assert [rows[e].flags for e in (1010, 1012, 1014)] == ["O"] * 3 and rows[1010].z == rows[1009].z
    assert rows[1015].flags == "RD" and rows[1029].flags.startswith("A")


def test_every_event_enters_the_histories(spark):
    sf = "/root/testdata/sf0.001"
    pairs = queries.pair_history(spark, sf).where("z IS NOT NULL")
    assert pairs.count() == proxies.raw(spark, sf).count()
    assert {r.ref for r in pairs.select("ref").distinct().collect()} == {"mc0", "mc1", "mc2", "mc3"}


def test_quiet_epochs_are_told_without_a_panel():
    """Where the short way says that nothing can fail, the tests find nothing, for references and for a clock."""
    rng, quiet = random.Random(4), 0
    names = ["mc1", "mc2", "mc3", "mc4"]
    for _ in range(400):
        size = rng.choice((0.5, 1.5, 3.0, 90_000.0))
        nu = {(a, b): rng.uniform(-size, size) for a in names for b in names if rng.random() > 0.1}
        scale = {p: rng.uniform(0.8, 1.6) for p in nu}
        panel = screening.Panel(names, nu, scale)
        screening.screen(panel)
        slipped = [screening.slips(panel, panel.nu[:, i], panel.scale[:, i], panel.usable[:, i], np.ones(4, bool)) for i in range(4)]
        if folds._quiet(nu.values(), scale.values()):
            quiet += 1
            assert not panel.excluded and not panel.held.any() and all(s is None and not unsure.any() for s, unsure in slipped)
        facts = [{"ref": a, "clock": b, "nu": nu[a, b], "prior_scale": scale[a, b], "excluded": False, "ref_held": False} for a, b in nu]
        own = {(n, "u1"): rng.uniform(-1, 1) * rng.choice((1.0, 50_000.0, 200_000.0)) for n in names}
        reach = max(own.values()) - min(own.values()) + max(abs(f["nu"]) for f in facts)
        alarmed = any(a == b and abs(v) > 5.0 * scale[a, b] for (a, b), v in nu.items())
        if 2 * reach < 200_000 and not alarmed:
            panel = screening.Panel(names, nu, scale)
            one = np.ones(4)
            assert screening.slips(panel, np.array([own[n, "u1"] for n in names]), one, one > 0, one > 0)[0] is None
            assert not panel.self_shift(np.array([[own[n, "u1"]] for n in names]), one[:, None]).any()
    assert 40 < quiet < 360
