"""Folds are dealt by their rows, and whole numbers over one denominator round as fractions do."""

import random
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import functions as F

from tickloom.operators import folds
from tickloom.operators.estimator import GATE, Reading, Settings, Track, half_even, unwrap


def test_a_fold_of_few_bytes_is_more_than_one_task(spark):
    rows = spark.range(1200).select(F.lit("a").alias("channel"), F.lit("mc1").alias("r"), F.lit("mc1").alias("s"), F.concat(F.lit("u"), F.col("id") % 40).alias("c"), F.floor(F.col("id") / 40).alias("epoch"), F.lit(7).cast("long").alias("z"), F.lit(3.0).alias("sigma"), F.lit("111").alias("used"), F.lit(False).alias("restarted"), F.lit(0.0).alias("move"), F.lit(0.0).alias("rate"))
    value = F.lit("2,20.0,30.0,50.0,40,12,144.0,0.5,50")
    rows = rows.withColumn("settings", F.from_csv(value, "states int, m double, m_sigma double, sigma0 double, gap_limit int, breaks_at int, fraction_epochs double, fraction_limit double, rms_limit int"))
    dealt = folds.triple_rows(rows).withColumn("part", F.spark_partition_id()).collect()
    assert len(dealt) == 1200 and len({r.part for r in dealt}) > 3
    assert len({(r.c, r.part) for r in dealt}) == 40  # a series is one call's


def test_whole_numbers_round_as_fractions():
    rng = random.Random(5)
    for n, den in ((1, 2), (3, 2), (-1, 2), (-3, 2), (5, 4), (0, 3), *((rng.randint(-(10**9), 10**9), rng.randint(1, 10**4)) for _ in range(500))):
        assert half_even(n, den) == round(Fraction(n, den))
    for states in (1, 2, 3):
        s = Settings(states, 20.0, 30.0, 50.0)
        for _ in range(300):
            track = Track(epoch=1, x_fs=rng.randint(-(10**12), 10**12), y=rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 1), d=rng.uniform(-1, 1) * 1e-6, scale=rng.uniform(1, 9), states=states, m=20.0, m_sigma=30.0, flags="A")
            x, y, d = Fraction(track.x_fs, 1000), Fraction(track.y), Fraction(track.d)
            move, rate, offset, within = rng.uniform(-99, 99), rng.uniform(-1, 1), Fraction(rng.randrange(10**6), 10**6), rng.uniform(-9, 9)
            x += Fraction(move) + (600 * y if states > 1 else 0) + (180_000 * d if states > 2 else 0)
            p = track.predict(Fraction(move), rate)
            assert p.x == x and p.x_fs == round(x * 1000) and track.predict(move, rate).x == x
            moved = Fraction(p.y) * offset + Fraction(p.d) * offset * offset / 2
            phase = rng.randrange(200_000)
            n = round((x + moved + Fraction(within) - phase) / 200_000)
            assert unwrap(phase, offset, Fraction(within), p, None) == (n, round(phase + n * 200_000 - moved - Fraction(within))) == unwrap(phase, offset, within, p, None)
            z = round(x) + rng.randint(-30, 30)
            off, scale = z - x, track.scale
            assert p.innovation(z) == float(off)
            track.step(2, s, p, Reading(z, 1.0))
            assert ("A" in track.flags) == (abs(off) <= Fraction(GATE * scale))
            assert "A" not in track.flags or track.x_fs == round((x + Fraction(s.gains()[0]) * off) * 1000)


def test_facts_are_told_without_reading_them():
    fact = pa.struct([("ref", pa.string()), ("clock", pa.string()), ("nu", pa.float64()), ("prior_scale", pa.float64()), ("excluded", pa.bool_()), ("ref_held", pa.bool_())])
    said = lambda ref, clock, nu, scale, held=False: {"ref": ref, "clock": clock, "nu": nu, "prior_scale": scale, "excluded": False, "ref_held": held}
    cells = [None, [], [said("a", "a", 5.0, 1.0), said("a", "b", -70.0, 1.0)], [said("a", "a", 5.5, 1.0)], [said("a", "b", None, None, True)], [said("a", "a", None, None)]]
    found = folds._facts(pa.array(cells, pa.list_(fact)))
    assert [f and (f.reach, f.alarmed) for f in found] == [None, None, (70.0, False), (5.5, True), (0.0, True), (0.0, False)]
    assert found[2].all() == cells[2]
