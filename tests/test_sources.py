"""Readers and the archive."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.functions import numeric, timefn
from tickloom.operators import series, stretches
from tickloom.sources import archive, readings, steering


def test_daily_files(spark, tmp_path):
    good = "60941.000012  12345   10 1A01 u1\n60941.000020 199999 9999 2B02 mc1\n"
    bad = "60941.000030 200000 1 1A01 u2\nnot a line\n60941.0069 1 1 1A01 u3\n60942.000001 1 1 1A01 u3\n60941.006940 5 1 1A01 u3\n60941.000001 5 1 1A01 u4\n60941.000020 7 1 1A01 u1\n"
    (tmp_path / "cd5m5m_60941.dat").write_text(good + bad)
    (tmp_path / "cd5m5m_60940.dat").write_text("60940.5 broken\n")
    (tmp_path / "other.dat").write_text("x")
    rows = readings.parse(readings.lines(spark, str(tmp_path), 60941)).orderBy("line_no").collect()
    assert [r.reason for r in rows] == [None, None, "phase out of range", "malformed", "malformed", "wrong day", "late", "out of order", "duplicate"]
    assert (rows[0].ref, rows[0].clock, rows[0].phase, rows[0].delta_us) == ("mc1", "u1", 12345, 1_036_800)
    again = readings.render(spark.createDataFrame(rows[:2], readings.READINGS)).collect()
    assert [r.value.split() for r in again][1] == ["60941.000020", "199999", "9999", "2A00", "mc1"]
    (tmp_path / "cd5m5m_60943.dat").write_text("60943.000012  12345   10 1A01 u1")
    with pytest.raises(PySparkException, match="not ended"):
        readings.parse(readings.lines(spark, str(tmp_path), 60943)).collect()


def test_steering_files(spark, tmp_path):
    (tmp_path / "steer_mc1.dat").write_text("60941.251588 -1.5 2e-4\n60941.251588 0 0\n")
    rows = steering.read(spark, str(tmp_path)).collect()
    assert [(r.ref, r.dx, r.dy) for r in rows] == [("mc1", -1.5, 2e-4), ("mc1", 0.0, 0.0)]
    assert spark.range(1).select(timefn.us_to_timestamp(F.lit(rows[0].applied_us)).cast("string")).first()[0].endswith("06:02:17.2032")
    for line in ("60941.2 1", "60941.2 1 x", "60941.2 1 1\n60941.1 1 1", "60941.2 1 1é"):
        (tmp_path / "steer_mc1.dat").write_text(line + "\n")
        with pytest.raises(PySparkException, match="steering of mc1"):
            steering.read(spark, str(tmp_path)).collect()


def test_archive(spark, tmp_path):
    rows = [("a", "mc1", "u1", e, 10 * e, 0 if e < 150 else 7, "A" if e % 50 else "PD") for e in range(100, 300)]
    data = spark.createDataFrame(rows, "channel string, ref string, clock string, epoch long, z long, step_offset long, flags string")
    archive.write(data, str(tmp_path / "out"), "pairs")
    kept = archive.read(spark, str(tmp_path / "out"), "pairs")
    assert kept.count() == 196 and archive.newest(kept, ["ref", "clock"]).first().epoch == 299
    assert archive.usable(kept).where("epoch = 299").first().value == 2983
    cut = archive.cut_after(spark, str(tmp_path / "out"), "pairs", 199, str(tmp_path / "cut"))
    assert cut.agg(F.max("epoch")).first()[0] == 199 and archive.existing_series(cut, ["ref", "clock"]).count() == 1


def test_bad_stretches(spark):
    rows = []
    for ref, shift in (("mc1", 0), ("mc2", 3), ("mc3", 5)):
        for e in range(400):
            if 200 <= e < 300:
                rows.append((ref, "u1", e, (79_193 * e * e + 7001 * shift * e) % 200_000))
            else:
                rows.append((ref, "u1", e, (500 * e + (e * e * 31 + e * 7 + shift) % 101 % 11) % 200_000))
    data = spark.createDataFrame(rows, "ref string, clock string, epoch long, phase long")
    found = stretches.bad_stretches(series.one_epoch_changes(data, ["ref", "clock"]), 72).collect()
    assert [(r.clock, r.disabled_from, r.enabled_at, r.kind) for r in found] == [("u1", 200, 300, "no_signal")]
    quiet = data.where("epoch < 150")
    assert stretches.bad_stretches(series.one_epoch_changes(quiet, ["ref", "clock"]), 72).count() == 0


def test_scalar_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert [get(numeric.wrapped(F.lit(x))) for x in (30_000, 190_000, -100_000, 100_000)] == [30_000, -10_000, 100_000, 100_000]
    assert [get(numeric.half_even(F.lit(x))) for x in (3, 5, -3, -1, 4)] == [2, 2, -2, 0, 2]
    assert [get(timefn.epoch_to_mjd_text(F.lit(x))) for x in (8775540, 8775542)] == ["60941.250000", "60941.263888"]
    assert get(numeric.signed_phase(F.lit(-1234567))) == "-1234.567" and get(numeric.time_constant(F.lit(1500.0))) == 2
