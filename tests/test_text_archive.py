"""Fixed-width archives of pairs and triples: files on disk, read by slices and written back."""

import pytest
from pyspark.sql import functions as F

from tickloom.plans import queries
from tickloom.sources import text_archive as ta

STATE = ["x_fs", "y", "d", "innovation_scale", "step_offset", "epochs_in_segment", "epochs_since_accept", "consecutive_rejects", "reject_fraction", "buffer", "filter_states", "time_constant", "scale_time_constant", "flags"]
ROW = "channel string, ref string, clock string, epoch long, measured_us long, measured_phase long, rms long, cycle_count long, z long, x_fs long, y double, d double, innovation_scale double, step_offset long, epochs_in_segment long, epochs_since_accept long, consecutive_rejects long, reject_fraction double, buffer array<struct<epoch long, value double>>, filter_states long, time_constant double, scale_time_constant double, flags string"
US = 600_000_000


def pair(epoch, **more):
    plain = dict(channel="a", ref="mc1", clock="hm1", epoch=epoch, measured_us=epoch * US + 1_234_567, measured_phase=5, rms=3, cycle_count=-1, z=-199_995, x_fs=-1, y=0.1, d=None, innovation_scale=2.0, step_offset=0, epochs_in_segment=1, epochs_since_accept=0, consecutive_rejects=0, reject_fraction=0.0, buffer=[], filter_states=2, time_constant=None, scale_time_constant=30.0, flags="A")
    return plain | more


EDGES = [
    pair(2_920_000),
    pair(2_920_001, measured_us=None, measured_phase=None, rms=None, cycle_count=None, z=None, x_fs=None, y=None, innovation_scale=None, flags="P"),
    pair(2_920_002, cycle_count=None, flags="O"),
    pair(2_920_003, x_fs=10**18 + 7, y=-1e-99, d=1.7976931348623157e99, buffer=[(2_919_000, 1.5), (2_919_001, -0.1)], flags="RU"),
    pair(2_920_004, x_fs=-999, buffer=[(1, 0.0), (2, 1e-9), (3, -2.0)], flags=""),
]


def write(folder, name, lines):
    (folder / name).write_text("# pairs, format 1\n#   1  interpolated_datetime\n" + "".join(f"{line}\n" for line in lines))


def test_rows_of_every_form_come_back(spark, tmp_path):
    frame = spark.createDataFrame([tuple(r.values()) for r in EDGES], ROW)
    lines = [r.value for r in ta.encode(frame, "meas").orderBy("epoch").collect()]
    assert {len(line) for line in lines} == {ta.width("meas")}
    assert lines[0].startswith("2025-07-08 18:40:00+00:00,  60864.777777, 2025-07-08 18:40:01.234567+00:00, ") and "             -0.001, " in lines[0]
    write(tmp_path, "das_a.mc1.hm1.dat", lines)
    write(tmp_path, "das_b.mc1.hm1.dat", lines[:1])
    write(tmp_path, "das_a.mc1.mc1.hm1.dat", [])
    back = ta.decode(ta.lines(spark, str(tmp_path), "meas", "a"), "meas")
    got = sorted((r.asDict(recursive=True) for r in back.drop("offset_s").collect()), key=lambda r: r["epoch"])
    assert got == [r | {"buffer": [dict(zip(("epoch", "value"), b)) for b in r["buffer"]]} for r in EDGES]
    some = ta.decode(ta.lines(spark, str(tmp_path), "meas", "a"), "meas", (2_920_001, 2_920_003))
    assert sorted(r.epoch for r in some.collect()) == [2_920_001, 2_920_002, 2_920_003]
    assert {(r.epoch, r.offset_s) for r in ta.offsets(spark, str(tmp_path), "a").collect()} == {(e, 1.234567) for e in (2_920_000, 2_920_002, 2_920_003, 2_920_004)}
    assert ta.phases(spark, str(tmp_path), "a").count() == 4


def test_names_tell_pairs_from_triples(spark, tmp_path):
    made = queries._states(spark.createDataFrame([("mc1", "mc1", "hm1", 2_920_000 + e, e, 70 * e, e - 3, 0.5, 2.5, "110") for e in range(9)], "r string, s string, c string, epoch long, event_id long, phase long, z long, innovation double, double_difference_sigma double, components_used string"))
    write(tmp_path, "das_a.mc1.mc1.hm1.dat", [r.value for r in ta.encode(made, "ddiff").collect()])
    write(tmp_path, "das_a.mc1.hm1.dat", [])
    read = ta.lines(spark, str(tmp_path), "ddiff", "a")
    assert {(r.r, r.s, r.c) for r in read.collect()} == {("mc1", "mc1", "hm1")}
    back = {r.epoch: r for r in ta.decode(read, "ddiff").collect()}
    assert len(back) == 9 and all(r.asDict()[c] == back[r.epoch].asDict()[c] for r in made.collect() for c in [*STATE, "z", "innovation", "double_difference_sigma", "components_used"])


@pytest.mark.parametrize("spoil", [lambda line: line[:-1], lambda line: line + " ", lambda line: line.replace("-0.001", " 0.01 "), lambda line: line.replace("+1.0000000000000000e-01", "+1.0000000000000000x-01")])
def test_spoilt_rows_are_errors(spark, tmp_path, spoil):
    line = ta.encode(spark.createDataFrame([tuple(EDGES[0].values())], ROW), "meas").first().value
    write(tmp_path, "das_a.mc1.hm1.dat", [spoil(line)])
    with pytest.raises(Exception, match="."):
        ta.decode(ta.lines(spark, str(tmp_path), "meas", "a"), "meas").collect()


def test_a_value_wider_than_its_column_is_an_error(spark):
    wide = spark.createDataFrame([tuple(pair(2_920_000, rms=10_000).values())], ROW)
    with pytest.raises(Exception, match="rms does not fit"):
        ta.encode(wide, "meas").select(F.length("value")).collect()
