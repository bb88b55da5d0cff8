"""Operators over series against plain loops."""

import math

from tickloom.operators import series
from tickloom.plans import proxies, queries

SF = "/root/testdata/sf0.01"


def plain_scale(values, scale=100.0):
    fraction = 0.0
    for nu in values:
        scale = 2.0 if nu is None else math.sqrt(max(0.875 * scale**2 + 0.125 * nu**2, 4.0))
        fraction = 0.875 * fraction + (0.125 if nu is not None and nu > 100 else 0.0)
    return scale, fraction


def test_every_reading_is_folded(spark):
    by_ref = {}
    for r in sorted(proxies.readings(spark, SF).collect(), key=lambda r: r.epoch):
        by_ref.setdefault(r.ref, []).append(r.phase / 1000)
    got = {r.ref: r for r in queries.scale_fold_all(spark, SF).collect()}
    assert set(got) == set(by_ref) and all(len(v) > 400 for v in by_ref.values())
    for ref, values in by_ref.items():
        scale, fraction = plain_scale(values)
        assert got[ref].n == len(values)
        assert math.isclose(got[ref].scale, scale, abs_tol=2e-6) and math.isclose(got[ref].reject_fraction, fraction, abs_tol=2e-6)


def test_folds_compose_across_blocks(spark, monkeypatch):
    rows = {"a": [(e - 40, (e * 37 % 500) - 100.0) for e in range(100)], "b": [(e * 5, 0.01) for e in range(90)], "c": [(1, 300.0), (2, None), (30, 120.0)], "d": [(9, None)], "e": [(7, 50.0)]}
    frame = spark.createDataFrame([(k, e, v) for k, own in rows.items() for e, v in own], "ref string, epoch long, nu double").repartition(5)
    for epochs in (1, 7, 4096):
        monkeypatch.setattr(series, "FOLD_EPOCHS", epochs)
        got = {r.ref: r for r in series.folded_scale(frame, ["ref"], "nu", 100).collect()}
        for ref, own in rows.items():
            scale, fraction = plain_scale([v for _, v in own])
            assert got[ref].n == len(own) and math.isclose(got[ref].scale, scale, rel_tol=1e-9) and math.isclose(got[ref].reject_fraction, fraction, abs_tol=1e-12)
