"""Windows over blocks and medians by ranges against windows over whole series and plain medians."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickloom.operators import blocks, medians, series


def plain_merged(spans, least_apart):
    found = []
    for start, end in sorted(spans):
        if found and start - found[-1][1] < least_apart:
            found[-1][1], found[-1][2] = max(found[-1][1], end), found[-1][2] + 1
        else:
            found.append([start, end, 1])
    return found


@pytest.mark.parametrize("size", [1, 5, 16, 4096])
def test_merged_spans_equal_a_walk(spark, size):
    rng = random.Random(size)
    own = {k: [(s, s + rng.choice([1, 1, 2, 9, 60])) for s in (rng.randrange(-80, 300) for _ in range(rng.choice([1, 20, 60])))] for k in (None, "a", "b", "c", "d")}
    frame = spark.createDataFrame([(k, s, e) for k, spans in own.items() for s, e in spans], "k string, start long, end long").repartition(3)
    for least_apart in (1, 4):
        got = {}
        for r in blocks.merged(frame, ["k"], least_apart, {"n": (F.count(F.lit(1)), F.sum)}, size).collect():
            got.setdefault(r.k, []).append([r.start, r.end, r.n])
        assert {k: sorted(v) for k, v in got.items()} == {k: plain_merged(v, least_apart) for k, v in own.items()}


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_series_operators_are_the_same_at_every_block_size(spark, monkeypatch, size):
    for f in (blocks.block_of, blocks.with_halo, blocks.with_previous, blocks.merged):
        monkeypatch.setattr(f, "__defaults__", (size,))
    rng = random.Random(3)
    rows = [(k, e, rng.randrange(0, 200_000), rng.random() < 0.6) for k in ("a", "b", None) for e in sorted(rng.sample(range(-60, 200), 150))]
    frame = spark.createDataFrame(rows, "k string, epoch long, phase long, bad boolean").repartition(3)
    by_key = {k: {e: (p, b) for kk, e, p, b in rows if kk == k} for k in ("a", "b", None)}
    changes = {(r.k, r.epoch): r.change for r in series.one_epoch_changes(frame, ["k"]).collect()}
    assert changes == {(k, e): 100_000 - (100_000 - (p - v[e - 1][0])) % 200_000 for k, v in by_key.items() for e, (p, _) in v.items() if e - 1 in v}
    spread = {(r.k, r.epoch): (r.med, r.mad) for r in series.sliding_spread(series.one_epoch_changes(frame, ["k"]), ["k"]).collect()}
    wanted = {}
    for k, e in changes:
        near = [c for (kk, x), c in changes.items() if kk == k and abs(x - e) <= series.HALF_WINDOW]
        if len(near) >= series.LEAST_CHANGES:
            wanted[k, e] = (statistics.median(near), statistics.median(abs(c - statistics.median(near)) for c in near))
    assert spread == wanted and len(wanted) > 50
    runs = {}
    for k, v in by_key.items():
        span, last = None, max(e for e, (_, b) in v.items() if not b)
        for e in sorted(v):
            if not v[e][1]:
                span = None
            elif span is None:
                span = [e, e + 1]
                runs.setdefault(k, []).append(span)
            else:
                span[1] = e + 1
        runs[k] = [(s, e, last < s) for s, e in runs[k]]
    got = {}
    for r in series.runs(frame, ["k"]).collect():
        got.setdefault(r.k, []).append((r.start, r.end, r.open_ended))
    assert {k: sorted(v) for k, v in got.items()} == runs


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_pieces_and_cold_starts_number_on_across_blocks(spark, monkeypatch, size):
    for f in (blocks.block_of, blocks.with_previous):
        monkeypatch.setattr(f, "__defaults__", (size,))
    rng = random.Random(4)
    rows = [("a", e, rng.choice(["A", "AN", "D", "R"]), 10 * e, 3) for e in sorted(rng.sample(range(100), 70))]
    frame = spark.createDataFrame(rows, "k string, epoch long, flags string, z long, step_offset long")
    got = sorted((r.epoch, r.stretch, r.value) for r in series.cold_start_stretches(frame, ["k"]).collect())
    want, n, before = [], 0, ""
    for _, e, flags, z, off in rows:
        n += "N" in flags and "D" in before
        before = flags
        if "A" in flags:
            want.append((e, n, z - off))
    assert got == want
    values = [("a", e, e * 5 + (1000 if e > 50 else 0) + (2000 if e > 77 else 0)) for e in sorted(rng.sample(range(100), 60))]
    limits = spark.createDataFrame([("a", 0, 5.0, 50.0)], "k string, day long, med double, limit double")
    pieces = sorted((r.epoch, r.piece) for r in series.split_at_jumps(spark.createDataFrame(values, "k string, epoch long, phase long"), limits, ["k"]).collect())
    assert pieces == [(e, (e > 50) + (e > 77)) for _, e, _ in values]


@pytest.mark.parametrize("ranges,most_held", [(2, 1), (3, 4), (1024, 4096)])
def test_medians_by_ranges_are_exact(spark, ranges, most_held):
    rng = random.Random(ranges)
    own = {"even": [rng.gauss(0, 1) for _ in range(40)], "odd": [rng.lognormvariate(0, 9) for _ in range(31)], "ties": [1.0] * 20 + [2.0] * 20, "one": [-7.5], "two": [1e300, -3.0], "same": [4.0] * 9, None: [5.0, 6.0, None, 8.0], "none": [None]}
    frame = spark.createDataFrame([(k, v) for k, vs in own.items() for v in vs], "k string, v double").repartition(3)
    got = {r.k: r.med for r in medians.exact_median(frame, ["k"], "v", ranges=ranges, most_held=most_held).collect()}
    assert got == {r.k: r.m for r in frame.where("v IS NOT NULL").groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert medians.exact_median(frame.where("false"), ["k"], "v").count() == 0
