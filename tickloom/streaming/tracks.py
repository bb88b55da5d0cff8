"""The same transition over a stream: tumbling ten-minute epochs, and one state a series with a time limit.

`epochs` forms the epochs with a watermark, so late readings are refused as in a batch. `tracked` keeps each series' carried
row in the state store and steps it once an epoch; missing epochs are stepped when the next reading comes, and a series that
nothing measured for its gap limit is dropped by an event-time timeout, without the held rows that a batch still gives it. One
series' rows up to its last reading are those of the batch's transition; screening, steering and triples are the batch's alone.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timefn import EPOCH_S
from ..operators.estimator import Reading, Settings, Track

KEYS = ("channel", "ref", "clock")
OUT = "channel string, ref string, clock string, epoch long, z long, x_fs string, step_offset long, flags string"


def epochs(readings: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Readings and references (ten names at most, counted exactly) by channel and epoch, from a stream with a timestamp ts; an epoch comes out once it cannot change."""
    w = F.window("ts", f"{EPOCH_S} seconds")
    return readings.withWatermark("ts", late).groupBy("channel", w.alias("w")).agg(F.count(F.lit(1)).alias("n_readings"), F.size(F.collect_set("ref")).cast("long").alias("n_refs")).select("channel", F.floor(F.unix_micros("w.start") / (EPOCH_S * 1_000_000)).cast("long").alias("epoch"), "n_readings", "n_refs")


def tracked(measured: DataFrame, settings: Settings, late: str = "10 minutes") -> DataFrame:
    """OUT rows of a stream of (channel, ref, clock, epoch, z, rms) with an event time ts; z is the unwrapped phase.

    x_fs is text, so that large whole numbers pass through pandas unchanged.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        track: Track = pickle.loads(state.get[0]) if state.exists else Track()
        rows: list[tuple[Any, ...]] = []
        readings = sorted({(int(e), int(z), int(rms)) for f in frames for e, z, rms in zip(f.epoch, f.z, f.rms, strict=True)})
        for epoch, z, rms in readings:
            if track.epoch is not None and epoch <= track.epoch:
                continue
            while track.tracked and track.epoch + 1 < epoch:
                track.step(track.epoch + 1, settings, track.predict(), None)
                rows.append((*key, track.epoch, None, str(track.x_fs), track.step_offset, track.flags))
            if track.epoch is not None and track.epoch + 1 < epoch:
                track = Track()
            track.step(epoch, settings, track.predict(), Reading(z, float(rms), rms))
            rows.append((*key, epoch, z, str(track.x_fs), track.step_offset, track.flags))
        state.update((pickle.dumps(track),))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + (settings.gap_limit + 2) * EPOCH_S * 1000)
        yield pd.DataFrame([r for r in rows if not ("D" in r[-1] and "P" in r[-1])], columns=[c.split()[0] for c in OUT.split(", ")]).astype({"epoch": "int64", "z": "Int64", "step_offset": "int64"})

    timed = measured.withWatermark("ts", late)
    return timed.groupBy(*KEYS).applyInPandasWithState(step, OUT, "track binary", "append", GroupStateTimeout.EventTimeTimeout)
