"""A stream in several batches gives the rows of one walk."""

from pyspark.sql import functions as F

from tickloom.operators.estimator import Reading, Settings, Track
from tickloom.streaming import tracks


def test_stream_equals_one_walk(spark, tmp_path):
    settings = Settings(states=2, m=20.0, m_sigma=30.0, sigma0=50.0, gap_limit=3)
    values = {e: 10 * e + (500 if e > 1030 else 0) for e in range(1000, 1060) if e - 1000 not in (12, 13, 40, 41, 42, 43, 44)}
    schema = "channel string, ref string, clock string, epoch long, z long, rms int, ts timestamp"
    for part in range(4):
        rows = [("a", "mc1", "u1", e, z, 3) for e, z in values.items() if (e - 1000) // 15 == part]
        frame = spark.createDataFrame(rows, "channel string, ref string, clock string, epoch long, z long, rms int").withColumn("ts", F.timestamp_seconds(F.col("epoch") * 600))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = tracks.tracked(source, settings).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = [(r.epoch, r.z, r.x_fs, r.step_offset, r.flags) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("epoch").collect()]
    track, expected = Track(), []
    for e in range(1000, 1060):
        if track.epoch is None and e not in values:
            continue
        track.step(e, settings, track.predict(), Reading(values[e], 3.0, 3) if e in values else None)
        if "D" in track.flags and "P" in track.flags:
            track = Track()
            continue
        expected.append((e, values.get(e), str(track.x_fs), track.step_offset, track.flags))
    assert got == expected


def test_stream_of_epochs(spark, tmp_path):
    frame = spark.range(100).select(F.lit("a").alias("channel"), F.concat(F.lit("mc"), (F.col("id") % 3).cast("string")).alias("ref"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    tracks.epochs(source).writeStream.format("memory").queryName("epochs").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    rows = spark.table("epochs").orderBy("epoch").collect()
    assert [(r.epoch, r.n_readings, r.n_refs) for r in rows][:3] == [(0, 10, 3), (1, 10, 3), (2, 10, 3)]
