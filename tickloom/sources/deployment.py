"""Readings of a made-up deployment, a pure function of (seed, pair, epoch): the same rows whatever the partitions.

Every pair has its own slot in an epoch, a linear phase, white phase noise and, if asked for, a random walk summed by blocks of
epochs, so that a year of it is as parallel as a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import PERIOD_PS
from ..functions.timefn import EPOCH_US
from ..operators import blocks

#: 2025-01-01, and the part of an epoch over which its readings spread.
START_EPOCH, SPREAD_S = 2_892_816, 500


def pairs(spark: SparkSession, references: int, clocks: int, every_reference: bool = True) -> DataFrame:
    """slot, ref and clock: references measure each other and themselves; every one measures each clock, or each clock has one."""
    names = spark.range(references).select(F.col("id").alias("i"), F.concat(F.lit("mc"), F.col("id").cast("string")).alias("ref"))
    others = spark.range(clocks).select(F.col("id").alias("j"), F.concat(F.lit("hm"), F.col("id").cast("string")).alias("clock"))
    among = names.select("i", "ref", F.explode(F.sequence(F.lit(0), F.lit(references - 1))).alias("j")).select("i", "ref", F.col("j").cast("long").alias("j"), F.concat(F.lit("mc"), F.col("j").cast("string")).alias("clock"))
    # references are ten at most, so their names can be sent to every task
    measured_by = F.sequence(F.lit(0), F.lit(references - 1)) if every_reference else F.array((F.col("j") % references).cast("int"))
    of_clocks = others.withColumn("i", F.explode(measured_by.cast("array<bigint>"))).join(F.broadcast(names), "i").select("i", "ref", (F.col("j") + references).alias("j"), "clock")
    return among.unionByName(of_clocks).select((F.col("i") * (references + clocks) + F.col("j")).alias("slot"), "ref", "clock")


def _normal(*of: Column) -> Column:
    """Twelve even deviates of a hash added up: mean 0, deviation 1."""
    unit = lambda k: F.pmod(F.xxhash64(*of, F.lit(k)), F.lit(2**32)) / 2.0**32
    total = unit(0)
    for k in range(1, 12):
        total = total + unit(k)
    return total - 6


def readings(spark: SparkSession, references: int, clocks: int, epochs: int, seed: int = 0, white_ps: float = 3.0, walk_ps: float = 0.0, every_reference: bool = True) -> DataFrame:
    """channel, ref, clock, epoch, delta_us, phase and rms of every pair and epoch."""
    slots, end = references * (references + clocks), START_EPOCH + epochs
    first = F.explode(F.sequence(F.lit(START_EPOCH).cast("long"), F.lit(end - 1).cast("long"), F.lit(blocks.BLOCK_EPOCHS).cast("long")))
    cut = pairs(spark, references, clocks, every_reference).withColumn("first", first).repartition("slot", "first")
    made = cut.withColumn("epoch", F.explode(F.sequence("first", F.least(F.col("first") + blocks.BLOCK_EPOCHS, F.lit(end)) - 1)))
    at = [F.lit(seed), F.col("slot"), F.col("epoch")]
    noise = F.rint(_normal(*at, F.lit("white")) * white_ps)
    if walk_ps:
        # whole steps, so that their sum does not depend on its order
        made = made.withColumn("_block", blocks.block_of(F.col("epoch"))).withColumn("_step", F.rint(_normal(*at, F.lit("walk")) * walk_ps).cast("long"))
        made = blocks.numbered(made, ["slot"], "_step", "_walk")
        noise = noise + F.col("_walk")
    delta = F.lit(1_000_000) + F.floor(F.col("slot") * SPREAD_S * 1_000_000 / slots).cast("long")
    seconds = (F.col("epoch") - START_EPOCH) * (EPOCH_US // 1_000_000) + F.floor(delta / 1_000_000)
    linear = F.col("slot") * 1000 + F.floor((F.col("slot") % 7 - 3) * seconds / 100)
    phase = F.pmod(linear + noise, F.lit(PERIOD_PS)).cast("long")
    return made.select(F.lit("a").alias("channel"), "ref", "clock", "epoch", delta.alias("delta_us"), phase.alias("phase"), F.lit(3).alias("rms"))
