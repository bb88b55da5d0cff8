"""Clock tables made of the driver's tables: events stand for readings, their type for the reference, their user for the clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import EPOCH_US, epoch_of_us, unix_us
from ..operators import series

LATE_US = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ref, user_id, us, epoch, delta_us and phase of every event."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("ref"), "user_id", unix_us(F.col("ts")).alias("us"), (F.floor(F.col("value") * 1000).cast("long") % 200_000).alias("phase"))
    epoch = epoch_of_us(F.col("us"))
    return events.select("*", epoch.alias("epoch"), (F.col("us") - epoch * EPOCH_US).alias("delta_us"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reading of each reference and epoch that is not late."""
    return series.first_readings(raw(spark, sf_dir).where(EPOCH_US - F.col("delta_us") > LATE_US).select("ref", "epoch", "us", "event_id", "delta_us", "phase"), ["ref"], ["us", "event_id"])


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.one_epoch_changes(readings(spark, sf_dir), ["ref"])


def quiet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with an eighth of the phase, quiet enough for the limits of a running clock to matter."""
    return readings(spark, sf_dir).select("ref", "epoch", F.floor(F.col("phase") / 8).cast("long").alias("phase"))


def innovations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """epoch, ref, clock, nu and scale of every ordered pair of an epoch's references, of which there are five at most."""
    one = readings(spark, sf_dir).select("epoch", "ref", F.col("phase").alias("p"), "delta_us")
    two = readings(spark, sf_dir).select("epoch", F.col("ref").alias("clock"), F.col("phase").alias("q"))
    nu = F.col("p") * F.lit(0.25) - F.col("q") * F.lit(0.5)
    return one.join(two, "epoch").select("epoch", "ref", "clock", nu.alias("nu"), (F.lit(1000.0) + F.col("delta_us") % 4096).alias("scale"))


RAW = """raw AS (SELECT event_id, event_type AS ref, user_id, epoch_us(ts) AS us, epoch_us(ts) // 600000000 AS epoch, epoch_us(ts) % 600000000 AS delta_us,
 CAST(floor(value * 1000) AS BIGINT) % 200000 AS phase FROM events)"""
READINGS = f"""{RAW},
readings AS (SELECT ref, epoch, us, event_id, delta_us, phase FROM (SELECT *, row_number() OVER (PARTITION BY ref, epoch ORDER BY us, event_id) AS rn
 FROM raw WHERE 600000000 - delta_us > 10000000) WHERE rn = 1)"""


def changes_sql(source: str = "readings", name: str = "ch") -> str:
    return f"""{name} AS (SELECT ref, epoch, 100000 - (((100000 - d) % 200000 + 200000) % 200000) AS change FROM (SELECT ref, epoch,
 phase - lag(phase) OVER w AS d, epoch - lag(epoch) OVER w AS g FROM {source} WINDOW w AS (PARTITION BY ref ORDER BY epoch)) WHERE g = 1)"""


QUIET = f"{READINGS}, quiet AS (SELECT ref, epoch, phase // 8 AS phase FROM readings)"
LIMITS = """md AS (SELECT ref, epoch // 144 AS day, CAST(median(change) AS DOUBLE) AS med, count(*) AS n FROM ch GROUP BY ALL),
lim AS (SELECT ref, day, any_value(md.n) AS n, any_value(md.med) AS med, CAST(median(abs(change - md.med)) AS DOUBLE) AS mad FROM ch JOIN md ON ch.ref = md.ref AND ch.epoch // 144 = md.day GROUP BY ref, day),
limits AS (SELECT *, 5 * 1.4826 * mad AS lim FROM lim)""".replace("SELECT ref, day, any_value", "SELECT md.ref, md.day, any_value").replace("GROUP BY ref, day)", "GROUP BY md.ref, md.day)")
INNOVATIONS = f"""{READINGS}, nus AS (SELECT a.epoch, a.ref, b.ref AS clock, a.phase * 0.25::DOUBLE - b.phase * 0.5::DOUBLE AS nu, 1000.0::DOUBLE + a.delta_us % 4096 AS scale
 FROM readings a JOIN readings b ON a.epoch = b.epoch),
tw AS (SELECT x.epoch, x.ref AS a, x.clock AS b, x.nu + y.nu AS total, (x.nu - y.nu) / 2 AS value, sqrt(x.scale * x.scale + y.scale * y.scale) / 2 AS scale,
 abs(x.nu + y.nu) <= 5 * sqrt(x.scale * x.scale + y.scale * y.scale) AS in_gate FROM nus x JOIN nus y ON x.epoch = y.epoch AND x.ref = y.clock AND x.clock = y.ref AND x.ref < x.clock)"""
