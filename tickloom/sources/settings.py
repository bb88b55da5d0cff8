"""Clock settings as tables: type defaults, dated overrides a clock, and rms limits, from one JSON document.

{"types": {name: {fields}}, "clocks": {name: [{"effective_mjd": number or absent, "type": name, fields}]},
 "rms_limit": {"default": n, "references": {ref: n}, "pairs": {"ref.clock": n}}}

Fields are states, m, m_sigma, sigma0, gap_limit, location and disabled. An override holds from the first epoch at or after
its date; undated ones come first, later ones win, and an absent field keeps what was in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import EPOCHS_PER_DAY
from ..operators import links

FIELDS = {"states": "int", "m": "double", "m_sigma": "double", "sigma0": "double", "gap_limit": "int", "location": "int", "disabled": "boolean"}
_FIELD_TYPES = ", ".join(f"{k}: {t}" for k, t in FIELDS.items())
_DOCUMENT = f"types map<string, struct<{_FIELD_TYPES}>>, clocks map<string, array<struct<effective_mjd: double, type: string, {_FIELD_TYPES}>>>, rms_limit struct<default: int, references: map<string, int>, pairs: map<string, int>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row with the whole document; a malformed one is an error."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", _DOCUMENT, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def entries(document: DataFrame) -> DataFrame:
    """clock, epoch (null: undated), number and fields of every override, the type's defaults filled in where a type is named."""
    types = document.select(F.explode("types").alias("type", "t"))
    dated = document.select(F.explode("clocks").alias("clock", "list")).select("clock", F.posexplode("list").alias("number", "e"))
    epoch = F.ceil(F.col("e.effective_mjd") * EPOCHS_PER_DAY - 1e-6).cast("long")
    named = dated.select("clock", "number", epoch.alias("epoch"), F.col("e.type").alias("type"), *(F.col(f"e.{k}").alias(k) for k in FIELDS))
    known = named.join(types, "type", "left")
    missing = F.col("type").isNotNull() & F.col("t").isNull()
    checked = F.when(missing, F.raise_error(F.concat(F.lit("no type "), "type")).cast("string")).otherwise(F.col("clock"))
    return known.select(checked.alias("clock"), "epoch", "number", *(F.coalesce(F.col(k), F.col(f"t.{k}")).alias(k) for k in FIELDS))


def intervals(document: DataFrame) -> DataFrame:
    """clock, from, to (epochs, half open, null: no end) and the fields in force."""
    return links.setting_intervals(entries(document), ["clock"], list(FIELDS), "epoch", "number")


def disabled_spans(document: DataFrame) -> DataFrame:
    """clock, start, end and open_ended of the spans in which a clock is switched off."""
    off = intervals(document).where("disabled")
    spans = off.select("clock", F.coalesce("from", F.lit(0)).alias("start"), F.col("to").alias("end"), F.col("to").isNull().alias("open_ended"))
    ended = spans.withColumn("end", F.coalesce("end", F.lit(2**40)))
    from ..operators import series

    return series.joined_spans(ended, ["clock"], 1)


def rms_limits(document: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Limits by pair (ref, clock), by reference, and the default, as `links.limits_with_fallback` takes them."""
    pair = F.split(F.col("key"), r"\.")
    by_pair = document.select(F.explode("rms_limit.pairs").alias("key", "limit")).select(pair[0].alias("ref"), pair[1].alias("clock"), "limit")
    by_ref = document.select(F.explode("rms_limit.references").alias("ref", "limit"))
    return by_pair, by_ref, document.select(F.col("rms_limit.default").alias("limit"))
