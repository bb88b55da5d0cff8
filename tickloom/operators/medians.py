"""Exact medians of groups of any size: the middle is found by counting value ranges, never by holding a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged

#: Ranges that a pass cuts a range of values into, and rows that a range may hold before it is cut no further.
RANGES, MOST_HELD = 1024, 4096


def exact_median(rows: DataFrame, keys: Sequence[str], value: str, name: str = "med", ranges: int = RANGES, most_held: int = MOST_HELD) -> DataFrame:
    """keys and name, the median of each group's values as F.median gives it; nulls don't count, values are finite.

    A pass counts the values of each of the ranges between a group's least and greatest value, which combines before the
    shuffle, and keeps the one or two that hold the middle ranks. Ranges that hold more than most_held values, not all equal,
    are cut again; their ends are values of their own, so every pass parts them. A group without values has no row. The rows
    are read once at the start, once a pass and once in the end, so stage them.
    """
    named = [f"_k{i}" for i in range(len(keys))]
    values = rows.where(F.col(value).isNotNull()).select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), F.col(value).cast("double").alias("_v"))
    whole = values.groupBy(*named).agg(F.count(F.lit(1)).alias("_held"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    middle = F.array(F.floor((F.col("_held") - 1) / 2).cast("long"), F.floor(F.col("_held") / 2).cast("long"))
    wanted = staged(whole.withColumn("_ranks", middle), "ranges")
    while wanted.where((F.col("_low") < F.col("_high")) & (F.col("_held") > most_held)).limit(1).count():
        wanted = staged(_narrowed(values, wanted, named, ranges), "ranges")
    counted = _within(values, wanted, named).groupBy(*named, "_low", "_high", "_ranks", "_v").agg(F.count(F.lit(1)).alias("_n"))
    hit = F.size(_ranks_of(counted, [*named, "_low"], "_v"))
    found = counted.select(*named, "_v", hit.alias("_hit")).where("_hit > 0").groupBy(*named).agg(F.sum(F.col("_v") * F.col("_hit") * 0.5).alias(name))
    return found.select(*(F.col(n).alias(k) for k, n in zip(keys, named, strict=True)), name)


def _within(values: DataFrame, wanted: DataFrame, named: Sequence[str]) -> DataFrame:
    """values that lie in the wanted ranges of their group."""
    other = wanted.withColumnsRenamed({n: f"_r{n}" for n in named})
    same = [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in named]
    return values.join(other, [*same, F.col("_v") >= F.col("_low"), F.col("_v") <= F.col("_high")]).drop(*(f"_r{n}" for n in named))


def _ranks_of(counted: DataFrame, by: Sequence[str], order: str) -> Column:
    """The wanted ranks, counted from the row's own first, that a row's _n values hold."""
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    return F.filter(F.transform("_ranks", lambda r: r - before), lambda r: (r >= 0) & (r < F.col("_n")))


def _narrowed(values: DataFrame, wanted: DataFrame, named: Sequence[str], ranges: int) -> DataFrame:
    part = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * ranges
    place = F.when(F.col("_low") < F.col("_high"), F.least(F.floor(part).cast("long"), F.lit(ranges - 1))).otherwise(0)
    tried = _within(values, wanted, named).withColumn("_place", place)
    counted = tried.groupBy(*named, "_low", "_high", "_ranks", "_place").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    kept = counted.withColumn("_ranks", _ranks_of(counted, [*named, "_low"], "_place")).where(F.size("_ranks") > 0)
    return kept.select(*named, F.col("_n").alias("_held"), F.col("_least").alias("_low"), F.col("_most").alias("_high"), "_ranks")
