"""Windows over a series of any length: inside blocks of epochs first, then joined by one row a block.

No task ever holds a series (or the one key of rows that have none): a window is partitioned by the keys and the block, rows
near a block's edge are copied to the neighbour that needs them, and what earlier blocks hand on (a sum, a greatest value, the
last row) is a window over one row a block. Keys may be null; a null is a key of its own, as in a window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Epochs of a block, four weeks.
BLOCK_EPOCHS = 4096


def block_of(epoch: Column, size: int = BLOCK_EPOCHS) -> Column:
    return F.floor(epoch / size).cast("long")


def with_halo(rows: DataFrame, before: int, after: int, size: int = BLOCK_EPOCHS) -> DataFrame:
    """rows with _block, once for each block that has an epoch whose frame [epoch - before, epoch + after] holds them; _own in their own."""
    e = F.col("epoch")
    spread = rows.withColumn("_block", F.explode(F.sequence(block_of(e - after, size), block_of(e + before, size))))
    return spread.withColumn("_own", F.col("_block") == block_of(e, size))


def inside(keys: Sequence[str]):
    """The order of a block's rows."""
    return Window.partitionBy(*keys, "_block").orderBy("epoch")


def handed_on(rows: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """rows (with _block) with each named value of all earlier blocks, null in a series' first.

    A value is an aggregate of one block's rows and the function that makes one of several blocks' values.
    """
    one = rows.groupBy(*keys, "_block").agg(*(part.alias(name) for name, (part, _) in values.items()))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = one.select(*keys, "_block", *(whole(name).over(earlier).alias(name) for name, (_, whole) in values.items()))
    return beside(rows, carried, [*keys, "_block"])


def beside(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with other's columns by equal keys, nulls equal too; other has one row a key at most."""
    named = other.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return rows.join(named, same, "left").drop(*(f"_r_{k}" for k in keys))


def with_previous(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], size: int = BLOCK_EPOCHS) -> DataFrame:
    """rows with _block and _before, a struct of the epoch and these columns of the row before, however far away; null at the start."""
    row = F.struct("epoch", *columns)
    blocked = rows.withColumn("_block", block_of(F.col("epoch"), size))
    carried = handed_on(blocked, keys, {"_last": (F.max_by(row, "epoch"), lambda name: F.max_by(name, f"{name}.epoch"))})
    return carried.withColumn("_before", F.coalesce(F.lag(row).over(inside(keys)), F.col("_last"))).drop("_last")


def numbered(rows: DataFrame, keys: Sequence[str], mark: str, name: str) -> DataFrame:
    """rows (with _block) with name, the sum of mark (a whole number) over a series up to and with each row."""
    carried = handed_on(rows, keys, {"_sum": (F.sum(mark), F.sum)})
    own = F.sum(mark).over(inside(keys).rowsBetween(Window.unboundedPreceding, 0))
    return carried.withColumn(name, own + F.coalesce("_sum", F.lit(0))).drop("_sum")


def merged(spans: DataFrame, keys: Sequence[str], least_apart: int, values: Mapping[str, tuple[Column, Callable[[str], Column]]], size: int = BLOCK_EPOCHS) -> DataFrame:
    """keys, start, end and the values of the spans joined where one starts fewer than least_apart epochs after the furthest end before it.

    A block holds the spans that start in it. Of those that are left when they are joined there, only the first ones can lie
    near what earlier blocks reach, since each starts least_apart after all that the block has before it; so a span begins a
    new group if it lies far from the earlier blocks' furthest end, and else belongs to the last group begun before its block.
    """
    blocked = spans.withColumn("_block", block_of(F.col("start"), size))
    order = Window.partitionBy(*keys, "_block").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = blocked.withColumn("_new", F.coalesce((F.col("start") - reached >= least_apart).cast("int"), F.lit(1)))
    named = marked.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = [F.min("start").alias("start"), F.max("end").alias("end")]
    local = named.groupBy(*keys, "_block", "_group").agg(*parts, *(part.alias(name) for name, (part, _) in values.items())).drop("_group")
    one = local.groupBy(*keys, "_block").agg(F.max("start").alias("_start"), F.max("end").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    far = lambda start: F.coalesce(F.col(start) - F.col("_reach") >= least_apart, F.lit(True))
    reach = one.withColumn("_reach", F.max("_end").over(earlier))
    begun = reach.withColumn("_begun", F.max(F.when(far("_start"), F.col("_start"))).over(earlier)).drop("_start", "_end")
    found = beside(local, begun, [*keys, "_block"]).withColumn("_name", F.when(far("start"), F.col("start")).otherwise(F.col("_begun")))
    return found.groupBy(*keys, "_name").agg(*parts, *(whole(name).alias(name) for name, (_, whole) in values.items())).drop("_name")
