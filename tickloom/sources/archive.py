"""Result tables: Parquet by kind, channel and day; reading the newest state, cutting back and redoing from an epoch.

`commit` adds the rows of several kinds as one version: every kind's files go to a folder of their own, and a manifest that is
written last names the folders and the last epoch that is kept of each. Readers go by the newest whole manifest, so a job that
ends between two kinds leaves the version before; what it wrote is in no manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import EPOCHS_PER_DAY
from ..operators import rows as row_rules
from ..operators import series


def write(rows: DataFrame, folder: str, kind: str, mode: str = "append") -> None:
    """Rows with channel and epoch into <folder>/<kind>, a partition a channel and day; dormant unmeasured rows are left out.

    A Spark job's commit makes all of it visible or nothing.
    """
    kept = rows.where(row_rules.is_written(F.col("flags"))).withColumn("day", F.floor(F.col("epoch") / EPOCHS_PER_DAY).cast("long"))
    writer = kept.repartition("channel", "day").sortWithinPartitions("epoch").write.mode(mode).partitionBy("channel", "day")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{kind}")


def read(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{kind}")


def existing_series(archive: DataFrame, keys: Sequence[str]) -> DataFrame:
    return archive.select("channel", *keys).distinct()


def newest(archive: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each series, from which a run goes on."""
    return series.newest_rows(archive.drop("day"), ["channel", *keys])


def usable(archive: DataFrame) -> DataFrame:
    """Accepted, settled rows with their phase less all steps."""
    return archive.where(row_rules.is_usable(F.col("flags"))).withColumn("value", F.col("z") - F.col("step_offset"))


def cut_after(spark: SparkSession, folder: str, kind: str, epoch: int, to: str) -> DataFrame:
    """The archive up to an epoch, written to another folder; whole days before it are pruned by partition, not compared."""
    day = epoch // EPOCHS_PER_DAY
    kept = read(spark, folder, kind).where((F.col("day") < day) | ((F.col("day") == day) & (F.col("epoch") <= epoch)))
    kept.write.partitionBy("channel", "day").parquet(f"{to}/{kind}")
    return read(spark, to, kind)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def version(spark: SparkSession, folder: str) -> int | None:
    """The newest whole version, null where there is none."""
    path, files = _file_system(spark, f"{folder}/manifests")
    if not files.exists(path):
        return None
    whole = [int(f.getPath().getName()) for f in files.listStatus(path) if _whole(files, f.getPath())]
    return max(whole, default=None)


def _whole(files, path) -> bool:
    return files.exists(path.suffix("/_SUCCESS"))  # Spark writes it when a job has been committed


def _entries(spark: SparkSession, folder: str, number: int) -> list[tuple[str, str, int | None]]:
    return [(r.kind, r.path, r.kept) for r in spark.read.schema(_MANIFEST).json(f"{folder}/manifests/{number}").collect()]


_MANIFEST = "kind string, path string, kept long"


def commit(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], after: int | None = None) -> int:
    """Add rows of all kinds as one version; its number. Of earlier versions rows after an epoch, or all where it is null, are no longer seen.

    A manifest has a row a kind and run, so it is read whole on the driver.
    """
    old = version(spark, folder)
    entries = [] if old is None or after is None else [(kind, path, after if kept is None else min(kept, after)) for kind, path, kept in _entries(spark, folder, old)]
    run = uuid.uuid4().hex
    for kind, rows in tables.items():
        write(rows, f"{folder}/runs/{run}", kind, "errorifexists")
        entries.append((kind, f"runs/{run}/{kind}", None))
    number = 0 if old is None else old + 1
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{folder}/manifests/{number}")
    return number


def committed(spark: SparkSession, folder: str, kind: str, number: int | None = None) -> DataFrame | None:
    """The rows of one kind in a version, the newest where none is given; null where there is no version of it."""
    number = version(spark, folder) if number is None else number
    entries = [] if number is None else [(path, kept) for k, path, kept in _entries(spark, folder, number) if k == kind]
    found = None
    for path, kept in entries:
        whole, files = _file_system(spark, f"{folder}/{path}")
        if not any(f.isDirectory() for f in files.listStatus(whole)):  # a run without rows
            continue
        rows = spark.read.parquet(f"{folder}/{path}")
        rows = rows if kept is None else rows.where((F.col("epoch") <= kept) & (F.col("day") <= kept // EPOCHS_PER_DAY))
        found = rows if found is None else found.unionByName(rows)
    return found
