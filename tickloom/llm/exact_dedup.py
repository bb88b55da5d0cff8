"""Exact deduplication with keyed streaming state that never expires.

Two chained Structured Streaming queries, both restartable from their checkpoints and neither with Python on executors:

1. the documents stream through a map-only query that appends one short row a document: digest of the normalised text,
   identifier, length and content locator (file and row);
2. those rows feed a streaming aggregation by digest on RocksDB state. The state holds, per digest, the best row so far
   (identifier and locator) and the number of rows. Each micro-batch writes the states that it changed.

Then full bytes are checked on every hit, that is, wherever a digest has more than one row: those rows' texts are grouped
under their digests, copies being combined before the shuffle, and a digest that stands for more than one text has its rows
grouped by text instead. A text that is met once is not shuffled, only its digest is. So the result is exact for any digest,
and a hot group never meets in one task.

Defined results: a null text is empty, and empty (or all white space) texts are copies of each other; of rows that tie
in length and id, as repeated rows do, the first by file and row stays; a null id loses ties; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settings, shared_dir, staged

#: Files that a micro-batch takes at most.
FILES_PER_BATCH = 10_000
#: Digests with several rows that may be sent to every task, some 16 bytes each; more are joined by a shuffle.
BROADCAST_HITS = 500_000
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores need not set disk space aside
    "spark.sql.streaming.metricsEnabled": "false",
}


def _stream_path(spark: SparkSession, path: str) -> str:
    """A path that the streaming file source takes: a lone file has to be named by a pattern."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    lone = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
    return f"{path[:-1]}[{path[-1]}]" if lone else path


def normalised(text: Column) -> Column:
    """The text without any of space and \\t to \\r."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256_digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def exact_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """One row per row of the Parquet files in path: doc_id, keep_id, group_size, kept, digest, file_path, row_index.

    digest maps a normalised text (a Column) to a string. files_per_batch bounds a micro-batch of either stream.
    """
    work, source = shared_dir(spark, "exact-dedup"), _stream_path(spark, path)
    schema = spark.read.parquet(path).schema
    text = normalised(F.col(text_col))

    def columns(source: DataFrame) -> list[Column]:
        """The columns of a row's state and its place; the table may have a column _metadata of its own."""
        place = source.metadataColumn("_metadata")
        return [
            digest(text).alias("digest"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
            place["file_path"].alias("file_path"),
            place["row_index"].alias("row_index"),
        ]

    def read(schema, at: str) -> DataFrame:
        reader = spark.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(at)

    with settings(spark, ROCKSDB):
        told = read(schema, source)
        digests = told.select(*columns(told))
        digests.writeStream.format("parquet").option("checkpointLocation", f"{work}/digests-log").option("path", f"{work}/digests").trigger(availableNow=True).start().awaitTermination()
        best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "file_path", "row_index")).alias("best")
        state = read(digests.schema, f"{work}/digests").groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size"))

        def changed(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{work}/states/part={number}")

        state.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", f"{work}/states-log").trigger(availableNow=True).start().awaitTermination()

    rows = spark.read.schema(digests.schema).parquet(f"{work}/digests")
    states_schema = state.withColumn("batch", F.lit(0)).schema
    empty = rows.isEmpty()
    states = spark.createDataFrame([], states_schema) if empty else spark.read.schema(states_schema).parquet(f"{work}/states")
    newest = states.groupBy("digest").agg(F.max_by(F.struct("best", "group_size"), "batch").alias("s")).select("digest", "s.best", "s.group_size")
    newest = staged(newest, "exact-dedup-states")  # so that both sides of the last join are shuffles, whose hot partitions Spark splits

    hits = newest.where("group_size > 1").select(F.xxhash64("digest").alias("hit"))
    n_hits = hits.count()
    if not n_hits:
        return _joined(rows, newest, ["digest"])
    contents = spark.read.schema(schema).parquet(path).select(digest(text).alias("digest"), text.alias("content"))
    if n_hits <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    contents = contents.join(hits, F.xxhash64("digest") == F.col("hit"), "left_semi").groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"))
    variants = contents.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"))
    mixed = staged(variants.where("variants > 1").select("digest"), "exact-dedup-mixed")
    result = _joined(rows, newest, ["digest"])
    if mixed.isEmpty():
        return result
    told = spark.read.schema(schema).parquet(path)
    exact = told.select(*columns(told), text.alias("content")).join(mixed, "digest", "left_semi")
    split = exact.groupBy("digest", "content").agg(best, F.count(F.lit(1)).alias("group_size"))
    return result.join(mixed, "digest", "left_anti").unionByName(_joined(exact, split, ["digest", "content"]))


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    stays = (F.col("file_path") == F.col("best.file_path")) & (F.col("row_index") == F.col("best.row_index"))
    return rows.join(groups, keys).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", stays.alias("kept"), "digest", "file_path", "row_index")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns. docs is written to the shared folder, to be streamed from there."""
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "exact-dedup-input")
    docs.write.option("compression", "zstd").parquet(path)
    stay = exact_dedup(spark, path).where("kept").select("file_path", "row_index")
    source = spark.read.schema(docs.schema).parquet(path)
    place = source.metadataColumn("_metadata")
    located = source.select(F.struct(*[source[c] for c in source.columns]).alias("row"), place["file_path"].alias("at_file"), place["row_index"].alias("at_row"))
    return located.join(stay, (F.col("at_file") == stay.file_path) & (F.col("at_row") == stay.row_index), "left_semi").select("row.*")
