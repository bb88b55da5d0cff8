"""How the sources of a language differ in their words: shards of term counts, each taken through DuckDB's SQL, merged by Spark.

A term is a longest run of ASCII letters and characters beyond ASCII, ASCII letters lowered. A language keeps the terms that
at least `least_docs` of its documents hold. A group is a (lang, source) that occurs, with or without terms; it and the
language as a whole give each kept term the integer p = 1 + floor(SCALE (count + PRIOR) / (N + PRIOR V)), N being the counts'
sum over the V kept terms.

1. Tasks count terms a group, and the documents that hold them, and send these partial counts to shards by a hash of
   (lang, term), so that all of a term's counts in a language meet in one shard, however frequent it is: a task sends one row
   a group and term.
2. Each shard's counts are summed and thinned to the kept terms by one SQL statement in DuckDB, in memory.
3. Spark sums N and V. The kept terms are few, so several shards become one; the totals, a row a group, go to each, and a
   second SQL statement gives the differences between each two sources of a language, summed over the shard's terms, and each
   group's best terms of the shard.
4. Spark adds the sums up and ranks.

Everything is counted in whole numbers; nothing is gathered on the driver.

Defined results: null text, lang and source are empty strings; a language without kept terms has value 0 for each pair of its
sources; ties rank by the item's UTF-8 bytes; repeated rows count as often as they are there; an empty table gives no rows;
other columns are not read. doc_id is not read either.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, block_count, input_bytes, utf8

#: Counts are taken out of SCALE, with PRIOR more of each term.
SCALE, PRIOR = 1_000_000_000, 5
#: Bytes of input in a shard of counts.
COUNTED_BYTES = 8 << 20
#: Shards of kept terms at least, and bytes of input in one; each takes several shards of counts. It returns a row for each two
#: sources, so their number follows the input alone and not the shuffle's partitions.
SHARDS, SHARD_BYTES = 8, 32 << 20
#: Entries of a task's counts before they are sent on.
ENTRIES = 200_000
#: Every byte as it counts in terms: letters lowered, bytes of characters beyond ASCII as they are, others as a blank.
_AS_TERM = bytes(b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"

_KEPT = """
WITH held AS (SELECT lang, source, term, sum(n) AS n, sum(sum(docs)) OVER (PARTITION BY lang, term) AS docs,
                     row_number() OVER (PARTITION BY lang, term ORDER BY source) AS place
              FROM counts GROUP BY lang, source, term)
SELECT CAST($shard AS INT) AS shard, lang, source, term, CAST(n AS BIGINT) AS n, place = 1 AS leads FROM held WHERE docs >= $least
"""
_SHARES = f"""
CREATE TEMP TABLE shares AS
WITH terms AS (SELECT lang, term, sum(n) AS n, row_number() OVER () AS number FROM kept GROUP BY lang, term),
cells AS (SELECT t.lang, g.source, t.number, t.term, g.is_lang, CASE WHEN g.is_lang THEN t.n ELSE coalesce(k.n, 0) END AS n, g.n AS total, g.v
          FROM terms t JOIN totals g ON g.lang = t.lang
          LEFT JOIN kept k ON k.lang = t.lang AND k.term = t.term AND k.source = g.source AND NOT g.is_lang)
SELECT lang, source, number, term, is_lang, n, CAST(1 + ({SCALE}::HUGEINT * (n + {PRIOR})) // (total::HUGEINT + {PRIOR} * v::HUGEINT) AS BIGINT) AS p FROM cells
"""
_PAIRS = """
SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
FROM shares a JOIN shares b ON a.number = b.number AND a.source < b.source WHERE NOT a.is_lang AND NOT b.is_lang GROUP BY ALL
"""
_TERMS = """
SELECT a.lang, a.source, 'term' AS part, a.term AS item, a.p - l.p AS value
FROM shares a JOIN shares l ON a.number = l.number AND l.is_lang
WHERE NOT a.is_lang AND a.n > 0 AND a.p > l.p
QUALIFY row_number() OVER (PARTITION BY a.lang, a.source ORDER BY value DESC, item) <= $most
"""


def audit_sources(docs: DataFrame, least_docs: int = 30, top_terms: int = 50, shards: int | None = None) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part pair has each other source of the language, part term the top_terms terms that the group has more of than its language."""
    scratch = Scratch(docs.sparkSession, "divergence")
    fewer = shards or max(SHARDS, input_bytes(docs) // SHARD_BYTES)
    shards = shards or block_count(docs, COUNTED_BYTES)
    named = docs.select(*(F.coalesce(docs[c], F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = named.mapInArrow(_counted, _COUNTS).withColumn("shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int"))

    def keep(key: tuple, counts: pa.Table) -> pa.Table:
        with _database() as db:
            return db.register("counts", counts).sql(_KEPT, params={"shard": key[0].as_py(), "least": least_docs}).to_arrow_table()

    kept = scratch.stage(counts.groupBy("shard").applyInArrow(keep, "shard int, lang string, source string, term string, n long, leads boolean"), "kept")
    groups = scratch.stage(_totals(named.select("lang", "source").distinct(), kept), "totals")

    def compare(kept: pa.Table, totals: pa.Table) -> pa.Table:
        with _database() as db:
            db.register("kept", kept).register("totals", totals).execute(_SHARES)
            return pa.concat_tables([db.sql(_PAIRS).to_arrow_table(), db.sql(_TERMS, params={"most": top_terms}).to_arrow_table()])

    everywhere = groups.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(fewer - 1))))
    found = kept.drop("leads").withColumn("shard", F.pmod("shard", F.lit(fewer)).cast("int")).groupBy("shard").cogroup(everywhere.groupBy("at")).applyInArrow(compare, "lang string, source string, part string, item string, value long")
    found = scratch.stage(found, "partial")
    scratch.drop(kept)

    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    own, other = groups.where("NOT is_lang").select("lang", "source"), groups.where("NOT is_lang").select("lang", F.col("source").alias("item"))
    low = own.join(other, "lang").where("source < item").join(sums, ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    pairs = low.select("lang", "value", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("side"))
    rows = pairs.select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value").union(found.where("part = 'term'"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")))
    return ranked.where(f"part = 'pair' OR rank <= {top_terms}")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each group with their occurrences and documents, summed over as many documents as fit ENTRIES entries."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    entries = 0
    for batch in batches:
        for group, text in zip(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True), utf8(batch.column("text")), strict=True):
            terms = text.translate(_AS_TERM).split()
            times, docs = held[group]
            entries -= len(docs)
            times.update(terms)
            docs.update(set(terms))
            entries += len(docs)
            if entries > ENTRIES:
                yield _sent(held)
                held.clear()
                entries = 0
    if entries:
        yield _sent(held)


def _sent(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    columns = [[], [], [], [], []]
    for (lang, source), (times, docs) in held.items():
        for column, values in zip(columns, ([lang] * len(docs), [source] * len(docs), docs.keys(), map(times.__getitem__, docs), docs.values()), strict=True):
            column.extend(values)
    lang, source, term, n, docs = columns
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def _totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, is_lang, n, v): a row for each group and one, with an empty source, for each language."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("leads").cast("long")).alias("leads"))
    own = groups.join(sums, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("leads", F.lit(0)).alias("leads"))
    langs = own.groupBy("lang").agg(F.sum("n").alias("all"), F.sum("leads").alias("v"))
    return own.join(langs, "lang").select("lang", "source", F.lit(False).alias("is_lang"), "n", "v").union(langs.select("lang", F.lit(""), F.lit(True), "all", "v"))


def _database() -> duckdb.DuckDBPyConnection:
    """A database in the task's memory, of one thread and without files."""
    return duckdb.connect(config={"threads": 1, "temp_directory": "", "autoinstall_known_extensions": False})
