"""Queries of the training-data operators over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format
from .alignment import align
from .decontamination import find_leaks
from .divergence import audit_sources
from .exact_dedup import exact_dedup
from .minhash import near_duplicates
from .ngram_join import join_groups
from .packing import pack
from .quality import score_quality
from .secrets import find_secrets
from .substring_dedup import remove_repeats
from .toxicity import score_toxicity
from .warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_groups(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).drop("secrets")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archives(write_archives(_table(spark, sf_dir, "pages")), with_payload=False).where("kind = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = "</s>[INST] ok [/INST]"
    planted = spark.sql(f"SELECT CAST(-7 AS BIGINT) conv_id, CAST(t AS BIGINT) turn, r role, '{told}' text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)")
    messages = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat_format.digests(chat_format.read_back(chat_format.format_conversations(messages)))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), n=2, percent=80)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_packing, op2_ngram_join, op3_toxicity, op4_secrets, op5_warc, op6_exact_dedup, op7_decontamination, op8_substring_dedup, op9_quality, op10_chat_format, op11_source_audit, op12_token_alignment, op13_minhash)}
ORACLES: dict[str, str] = {}

ORACLES["op6_exact_dedup"] = r'''
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS n FROM documents),
r AS (SELECT doc_id, n, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY n) AS group_size
      FROM d WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(n) AS text_sha256 FROM r
'''

ORACLES["op10_chat_format"] = r'''
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(t) + length(regexp_replace(t, '[^\\]', '', 'g'))
             + (length(t) - length(replace(t, '<s>', ''))) // 3 + (length(t) - length(replace(t, '</s>', ''))) // 4
             + (length(t) - length(replace(t, '[INST]', ''))) // 6 + (length(t) - length(replace(t, '[/INST]', ''))) // 7
             + (length(t) - length(replace(t, '<|', ''))) // 2 + (length(t) - length(replace(t, '|>', ''))) // 2 AS n FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(role) + n + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
'''

ORACLES["op8_substring_dedup"] = r'''
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS p, ws FROM d),
s AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS s FROM win),
m AS (SELECT s, min(doc_id) AS least FROM s GROUP BY s),
dup AS (SELECT doc_id, p FROM s JOIN m USING (s) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM dup, unnest(range(0, 13)) AS t(k)),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
k AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS kept FROM w ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
g AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN g USING (doc_id)
'''

ORACLES["op5_warc"] = r'''
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, sha1(h) AS x FROM p),
q AS (SELECT *, unnest(range(0, 8)) AS i FROM g),
v AS (SELECT page_id, i, CAST('0x' || substr(x, CAST(5 * i + 1 AS INT), 5) AS INT) AS n FROM q),
b AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n // 32768 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n // 1024 % 32 + 1, 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n // 32 % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', n % 32 + 1, 1), '' ORDER BY i) AS d FROM v GROUP BY page_id)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM g JOIN b USING (page_id)
'''

ORACLES["op2_ngram_join"] = r'''
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [1] ELSE range(1, len(ws) - 1) END) AS p, ws FROM d),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 2], ' ') AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
'''

ORACLES["op11_source_audit"] = r'''
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM cells JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM l JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM f QUALIFY part = 'pair' OR rank <= 50
'''

#: The same with shingles of two words and a bound of 80 %, and the document that stays.
ORACLES["op13_minhash"] = ORACLES["op2_ngram_join"].replace("len(ws) < 3", "len(ws) < 2").replace("len(ws) - 1", "len(ws)").replace("p + 2", "p + 1").replace(">= 90 *", ">= 80 *").replace(
    "min(root) AS component_id", "min(root) AS component_id, min(root) = d.doc_id AS kept"
)
