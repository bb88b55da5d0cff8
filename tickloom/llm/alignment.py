"""How two tokenizers cut the same texts: groups of tokens between the byte offsets where both end one, and which ids end together.

A text with a blank before it is taken through tokenizer A (byte-level BPE), the text through B (sentencepiece, which adds
the blank). Where neither has a token that holds a blank after a character that is no white space, both end a token before
every blank between two such characters: a document is a sequence of segments cut there, and what happens in a segment does
not depend on the others. So each distinct segment is aligned once, by DataFrame operations, and documents add their
segments up (with vocabularies of another kind a document is one segment):

1. Blocks of documents are cut into segments. A document whose joined tokens are not its bytes has none. Rows: each document's
   segment numbers, each segment and its times in the block.
2. Segments of all blocks become distinct ones, their times sums; these are taken through both tokenizers.
3. posexplode gives tokens, a running sum of their bytes their ends; an equality join on (segment, end) finds the cuts, which
   are the links; a running count of cuts numbers the groups, which are the tokens since the cut before.
4. Links, weighted by their segments' times, give each id pair's count and whether it is the highest of its B id. A bucket of
   segments asks once for each pair it has.
5. Links take up their pairs' counts, segments add them up and go back to their blocks, where documents add up segments.

Texts without any such blank are one segment, however long. Nothing is gathered on the driver; a pair's rows come from
distinct segments, and no pair sends more than one row a bucket, no segment more than one a block.

Defined results: null and empty texts have zeros and an empty digest, like those whose bytes differ; rows that repeat are
documents of their own; rows with a null id too; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, from_planes, planes, settings, utf8

#: Documents and bytes of text in a block, of which either ends it.
BLOCK_DOCS, BLOCK_BYTES = 8192, 16 << 20
#: Bytes of new segments that go to a tokenizer in one string.
ENCODED = 1 << 16
_TOKENS = "array<struct<id int, bytes int>>"
#: A segment's place is its block times 2^NUMBER plus its number there; a task's blocks are numbered below 2^COUNTER.
NUMBER, COUNTER = 24, 16
#: Buckets of segments a shuffle partition.
BUCKETS = 4
_CUT = "block long, doc_id long, words binary, place long, segment string, times long"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_SUMS = {"n_a": "n_a", "n_b": "n_b", "n_groups": "n_groups", "n_links": "n_groups", "n_best": "n_best", "count_sum": "count_sum"}


class Cutter:
    """A tokenizer: `encode` takes a text that begins with a blank, `token_bytes` has the bytes of each id.

    keeps: whether a text's tokens are its bytes, where that can be told without encoding it.
    """

    def __init__(self, token_bytes: list[bytes], encode: Callable[[str], list[int]], keeps: Callable[[str], bool] | None = None):
        self.bytes, self.encode = token_bytes, encode
        self.keeps = keeps or (lambda text: b"".join([token_bytes[i] for i in encode(text)]) == text.encode())
        self.length = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        #: Whether texts can be cut before a blank between two characters that are no white space.
        self.ends_at_blanks = not any(re.search(r"\S ", t.decode("utf-8", "replace")) for t in token_bytes)

    def keeps_each(self, segments: list[str]) -> np.ndarray:
        """Whether each segment's tokens are its bytes; asked of ever shorter runs of segments where some are not."""
        out = np.ones(len(segments), bool)

        def ask(lo: int, hi: int) -> None:
            if not self.keeps(" " + " ".join(segments[lo:hi])):
                if hi - lo == 1:
                    out[lo] = False
                    return
                ask(lo, (lo + hi) // 2)
                ask((lo + hi) // 2, hi)

        for lo in range(0, len(segments), 8192):
            ask(lo, min(lo + 8192, len(segments)))
        return out

    def tokens(self, segments: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all segments, and where each segment's start, how many they are and whether they are its bytes.

        Segments go many in one string, as this costs less; those with white space at an end, which ends of texts can have,
        alone, and so do those of a string whose tokens are not its bytes.
        """
        start, count, fine = (np.zeros(len(segments), t) for t in (np.int64, np.int64, bool))
        found, n_found = [np.empty(0, np.int64)], 0

        def take(at: list[int]) -> None:
            nonlocal n_found
            text = "".join(" " + segments[i] for i in at)
            ids = np.array(self.encode(text), np.int64)
            lengths, ends = self.length[ids], np.cumsum(sizes[at])
            if not lengths.all():
                raise ValueError("a token without bytes")
            last = np.searchsorted(np.cumsum(lengths), ends, side="right")
            whole = b"".join([self.bytes[i] for i in ids.tolist()]) == text.encode()
            if len(at) > 1 and not (whole and np.array_equal(np.cumsum(lengths)[last - 1], ends)):
                for i in at:
                    take([i])
                return
            count[at] = np.diff(np.r_[0, last]) if whole else len(ids)
            start[at] = n_found + np.cumsum(count[at]) - count[at]
            fine[at] = whole
            found.append(ids)
            n_found += len(ids)

        together, held = [], 0
        for i, s in enumerate(segments):
            if not s or s[0].isspace() or s[-1].isspace():
                take([i])
                continue
            together.append(i)
            held += int(sizes[i])
            if held >= ENCODED:
                take(together)
                together, held = [], 0
        if together:
            take(together)
        return np.concatenate(found), start, count, fine


def byte_level(path: str, pattern: str) -> Cutter:
    """A byte-level BPE file of the tokenizers library, whose words `pattern` tells; texts may hold its special tokens' strings.

    Merges must be in the order of their results' ids, as then a rank is an id.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # byte-level files write bytes that are printable Latin-1 characters as these, the others as characters from 256 on
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    if ids != sorted(set(ids)):
        raise ValueError(f"{path}: merges are not in the order of ids")
    ranks = {bytes(letters[c] for c in t): model["vocab"][t] for t in [*letters, *merged]}
    token_bytes = [b"\0"] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        token_bytes[i] = b
    return Cutter(token_bytes, tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, lambda text: True)


def pieces(path: str) -> Cutter:
    """A sentencepiece model that puts a blank before texts."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token_bytes = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode() for i in range(model.get_piece_size()) for p in [model.id_to_piece(i)]]

    def keeps(text: str) -> bool:
        marked = text.replace(" ", "\u2581")
        return "\u2581" not in text and model.normalize(text[1:]) == marked

    any_bytes = sum(map(model.is_byte, range(model.get_piece_size()))) == 256  # then every normal text has tokens
    return Cutter(token_bytes, lambda text: model.encode(text[1:]), keeps if any_bytes else None)


@cache
def _cutters(byte_bpe: str, piece_model: str, pattern: str) -> tuple[Cutter, Cutter]:
    return byte_level(byte_bpe, pattern), pieces(piece_model)


class Numbers(dict):
    """segment -> its number in the block; tells those with white space at an end, or without characters, as odd."""

    def __init__(self):
        self.odd = []

    def __missing__(self, segment: str) -> int:
        self.odd.append(not segment or segment[0].isspace() or segment[-1].isspace())
        number = self[segment] = len(self)
        return number


_between = re.compile(r"(?<=\S) (?=\S)")


def _numbered(text: str, numbers: Numbers, can_cut: bool) -> np.ndarray:
    """The numbers of a text's segments."""
    parts = text.split(" ") if can_cut else [text]
    found = np.fromiter(map(numbers.__getitem__, parts), np.int64, len(parts))
    if can_cut and any(map(numbers.odd.__getitem__, found.tolist() if len(found) < 64 else np.unique(found).tolist())):  # some blank is not between two characters
        parts = _between.split(text)
        found = np.fromiter(map(numbers.__getitem__, parts), np.int64, len(parts))
    return found


def _cut_blocks(batches: Iterator[pa.RecordBatch], a: Cutter, b: Cutter) -> Iterator[pa.RecordBatch]:
    """Rows of documents (block, doc_id, words) and of their segments (place, segment, times)."""
    can_cut = a.ends_at_blanks and b.ends_at_blanks
    block, numbers, docs, held = TaskContext.get().partitionId() << COUNTER, Numbers(), [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            docs.append((doc_id, _numbered(text, numbers, can_cut) if text else np.empty(0, np.int64)))
            held += len(text or "")
            if len(docs) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                yield from _block(block, docs, list(numbers), a, b)
                block, numbers, docs, held = block + 1, Numbers(), [], 0
    if docs:
        yield from _block(block, docs, list(numbers), a, b)


def _block(block: int, docs: list[tuple[int | None, np.ndarray]], segments: list[str], a: Cutter, b: Cutter) -> Iterator[pa.RecordBatch]:
    fine = a.keeps_each(segments) & b.keeps_each(segments)
    docs = [(doc_id, words if fine[words].all() else words[:0]) for doc_id, words in docs]
    times = np.bincount(np.concatenate([words for _, words in docs]), minlength=len(segments))
    used = np.flatnonzero(times)
    for lo in range(0, len(docs), 1024):
        part = docs[lo : lo + 1024]
        yield _rows(len(part), block, doc_id=pa.array([d for d, _ in part], pa.int64()), words=pa.array([planes(w.astype(np.uint64), 4) for _, w in part], pa.binary()))
    for lo in range(0, len(used), 16_384):
        at = used[lo : lo + 16_384]
        yield _rows(len(at), None, place=pa.array((block << NUMBER) + at, pa.int64()), segment=pa.array([segments[i] for i in at.tolist()], pa.string()), times=pa.array(times[at], pa.int64()))


_ARROW = {"block": pa.int64(), "doc_id": pa.int64(), "words": pa.binary(), "place": pa.int64(), "segment": pa.string(), "times": pa.int64()}


def _rows(n: int, block: int | None, **columns: pa.Array) -> pa.RecordBatch:
    columns["block"] = pa.array([block] * n, pa.int64())
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kind)).cast(kind) for name, kind in _ARROW.items()], names=list(_ARROW))


def _tokenised(batches: Iterator[pa.RecordBatch], cutters: tuple[Cutter, ...]) -> Iterator[pa.RecordBatch]:
    """(seg, times, a, b): each segment's tokens, as lists of (id, bytes)."""
    for batch in batches:
        segments = batch.column("segment").to_pylist()
        sizes = np.fromiter((len(s.encode()) + 1 for s in segments), np.int64, len(segments))
        lists = []
        for cutter in cutters:
            ids, start, count, fine = cutter.tokens(segments, sizes)
            if not fine.all():
                raise ValueError("tokens are not their text's bytes")
            ids = ids[np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            pairs = pa.StructArray.from_arrays([pa.array(ids, pa.int32()), pa.array(cutter.length[ids], pa.int32())], ["id", "bytes"])
            lists.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pairs))
        yield pa.RecordBatch.from_arrays([batch.column("seg"), batch.column("times"), *lists], names=["seg", "times", "a", "b"])


def align(docs: DataFrame, byte_bpe: str, piece_model: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. See the module's description."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut_blocks(batches, *_cutters(byte_bpe, piece_model, pattern))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _tokenised(batches, _cutters(byte_bpe, piece_model, pattern))

    rows = scratch.stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, _CUT), "cut")
    each = rows.where("segment IS NOT NULL")
    segments = scratch.stage(each.groupBy("segment").agg(F.sum("times").alias("times")).withColumn("seg", F.monotonically_increasing_id()), "segments")
    placed = scratch.stage(each.select("place", "segment").join(segments.select("segment", "seg"), "segment").select("place", "seg"), "placed")
    tokens = scratch.stage(segments.select("seg", "times", "segment").mapInArrow(encode, f"seg long, times long, a {_TOKENS}, b {_TOKENS}"), "tokens")
    scratch.drop(segments)
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):  # all rows of a segment, or bucket, stay where they are
        aligned = scratch.stage(aligned_segments(tokens.repartition("seg")), "aligned")
        scratch.drop(tokens)
        buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = aligned.withColumn("bucket", F.pmod(F.xxhash64("seg"), F.lit(buckets)).cast("int")).repartition("bucket")
        links = dealt.select("bucket", "seg", "times", F.explode("links").alias("link")).select("bucket", "seg", "times", "link.a", "link.b")
        asked = scratch.stage(links.groupBy("bucket", "a", "b").agg(F.sum("times").alias("times")), "asked")
        counts = scratch.stage(pair_counts(asked), "counts")
        told = scratch.stage(asked.join(counts, ["a", "b"]).select("bucket", "a", "b", "count", "is_best"), "told")
        scratch.drop(asked, counts)
        sums = links.join(told.repartition("bucket"), ["bucket", "a", "b"]).groupBy("bucket", "seg").agg(F.sum("count").alias("count_sum"), F.sum(F.col("is_best").cast("long")).alias("n_best"))
        known = scratch.stage(dealt.drop("links", "times").join(sums, ["bucket", "seg"]).drop("bucket"), "known")
    scratch.drop(aligned, told)
    here = scratch.stage(placed.join(known, "seg").drop("seg"), "here")
    scratch.drop(placed, known)
    by_block = here.groupBy(F.shiftright("place", NUMBER).alias("held_in"))
    return rows.where("words IS NOT NULL").select("block", "doc_id", "words").groupBy("block").cogroup(by_block).applyInArrow(_summed, _RESULT)


def aligned_segments(tokens: DataFrame) -> DataFrame:
    """(seg, times, n_a, n_b, n_groups, groups, links) of segments (seg, times, a, b): lists of tokens (id, bytes) whose bytes are equal in sum.

    links: the last tokens (a, b) of each group; groups: their ids as text.
    """
    ends = {side: tokens.select("seg", F.posexplode(side).alias(f"at_{side}", "token")).select("seg", f"at_{side}", F.col("token.id").alias(side), F.sum("token.bytes").over(Window.partitionBy("seg").orderBy(f"at_{side}")).alias("end")) for side in "ab"}
    cuts = ends["a"].join(ends["b"], ["seg", "end"])
    by_end = Window.partitionBy("seg").orderBy("end")
    before = {side: F.coalesce(F.lag(f"at_{side}").over(by_end), F.lit(-1)).alias(f"before_{side}") for side in "ab"}
    groups = cuts.select("seg", F.row_number().over(by_end).alias("group"), "a", "b", "at_a", "at_b", *before.values())
    found = groups.groupBy("seg").agg(F.array_sort(F.collect_list(F.struct("group", "a", "b", "at_a", "at_b", "before_a", "before_b"))).alias("found"))

    def ids(side: str, group: Column) -> Column:
        """The ids of a group's tokens, which lie after the cut before and up to its own."""
        own = F.slice(F.col(side), group[f"before_{side}"] + 2, group[f"at_{side}"] - group[f"before_{side}"])
        return F.array_join(own.cast("array<string>"), ",")

    both = found.join(tokens.select("seg", "times", F.col("a.id").alias("a"), F.col("b.id").alias("b")), "seg")
    text = F.array_join(F.transform("found", lambda g: F.concat(ids("a", g), F.lit("|"), ids("b", g))), ";")
    links = F.transform("found", lambda g: F.struct(g["a"].alias("a"), g["b"].alias("b")))
    return both.select("seg", "times", F.size("a").alias("n_a"), F.size("b").alias("n_b"), F.size("found").alias("n_groups"), text.alias("groups"), links.alias("links"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, is_best) of pairs (a, b, times); best: no other pair of b has a higher count."""
    counts = pairs.groupBy("a", "b").agg(F.sum("times").alias("count"))
    return counts.withColumn("is_best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _summed(docs: pa.Table, known: pa.Table) -> pa.Table:
    """A block's documents, from what is known of its segments."""
    number = known.column("place").to_numpy() & ((1 << NUMBER) - 1)
    size = int(number.max()) + 1 if len(number) else 0
    words = [from_planes(w, 4).astype(np.int64) for w in docs.column("words").to_pylist()]
    n = np.fromiter(map(len, words), np.int64, len(words))
    end, flat = np.cumsum(n), np.concatenate([*words, np.empty(0, np.int64)])
    out = {"doc_id": docs.column("doc_id").combine_chunks().cast(pa.int64())}
    for name, source in _SUMS.items():
        value = np.zeros(size, np.int64)
        value[number] = known.column(source).to_numpy()
        running = np.r_[0, np.cumsum(value[flat])]
        out[name] = pa.array(running[end] - running[end - n])
    groups: list[bytes] = [b""] * size
    for i, g in zip(number.tolist(), utf8(known.column("groups")), strict=True):
        groups[i] = g
    out["groups_sha256"] = pa.array([hashlib.sha256(b";".join(map(groups.__getitem__, w.tolist()))).hexdigest() if len(w) else "" for w in words], pa.string())
    return pa.table(out)
