"""Benchmark decontamination by greedy string tiling.

A document is held against the items with which it shares a seed, a run of MIN_MATCH tokens (words without case and outer
punctuation). Tiles are made as in running Karp-Rabin greedy string tiling: windows of a search length are matched by their
rolling hash among tokens that no tile holds yet, hits are checked token by token and joined to maximal runs, the longest is
marked first (ties: first in the item, then in the text), what a mark leaves of another run stands in line again, and the
search length is lowered until no match of MIN_MATCH tokens is left. Tiles may lie anywhere, so passages whose
parts were reordered are caught. An item leaks where its tiles cover at least a given share of it.

Seeds are matched against the benchmark in each task while its tokens number at most BROADCAST_TOKENS, which bounds what
is sent to a task. A larger benchmark is joined by a shuffle: distinct texts, named by their digests, send their distinct
seeds, and an item its seeds but the most frequent ones that a leak can do without (a leak shares a seed for every MIN_MATCH
of the tokens it has to cover), so a seed that most documents have joins little. A text, and an item, is sent once to each
block of pairs. Whole texts are read; before tiling, pairs are left out whose shared seeds could not cover enough of the
item, which the tiles never exceed.

Defined results: null or empty texts and items match nothing; an item shorter than MIN_MATCH matches as a whole only;
repeated rows give repeated pairs; rows with a null id are matched likewise, each by its own text; both ways give the same rows;
empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import RunHashes, WORD_TABLE_ENTRIES, WORD_TABLE_LETTERS, Scratch, block_count, found_in, mixed, rolling_hashes, slices, texts

MIN_MATCH, COVERAGE = 5, 0.6
#: Tokens of the benchmark that may be sent to every task: 16 bytes each, some 32 MB.
BROADCAST_TOKENS = 2_000_000
RESULT = "doc_id long, item_id long, coverage double, n_tiles long, matched_tokens long, item_tokens long"
_TRIM = bytes(c for c in range(33, 127) if not chr(c).isalnum())


class TokenTable(dict):
    """word (bytes) -> 64-bit hash without case and outer punctuation; 0 where nothing is left."""

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(_TRIM)
        value = (xxhash.xxh3_64_intdigest(bare.decode("utf-8", "replace").lower()) | 1) if bare else 0
        if len(word) <= WORD_TABLE_LETTERS:
            if len(self) >= WORD_TABLE_ENTRIES:
                self.clear()
            self[word] = value
        return value


TOKENS = TokenTable()


def tokens(content: bytes | None) -> np.ndarray:
    words = content.split() if content else []
    h = np.fromiter(map(TOKENS.__getitem__, words), np.uint64, len(words))
    return h[h != 0]


def tile(text: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (start in text, start in item, length), each token in one tile at most."""
    free_text, free_item = np.ones(len(text), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    search, runs_of = len(item), (RunHashes(text), RunHashes(item))
    while search >= min_match:
        line = _matches(text, item, free_text, free_item, search, runs_of)
        heapify(line)
        while line and free_item.any():
            length, j, i = heappop(line)
            open_ = free_text[i : i - length] & free_item[j : j - length]
            if open_.all():
                if np.array_equal(text[i : i - length], item[j : j - length]):  # runs are told by hashes
                    free_text[i : i - length] = free_item[j : j - length] = False
                    tiles.append((i, j, -length))
                continue
            for a, z in slices(np.cumsum(~open_) * 2 + open_) if open_.sum() >= search else ():  # what is left of it, as far as it is long enough
                if open_[a] and z - a >= search:
                    heappush(line, (int(a - z), j + a, i + a))
        search = 0 if search == min_match or not free_item.any() else max(min_match, search // 2)
    return tiles


def _matches(text: np.ndarray, item: np.ndarray, free_text: np.ndarray, free_item: np.ndarray, search: int, runs_of: tuple[RunHashes, RunHashes]) -> list[tuple[int, int, int]]:
    """Maximal runs (minus length, start in item, start in text) of at least search equal, free tokens.

    A run starts where the tokens before it differ or are not free, so only pairs of windows with different tokens before them
    are made, and each is extended to its end by halving; texts of repeated tokens have few of them.
    """
    (at, h), (item_at, item_h) = _free_windows(text, free_text, search), _free_windows(item, free_item, search)
    pair = np.unique(np.concatenate((item, text)), return_inverse=True)[1] + 2
    item_before, before = _before(pair[: len(item)], free_item, 0)[item_at], _before(pair[len(item) :], free_text, 1)[at]
    order = np.lexsort((item_before, item_h))
    item_at, item_h, item_before = item_at[order], item_h[order], item_before[order]
    low, high = np.searchsorted(item_h, h, "left"), np.searchsorted(item_h, h, "right")
    # in the item's windows of one hash, those with the token before the text's window lie together
    group, n = np.unique(item_h, return_inverse=True)[1], len(pair) + 2
    own = (group[np.minimum(low, len(group) - 1)] if len(group) else low) * n + before
    same_low, same_high = (np.where(high > low, np.searchsorted(group * n + item_before, own, side), low) for side in ("left", "right"))
    starts = [(np.repeat(at, z - a), item_at[_spread(a, z)]) for a, z in ((low, same_low), (same_high, high))]
    i, j = (np.concatenate(c) for c in zip(*starts, strict=True))
    limit = np.minimum(_room(free_text)[i], _room(free_item)[j])
    length, step = np.full(len(i), search), 1 << max(0, int(limit.max(initial=1)).bit_length() - 1)
    while step:
        longer = length + step
        fits = np.flatnonzero(longer <= limit)
        fits = fits[runs_of[0].of(i[fits], longer[fits]) == runs_of[1].of(j[fits], longer[fits])]
        length[fits] = longer[fits]
        step //= 2
    return list(zip((-length).tolist(), j.tolist(), i.tolist(), strict=True))


def _spread(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The numbers from each a up to its z, end to end."""
    n = z - a
    return np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _before(side: np.ndarray, free: np.ndarray, mark: int) -> np.ndarray:
    """The token before each place where it is free, else a mark that is no token."""
    out = np.full(len(side), mark, np.int64)
    out[1:][free[:-1]] = side[:-1][free[:-1]]
    return out


def _room(free: np.ndarray) -> np.ndarray:
    """Free tokens from each place on."""
    ends = np.flatnonzero(np.r_[~free, True])
    return ends[np.searchsorted(ends, np.arange(len(free)))] - np.arange(len(free))


def _free_windows(side: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and rolling hashes of the windows that no tile touches."""
    h = rolling_hashes(side, length)
    taken = np.r_[0, np.cumsum(~free)]
    at = np.flatnonzero(taken[length:] == taken[:-length]) if len(h) else np.empty(0, np.int64)
    return at, h[at]


class Benchmark:
    """Items by number, and their seeds in order of hash."""

    def __init__(self, ids: list, contents: list[bytes | None], min_match: int):
        self.min_match = min_match
        items = [(i, tokens(c)) for i, c in zip(ids, contents, strict=True)]
        items = [(i, t) for i, t in items if len(t)]
        self.ids, self.items = [i for i, _ in items], [t for _, t in items]
        self.lengths = sorted({min(min_match, len(t)) for t in self.items})
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in self.lengths:
            own = [(n, rolling_hashes(t, length)) for n, t in enumerate(self.items) if min(min_match, len(t)) == length]
            h = np.concatenate([w for _, w in own])
            number = np.concatenate([np.full(len(w), n) for n, w in own])
            place = np.concatenate([np.arange(len(w)) for _, w in own])
            order = np.argsort(h, kind="stable")
            self.seeds[length] = h[order], number[order], place[order]

    def leaks(self, text: np.ndarray, coverage: float) -> Iterator[tuple]:
        """(item_id, coverage, n_tiles, matched_tokens, item_tokens) of each item that the text leaks."""
        for number in self.candidates(text, coverage):
            item = self.items[number]
            tiles = tile(text, item, min(self.min_match, len(item)))
            matched = sum(t[2] for t in tiles)
            if matched >= coverage * len(item):
                yield self.ids[number], matched / len(item), len(tiles), matched, len(item)

    def candidates(self, text: np.ndarray, coverage: float) -> list[int]:
        """Items of which shared seeds cover enough."""
        found = []
        for length, (h, number, place) in self.seeds.items():
            wanted = np.unique(rolling_hashes(text, length))
            wanted = wanted[found_in(wanted, h)[1]]
            if not len(wanted):
                continue
            low, high = np.searchsorted(h, wanted, "left"), np.searchsorted(h, wanted, "right")
            at = np.concatenate([np.arange(a, z) for a, z in zip(low, high, strict=True)])
            at = at[np.lexsort((place[at], number[at]))]
            for a, z in slices(number[at]):
                here = place[at[a:z]]
                covered = length + int(np.minimum(np.diff(here), length).sum())
                if covered >= coverage * len(self.items[number[at[a]]]):
                    found.append(int(number[at[a]]))
        return found


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """One row for each document and item that it leaks: doc_id, item_id, coverage, n_tiles, matched_tokens, item_tokens."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("item"))
    source = texts(docs, id_col, text_col)
    if _fits(items, broadcast_tokens):
        held = _sent(docs.sparkSession, items, min_match)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, contents = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()
                yield _batch([(i, *leak) for i, c in zip(ids, contents, strict=True) for leak in held.value.leaks(tokens(c), coverage)])

        return source.mapInArrow(task, RESULT)
    rows = source.withColumn("doc_key", _digest("text"))
    leaks = _leaks_of_texts(rows, items, min_match, coverage)
    return rows.select("doc_id", "doc_key").join(leaks, "doc_key").select(*(c.split()[0] for c in RESULT.split(", ")))


def _digest(text_col: str) -> Column:
    """A text's name: ids may be null or shared by several texts."""
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)


def _leaks_of_texts(rows: DataFrame, items: DataFrame, min_match: int, coverage: float) -> DataFrame:
    """The leaks of each distinct text, by doc_key; rows have text and doc_key."""
    scratch, blocks = Scratch(rows.sparkSession, "decontamination"), block_count(rows)
    source = scratch.stage(rows.groupBy("doc_key").agg(F.first("text").alias("text")), "texts")
    each = scratch.stage(items.select("item_id", "item", _digest("item").alias("item_key")), "items")
    distinct = each.groupBy("item_key").agg(F.first("item").alias("item"))
    lengths = _seed_lengths(distinct, min_match)
    item_seeds = scratch.stage(_seeds(distinct, "item_key", "item", lengths, min_match, own_length=True), "item-seeds")
    doc_seeds = scratch.stage(_seeds(source, "doc_key", "text", lengths, min_match).join(item_seeds.select("seed").distinct(), "seed", "left_semi"), "doc-seeds")
    often = doc_seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    needed = F.greatest(F.lit(1), F.ceil(F.lit(coverage) * F.col("n_tokens") / min_match - 1e-9))
    rarest = Window.partitionBy("item_key").orderBy(F.coalesce("often", F.lit(0)), "seed")
    ranked = item_seeds.join(often, "seed", "left").withColumn("places", F.sum("n_places").over(rarest.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    asking = ranked.where(F.col("often").isNotNull() & (F.col("places") >= needed))
    pairs = scratch.stage(doc_seeds.join(asking, "seed").select("doc_key", "item_key").distinct(), "pairs")
    block = F.pmod(F.xxhash64("doc_key"), F.lit(blocks)).cast("int").alias("block")
    sent = pairs.select(block, "item_key").distinct().join(each.groupBy("item_key").agg(F.first("item").alias("item"), F.collect_list(F.struct("item_id")).alias("ids")), "item_key")
    none = F.lit(None).cast("string")
    right = sent.select("block", "item_key", "item", "ids.item_id", none.alias("doc_key")).union(pairs.select(block, "item_key", none, F.lit(None).cast("array<bigint>"), "doc_key"))
    left = source.join(pairs.select("doc_key").distinct(), "doc_key", "left_semi").select(block.alias("own_block"), "doc_key", "text")

    def judge(own: pa.Table, asked: pa.Table) -> pa.Table:
        bytes_of = lambda column: column.cast(pa.large_binary()).to_pylist()
        contents = dict(zip(own.column("doc_key").to_pylist(), bytes_of(own.column("text")), strict=True))
        keys, names, item, ids = asked.column("doc_key").to_pylist(), asked.column("item_key").to_pylist(), bytes_of(asked.column("item")), asked.column("item_id").to_pylist()
        held = {name: (Benchmark([None], [content], min_match), own_ids) for key, name, content, own_ids in zip(keys, names, item, ids, strict=True) if key is None}
        found, out, last, text = [], [], None, None
        for key, name in sorted((key, name) for key, name in zip(keys, names, strict=True) if key is not None and key in contents):
            if key != last:
                last, text = key, tokens(contents[key])
            for leak in held[name][0].leaks(text, coverage):
                found += [(None, i, *leak[1:]) for i in held[name][1]]
                out += [key] * len(held[name][1])
        batch = _batch(found)
        return pa.table([*batch.columns[1:], pa.array(out, pa.string())], names=[*batch.schema.names[1:], "doc_key"])

    return left.groupBy("own_block").cogroup(right.groupBy("block")).applyInArrow(judge, f"{RESULT.partition(', ')[2]}, doc_key string")


def _seed_lengths(items: DataFrame, min_match: int) -> list[int]:
    """Lengths of the seeds that any item needs: at most min_match values."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {min(min_match, len(tokens(c))) for batch in batches for c in batch.column("item").cast(pa.large_binary()).to_pylist()}
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["length"])

    return sorted(r.length for r in items.select("item").mapInArrow(task, "length int").distinct().collect() if r.length)


def _fits(items: DataFrame, most: int) -> bool:
    """Whether the benchmark has at most so many tokens, each taking two characters at least."""
    return (items.agg(F.sum(F.length("item"))).first()[0] or 0) <= 2 * most


def _sent(spark: SparkSession, items: DataFrame, min_match: int):
    rows = sorted(items.collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r.item))
    return spark.sparkContext.broadcast(Benchmark([r.item_id for r in rows], [r["item"].encode() for r in rows], min_match))


def _seeds(rows: DataFrame, key_col: str, text_col: str, lengths: list[int], min_match: int, own_length: bool = False) -> DataFrame:
    """Distinct (key, seed) for every length, or for the text's own; with the places that the seed has in the text and the text's tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content in zip(batch.column(key_col).to_pylist(), batch.column(text_col).cast(pa.large_binary()).to_pylist(), strict=True):
                text = tokens(content)
                wanted = [n for n in lengths if not own_length or n == min(min_match, len(text))]
                seeds, places = np.unique(np.concatenate([mixed(rolling_hashes(text, n) + np.uint64(n)) for n in wanted] or [np.empty(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(seeds), pa.string()), pa.array(seeds.view(np.int64)), pa.array(places, pa.int64()), pa.array([len(text)] * len(seeds), pa.int64())], names=[key_col, "seed", "n_places", "n_tokens"])

    return rows.select(key_col, text_col).mapInArrow(task, f"{key_col} string, seed long, n_places long, n_tokens long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def drop_leaking(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """The rows of docs that leak no item, with all their columns."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("item"))
    if not _fits(items, broadcast_tokens):
        leaks = _leaks_of_texts(texts(docs, "doc_id", "text").withColumn("doc_key", _digest("text")), items, min_match, coverage)
        rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _digest("text").alias("own_key"))
        return rows.join(leaks.select("doc_key").distinct(), F.col("own_key") == F.col("doc_key"), "left_anti").select("row.*")
    held = _sent(docs.sparkSession, items, min_match)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [next(held.value.leaks(tokens(c), coverage), None) is None for c in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
