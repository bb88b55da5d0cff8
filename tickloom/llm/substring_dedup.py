"""Removal of word windows that an earlier document also has, found by difference-cover anchors.

In a window of 13 words, 7-word anchors are hashed only where their position modulo 7 is 0, 1 or 3. These residues form a
difference cover: for any two positions some shift below 7 puts both on the cover, so two equal windows, however they are
aligned, share an anchor at the same place inside. The steps, all keyed by blocks of documents and of hashes:

1. each document block sends its distinct anchor hashes to the hash blocks;
2. a hash block answers with those that two documents have;
3. the document blocks extend shared anchors to the 13-word windows around them and send each distinct window's hash with
   the smallest document that has it;
4. a hash block answers with the smallest document of all where that matters to the block;
5. the document blocks mark the covered words and put the rest together.

A block sends a hash once, however often it occurs, so a passage that a third of all documents hold weighs as much as one
document in each block. The texts are shuffled once, by block, and read by steps 1, 3 and 5. Windows are told by 96 bits of
their words' 128-bit hashes, which stand in for comparing the words; anchors by 40 bits besides the block number, as a chance
hit of an anchor costs only time. Blocks are as many as the input's bytes ask for.

Defined results: a null or empty text has no words; rows that share a doc_id are one document to each other (neither
precedes); a row with a null id neither precedes nor is preceded, so nothing is removed from it and it meets no other row; an
empty table gives no rows; other columns are not read. Rows that repeat id and text share a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, block_count, found_in, from_planes, planes, runs, slices, texts, window_hashes_at

WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
ANCHOR_BYTES = 5
#: Bytes of a window's second hash that are sent and compared; with the first's eight, 96 bits tell windows apart.
SECOND_BYTES = 4
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _parts(keys: np.ndarray, n_parts: int, *columns: np.ndarray):
    """(part, slices of columns) in order of part = key modulo n_parts; columns have to be ordered as wanted in a part."""
    part = (keys % np.uint64(n_parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    for lo, hi in slices(part[order]):
        at = order[lo:hi]
        yield int(part[at[0]]), *(c[at] for c in columns)


def _read(table: pa.Table | pa.RecordBatch) -> tuple[Words, list, np.ndarray]:
    """Words, ids, and ids as numbers (null: -1, with no place in the order)."""
    ids = table.column("doc_id")
    return Words(table.column("text").cast(pa.large_binary()).to_pylist()), ids.to_pylist(), ids.fill_null(0).to_numpy()


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of the anchors."""
    at, h = words.windows(ANCHOR)
    here = np.isin(words.position[at] % PERIOD, COVER)
    return at[here], h[here]


def _second(words: Words, at: np.ndarray) -> np.ndarray:
    """Second hashes of the windows that start there, of the other half of their words' hashes."""
    return window_hashes_at(words.hashes[:, 1], at, WINDOW, seed=2) & np.uint64(2 ** (8 * SECOND_BYTES) - 1)


def _pair_runs(h: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where runs of equal pairs start, in order of both."""
    return np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (second[1:] != second[:-1])]) if len(h) else np.empty(0, np.int64)


def _anchor_key(h: np.ndarray, n_parts: int) -> np.ndarray:
    """What two equal anchors share: the part, above the bits that are sent."""
    return ((h >> np.uint64(8 * ANCHOR_BYTES)) % np.uint64(n_parts) << np.uint64(8 * ANCHOR_BYTES)) | (h & np.uint64(2 ** (8 * ANCHOR_BYTES) - 1))


def _result(ids: list, words: Words, removed: np.ndarray, rest: list[bytes], with_text: bool) -> dict[str, pa.Array]:
    kept = pa.array(rest, pa.binary()).cast(pa.string()) if with_text else pa.nulls(len(rest), pa.string())
    return {"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(words.n), "n_removed": pa.array(removed), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in rest], pa.string()), "kept_text": kept}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", doc_blocks: int | None = None, hash_blocks: int | None = None, with_text: bool = True) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256, kept_text (null unless with_text).

    Blocks are held in memory one at a time; their numbers follow the input's bytes unless given.
    """
    n_hash = hash_blocks or block_count(docs)
    n_docs = doc_blocks or 4 * n_hash
    rows = texts(docs, id_col, text_col)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_docs)).cast("int").alias("block")
    blocks = rows.where("doc_id IS NOT NULL").select("doc_id", "text", block).groupBy("block")

    def as_they_are(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids, _ = _read(batch)
            yield pa.RecordBatch.from_pydict(_result(ids, words, np.zeros(len(ids), np.int64), [b" ".join(w) for w in words.lists], with_text))

    def send_anchors(table: pa.Table) -> pa.Table:
        words, _, number = _read(table)
        at, h = _anchors(words)
        number = number[words.text[at]]
        order = np.lexsort((number, h))
        h, number = h[order], number[order]
        first = runs(h)
        several = np.minimum.reduceat(number, first) != np.maximum.reduceat(number, first) if len(h) else np.empty(0, bool)
        sent = [(part, planes(k, ANCHOR_BYTES), np.packbits(s).tobytes()) for part, k, s in _parts(h[first] >> np.uint64(8 * ANCHOR_BYTES), n_hash, h[first], several)]
        block = table.column("block")[0].as_py()
        return pa.table({"part": pa.array([s[0] for s in sent], pa.int32()), "block": pa.array([block] * len(sent), pa.int32()), "hashes": pa.array([s[1] for s in sent], pa.binary()), "several": pa.array([s[2] for s in sent], pa.binary())})

    def shared_anchors(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        hashes = [from_planes(b, ANCHOR_BYTES) for b in table.column("hashes").to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(h)) for b, h in zip(table.column("several").to_pylist(), hashes, strict=True)])
        block = np.repeat(table.column("block").to_numpy(), [len(h) for h in hashes])
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        first = runs(h[order])
        size = np.diff(np.r_[first, len(h)])
        shared = np.repeat((size > 1) | (np.add.reduceat(several[order].astype(np.int64), first) > 0), size)
        got = order[shared]
        sent = [(b, planes(k, ANCHOR_BYTES)) for b, k in _parts(block[got].astype(np.uint64), n_docs, h[got])]
        return pa.table({"block": pa.array([s[0] for s in sent], pa.int32()), "part": pa.array([part] * len(sent), pa.int32()), "hashes": pa.array([s[1] for s in sent], pa.binary())})

    def send_windows(docs: pa.Table, shared: pa.Table) -> pa.Table:
        sent: list[tuple] = []
        if docs.num_rows and shared.num_rows:
            words, _, number = _read(docs)
            at, h = _anchors(words)
            known = np.sort(np.concatenate([from_planes(b, ANCHOR_BYTES) | np.uint64(p << (8 * ANCHOR_BYTES)) for p, b in zip(shared.column("part").to_pylist(), shared.column("hashes").to_pylist(), strict=True)]))
            at = at[found_in(_anchor_key(h, n_hash), known)[1]]
            near = np.zeros(len(words.hash) + 1, bool)
            for back in range(PERIOD):
                near[np.where(words.position[at] >= back, at - back, -1)] = True
            at = words.window_starts(WINDOW)
            at = at[near[at]]
            h, second = window_hashes_at(words.hash, at, WINDOW, seed=2), _second(words, at)
            number = number[words.text[at]]
            order = np.lexsort((number, second, h))
            h, second, number = h[order], second[order], number[order]
            first = _pair_runs(h, second)
            several = np.minimum.reduceat(number, first) != np.maximum.reduceat(number, first) if len(h) else np.empty(0, bool)
            sent = [(part, planes(k), planes(k2, SECOND_BYTES), planes(least.view(np.uint64)), np.packbits(s).tobytes()) for part, k, k2, least, s in _parts(h[first] >> np.uint64(32), n_hash, h[first], second[first], number[first], several)]
        block = docs.column("block")[0].as_py() if docs.num_rows else -1
        columns = zip(("hashes", "seconds", "least", "several"), zip(*(s[1:] for s in sent), strict=True) if sent else [()] * 4, strict=True)
        return pa.table({"part": pa.array([s[0] for s in sent], pa.int32()), "block": pa.array([block] * len(sent), pa.int32()), **{name: pa.array(c, pa.binary()) for name, c in columns}})

    def least_documents(table: pa.Table) -> pa.Table:
        hashes = [from_planes(b) for b in table.column("hashes").to_pylist()]
        several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(h)) for b, h in zip(table.column("several").to_pylist(), hashes, strict=True)])
        second, least = (np.concatenate([from_planes(b, width) for b in table.column(c).to_pylist()]) for c, width in (("seconds", SECOND_BYTES), ("least", 8)))
        least = least.view(np.int64)
        block = np.repeat(table.column("block").to_numpy(), [len(h) for h in hashes])
        h = np.concatenate(hashes)
        order = np.lexsort((least, second, h))
        first = _pair_runs(h[order], second[order])
        overall = np.empty(len(h), np.int64)
        overall[order] = np.repeat(least[order][first], np.diff(np.r_[first, len(h)]))
        got = np.flatnonzero((overall < least) | (several > 0))
        sent = [(b, planes(k), planes(k2, SECOND_BYTES), planes(v.view(np.uint64))) for b, k, k2, v in _parts(block[got].astype(np.uint64), n_docs, h[got], second[got], overall[got])]
        columns = zip(("hashes", "seconds", "least"), zip(*(s[1:] for s in sent), strict=True) if sent else [()] * 3, strict=True)
        return pa.table({"block": pa.array([s[0] for s in sent], pa.int32()), **{name: pa.array(c, pa.binary()) for name, c in columns}})

    def keep_rest(docs: pa.Table, least: pa.Table) -> pa.Table:
        words, ids, number = _read(docs) if docs.num_rows else (Words([]), [], np.empty(0, np.int64))
        covered = np.zeros(len(words.hash) + 1, np.int32)
        if docs.num_rows and least.num_rows:
            known, second, by = (np.concatenate([from_planes(b, width) for b in least.column(c).to_pylist()]) for c, width in (("hashes", 8), ("seconds", SECOND_BYTES), ("least", 8)))
            order = np.lexsort((second, known))
            known, second, by = known[order], second[order], by[order].view(np.int64)
            at, h = words.windows(WINDOW, seed=2)
            place, there = found_in(h, known)
            at, h, place = at[there], h[there], place[there]
            other = _second(words, at)
            first = np.full(len(at), np.iinfo(np.int64).max)
            for step in range(int(np.diff(np.r_[runs(known), len(known)]).max())):  # windows with one hash and several second ones, if any
                there = np.minimum(place + step, len(known) - 1)
                same = (known[there] == h) & (second[there] == other)
                first[same] = by[there[same]]
            at = at[first < number[words.text[at]]]
            covered += np.bincount(at, minlength=len(covered)).astype(np.int32)
            covered -= np.bincount(at + WINDOW, minlength=len(covered))[: len(covered)].astype(np.int32)
        gone = np.cumsum(covered)[:-1] > 0
        removed = np.add.reduceat(np.r_[gone, False].astype(np.int64), words.start) * (words.n > 0) if len(ids) else np.empty(0, np.int64)
        rest = [b" ".join([w for w, g in zip(ws, gone[at : at + len(ws)].tolist(), strict=True) if not g] if r else ws) for ws, at, r in zip(words.lists, words.start.tolist(), removed.tolist(), strict=True)]
        return pa.table(_result(ids, words, removed, rest, with_text))

    anchors = blocks.applyInArrow(send_anchors, "part int, block int, hashes binary, several binary")
    shared = anchors.groupBy("part").applyInArrow(shared_anchors, "block int, part int, hashes binary")
    windows = blocks.cogroup(shared.groupBy("block")).applyInArrow(send_windows, "part int, block int, hashes binary, seconds binary, least binary, several binary")
    least = windows.groupBy("part").applyInArrow(least_documents, "block int, hashes binary, seconds binary, least binary")
    with_ids = blocks.cogroup(least.groupBy("block")).applyInArrow(keep_rest, RESULT)
    return with_ids.union(rows.where("doc_id IS NULL").mapInArrow(as_they_are, RESULT))
