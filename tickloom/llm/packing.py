"""Packing documents into fixed windows of token ids by best-fit decreasing.

Every task packs the documents of its own input split, so no text is shuffled and no task grows with the input. The
tokens stream through; only one (length, checksum) pair a piece is kept until the split, or MAX_SHARD_PIECES pieces,
has been read. Then the pieces, longest first, each go to the open window with the least room that still fits, found
in a segment tree over the room left. Overlong documents are first cut into full windows and a rest. Windows that stay
less than OPEN full are not given out: their pieces, a few rows a split, are dealt into groups and packed again together,
so that many small splits, or small shards of one, leave hardly more padding than one large split.

Defined results: a null or empty text is one piece holding just the end id; repeated rows are packed once a row; a null
id is carried; an empty table gives no rows; other columns are not read. Ties in length go by id, then position.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, texts

#: Pieces packed together at most; beyond, a task starts a new shard. Some 100 bytes each.
MAX_SHARD_PIECES = 500_000
#: Windows filled to less than this share are packed again, REPACKED pieces at a time.
OPEN, REPACKED = 0.9, 200_000
#: Bytes of words and their ids, besides Python's own, that a worker's table of encoded words holds before it starts over.
WORD_BYTES = 24_000_000
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 4_000_000
END_ID = 2
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class RoomTree:
    """Segment tree over room 1..capacity; a node holds the number of open windows below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """The (room, window) with the least room >= need, removed from the tree."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        self._change(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Window and offset of each piece (given longest first), and the tokens in each window."""
    tree, window, offset, filled = RoomTree(capacity), np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, n in enumerate(lengths.tolist()):
        if found := tree.take_tightest(n):
            room, w = found
        else:
            room, w = capacity, len(filled)
            filled.append(0)
        window[i], offset[i] = w, filled[w]
        filled[w] += n
        if room > n:
            tree.add(room - n, w)
    return window, offset, filled


class Encoder:
    """Ids of whole texts, word by word.

    The vocabulary's pre-tokenizer never joins characters across white space, so the ids of a text are those of its
    words in turn; each distinct word is encoded once. New words go to the tokenizer many in one string, and its ids are cut
    at the tokens that end a part (letters, a digit, other signs): a word of letters has one part, an ASCII word as many as
    the pre-tokenizer's pattern finds. Where the number of parts differs from that, and for all other words, the tokenizer
    gets each word on its own. `tests/llm` hold this against whole-text encoding.
    """

    PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
    CHUNK = 400

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.table, self.held = Tokenizer.from_file(path), {}, 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and where each text's begin (with their end)."""
        words = pc.ascii_split_whitespace(batch)
        coded = words.flatten().dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        index = coded.indices.to_numpy()
        count = size[index]
        ends = np.r_[0, np.cumsum(count)]
        flat = np.frombuffer(b"".join(ids), "<u4")
        place = np.repeat((np.cumsum(size) - size)[index] - ends[:-1], count) + np.arange(ends[-1])
        bounds = words.offsets.to_numpy()
        return flat[place], ends[bounds - bounds[0]]

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words as little-endian unsigned 32-bit numbers."""
        table = self.table
        found = list(map(table.get, words))
        # the vocabulary has lower case only; but a special token's name must be met as it is, and a capital before a
        # combining mark may compose with it in lower case only, which the tokenizer does not do as it composes first
        lowered = {w: w.lower() if w.isascii() and "<|" not in w else w for w, ids in zip(words, found, strict=True) if ids is None}
        new = {low: b"" for low in lowered.values()}
        new.update((low, table[low]) for low in new.keys() & table.keys())
        self._encode([low for low, ids in new.items() if not ids and low], new)
        fresh = {w: new[low] for w, low in lowered.items()}
        if self.held > WORD_BYTES:
            table.clear()
            self.held = 0
        table.update(fresh)
        self.held += sum(map(len, fresh)) + sum(map(len, fresh.values()))
        return [fresh[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def _encode(self, words: list[str], into: dict[str, bytes]) -> None:
        """Encode new words."""
        letters, signs, alone = [], [], []
        for w in words:
            (letters if w.isalpha() else signs if w.isascii() and "<|" not in w else alone).append(w)
        chunks = [side[i : i + self.CHUNK] for side in (letters, signs) for i in range(0, len(side), self.CHUNK)]
        for lo in range(0, len(chunks), 32):
            some = chunks[lo : lo + 32]
            for chunk, found in zip(some, self.tokenizer.encode_batch_fast([" ".join(c) for c in some], add_special_tokens=False), strict=True):
                ids = np.array(found.ids, "<u4")
                parts = np.cumsum([1 if w.isalpha() else len(self.PARTS.findall(w)) for w in chunk])
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != parts[-1]:
                    alone += chunk
                    continue
                data, cuts = ids.tobytes(), [0, *(4 * ends[parts - 1]).tolist()]
                into.update((w, data[a:z]) for w, a, z in zip(chunk, cuts, cuts[1:], strict=False))
        for lo in range(0, len(alone), 10_000):
            some = alone[lo : lo + 10_000]
            for w, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                into[w] = np.array(found.ids, "<u4").tobytes()


def _batches(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a column of texts of some BATCH_BYTES, with their first row."""
    size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + BATCH_BYTES)))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


_encoders: dict[str, Encoder] = {}


def _packed(pieces: list[tuple], capacity: int, base: int, is_last: bool = True) -> pa.RecordBatch:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) in windows numbered from base; sequence ids of open windows are null unless is_last."""
    pieces.sort(key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1]))
    doc_id, start, length, crc, tokens = zip(*pieces, strict=True)
    window, offset, filled = best_fit_decreasing(np.array(length), capacity)
    total = np.array(filled)
    padded = np.where(total & (total - 1) == 0, total, capacity)[window]
    is_open = np.zeros(len(window), bool) if is_last else ((total < OPEN * capacity) & (total & (total - 1) != 0))[window]
    columns = (doc_id, start, length, crc, tokens, pa.array(window + base, mask=is_open), offset, padded)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COLUMNS)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: where it lies in its document and in which window. See the module's description."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer_path) or _encoders.setdefault(tokenizer_path, Encoder(tokenizer_path))
        end, cut = np.array([end_id], "<u4").tobytes(), 4 * capacity
        base, pieces = TaskContext.get().partitionId() << 33, []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal base
            out = _packed(pieces, capacity, base, is_last=False)
            base += len(pieces)
            pieces.clear()
            for at in range(0, out.num_rows, 20_000):
                yield out.slice(at, 20_000)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, part in _batches(batch.column(1)):
                ids, bounds = encoder.encode(part)
                for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    data = ids[a:z].tobytes() + end
                    pieces.extend((doc_ids[first + i], at // 4, len(data[at : at + cut]) // 4, zlib.crc32(data[at : at + cut]), len(data) // 4) for at in range(0, len(data), cut))
            if len(pieces) >= MAX_SHARD_PIECES:
                yield from packed()
        if pieces:
            yield from packed()

    def again(table: pa.Table) -> pa.Table:
        pieces = list(zip(*(table.column(c).to_pylist() for c in COLUMNS[:5]), strict=True))
        return pa.Table.from_batches([_packed(pieces, capacity, (1 << 61) + (table.column("part")[0].as_py() << 33))])

    once = staged(texts(docs, id_col, text_col).mapInArrow(task, SCHEMA), "packing")
    left = once.where("sequence_id IS NULL")
    groups = -(-left.count() // REPACKED)
    if not groups:
        return once
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("int").alias("part")
    return once.where("sequence_id IS NOT NULL").union(left.select("*", part).groupBy("part").applyInArrow(again, SCHEMA))
