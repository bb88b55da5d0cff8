"""Helpers shared by the training-data operators: staging in the shared folder and per-worker word tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries a worker keeps in one word table before it starts over, and the longest word that enters one; together they bound
#: a worker's memory to roughly 200 MB a table.
WORD_TABLE_ENTRIES, WORD_TABLE_LETTERS = 700_000, 64


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which every executor and the driver can reach.

    Where the session names none, a session of one process (tests, benchmarks) gets a temporary folder; a cluster is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tickloom-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back; survives lost executors.

    The write's own shuffle files go when it ends, as nothing reads them again.
    """
    return _written(df, shared_dir(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark, schema = df.sparkSession, df.schema
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


class Scratch:
    """Staged tables of one run, in a folder of their own; each can be dropped once nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.tables = spark, shared_dir(spark, name), {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{len(self.tables):03d}-{name}"
        out = _written(df, path)
        self.tables[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.tables[id(table)][1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def block_count(df: DataFrame, block_bytes: int = 128 << 20) -> int:
    """Blocks to deal a table's work to: at least one a shuffle partition, and so many that none has over block_bytes of input.

    A block is held in memory, so its size follows the input's bytes and no setting; a partition takes several blocks in turn.
    """
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // block_bytes))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that df reads, by Spark's own statistics; 0 where they are unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return size if size < 1 << 60 else 0  # Spark's mark for an unknown size


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, renamed; a null text is empty. Other columns, whatever their names, go."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """The cells of a column of strings or bytes, as bytes."""
    return column.cast(pa.large_binary()).to_pylist()


class WordTable(dict):
    """word (bytes) -> its row in the array `hashes`, whose two columns are the halves of a 128-bit hash; filled on first sight."""

    def __init__(self):
        self.hashes = np.empty((1 << 12, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self)
        if row == len(self.hashes):
            self.hashes = np.concatenate((self.hashes, np.empty_like(self.hashes)))
        self.hashes[row] = _halves(word)
        return row

    def of(self, words: list[bytes]) -> np.ndarray:
        """The hashes of words, a row each. The table starts over between texts once it is full or holds long words."""
        if len(self) > WORD_TABLE_ENTRIES:
            self.clear()
        if not words or max(map(len, words)) <= WORD_TABLE_LETTERS:
            rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))  # may put a longer array in the place of hashes
            return self.hashes[rows]
        rows = [self[w] if len(w) <= WORD_TABLE_LETTERS else 0 for w in words]
        out = self.hashes[rows]
        for i, w in enumerate(words):
            if len(w) > WORD_TABLE_LETTERS:
                out[i] = _halves(w)
        return out


def _halves(word: bytes) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(word)
    return both & 0xFFFFFFFFFFFFFFFF, both >> 64


WORDS = WordTable()


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants from a fixed rule."""
    return np.array([xxhash.xxh3_64_intdigest(b"%d" % i, seed) | 1 for i in range(n)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def window_hashes(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """One 64-bit hash for each run of k consecutive word hashes (none if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i, m in enumerate(multipliers(k, seed)):
        out += (h[i : i + n] ^ (h[i : i + n] >> np.uint64(29))) * m
    return mixed(out)


def window_hashes_at(h: np.ndarray, at: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """window_hashes(h, k, seed)[at] without the others."""
    out = np.zeros(len(at), np.uint64)
    for i, m in enumerate(multipliers(k, seed)):
        part = h[at + i]
        out += (part ^ (part >> np.uint64(29))) * m
    return mixed(out)


#: An odd base below which window sums are written, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared and so on modulo 2**64, kept for the next call."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n, 1024) * 5 // 4, base, np.uint64)])
        if len(held) <= 1 << 22:
            _POWERS[base] = held
    return held[:n]


def rolling_hashes(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Karp-Rabin hashes of each run of k consecutive numbers (none if there are fewer), in a few passes whatever k is.

    A run's sum of number times base to its position is the difference of two prefix sums; times the inverse base to the
    run's start it does not depend on where the run is.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(mixed(h + np.uint64(seed)) * _powers(_BASE, len(h)))]
    return mixed((sums[k:] - sums[:-k]) * _powers(pow(_BASE, -1, 1 << 64), n))


class RunHashes:
    """Karp-Rabin hashes of runs of any length: equal for equal runs of numbers, wherever they are."""

    def __init__(self, h: np.ndarray):
        self.sums = np.r_[np.uint64(0), np.cumsum(mixed(h + np.uint64(1)) * _powers(_BASE, len(h)))]
        self.back = _powers(pow(_BASE, -1, 1 << 64), len(h) + 1)

    def of(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]


class Words:
    """The words of many texts, end to end: hash, text number and position of each, and the words left in its text."""

    def __init__(self, contents: list[bytes | None]):
        self.lists = [t.split() if t else [] for t in contents]  # bytes.split() cuts at exactly space and \t to \r
        self.n = np.fromiter(map(len, self.lists), np.int64, len(self.lists))
        self.start = np.cumsum(self.n) - self.n
        self.hashes = np.empty((int(self.n.sum()), 2), np.uint64)
        for words, at in zip(self.lists, self.start.tolist(), strict=True):
            self.hashes[at : at + len(words)] = WORDS.of(words)
        self.hash = np.ascontiguousarray(self.hashes[:, 0])
        self.text = np.repeat(np.arange(len(self.lists)), self.n)
        self.position = np.arange(len(self.hash)) - self.start[self.text]

    def window_starts(self, k: int) -> np.ndarray:
        """First word (its place here) of every window of k words that lies in one text."""
        return np.flatnonzero((self.n[self.text] - self.position)[: max(0, len(self.hash) - k + 1)] >= k)

    def windows(self, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of k words that lies in one text."""
        at = self.window_starts(k)
        return at, window_hashes(self.hash, k, seed)[at]


def planes(values: np.ndarray, n_bytes: int = 8) -> bytes:
    """The low n_bytes of each number, all lowest bytes first, which a shuffle's codec shrinks well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].T).tobytes()


def from_planes(blob: bytes, n_bytes: int = 8) -> np.ndarray:
    out = np.zeros((len(blob) // n_bytes, 8), np.uint8)
    out[:, :n_bytes] = np.frombuffer(blob, np.uint8).reshape(n_bytes, -1).T
    return out.view("<u8").ravel()


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start in an ordered array."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)


def slices(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal numbers start and end in an ordered array; none in an empty one."""
    first = runs(ordered).tolist()
    return list(zip(first, [*first[1:], len(ordered)], strict=True)) if first else []


def found_in(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in an ordered array, and whether it is there."""
    if not len(ordered):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return at, ordered[at] == values
