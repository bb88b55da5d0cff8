"""Set-similarity self-join of documents on word n-grams, by PartEnum signatures, and the groups that its links form.

Two sets link when their Jaccard similarity reaches a bound g. Then their sizes differ by a factor of at most 1/g, and
their symmetric difference is at most k = (|x| + |y|) (1 - g) / (1 + g). Sizes fall into bands [l, l/g], and a set takes
part in its own band's join and the next one's. In a band the n-grams' domain is cut by a hash into n1 parts of n2 cells
each, with n1 so large that two linked sets differ in at most k2 cells of some part (of SPARE parts, where k is large); for
every part and every choice of n2 - k2 of its cells, the n-grams in those cells make a signature. So linked sets share a
signature. Signatures without any n-gram would gather unlike sets: a set with fewer than SPARE parts that have one leaves
them out, as then some part in which it agrees with a linked set has none. k2 and n2 follow from g, so that a signature
covers six n-grams or so at least. Steps:

1. Each document's set is built once. Equal sets are one node and from here on count as one. Signatures go, with nodes, to
   hash blocks, which return the lists of nodes with the same signature; equal lists count once. A signature that many
   documents of a slice have is dealt out to several blocks, slice by slice, and its list comes in as many pieces.
2. Every list's least node is compared with the other members, a star: first sketches (counts of n-grams in buckets, 128 or
   over a quarter of the set's size, never further apart than their sets), then sets: each member's with the least node it
   passed with, and once these links have made components, those of the other pairs that passed and lie in different ones.
3. Lists whose members are in several components: every member outside the list's largest component names the nearest
   members of other components, by sketches, and these pairs are compared. Components again.
4. Where some member had further such pairs, the sets of all members that had any go to blocks of lists with the same least
   node, which compare every pair that sketches allow and components still separate, a pair once a block whatever lists it
   is in, and return only links that join two components: no more rows than members. Then no such pair is left.

Pairs inside a component need no comparison, as they cannot change the groups; every comparison that could join two
components is made, so the groups are exact. A list with a third of all documents costs one comparison a member, plus
sketches of those outside its largest component against the others, in units of PIECE members a side. Equal nodes are told
by 128 bits, n-grams by 64.

Defined results: texts without words, or null, have an empty set and link with nothing; fewer than n words make one gram;
rows with a null id are joined like others, and a component of only such rows has a null id, a component_id being the
least of the ids that are there; repeated rows are copies; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, Words, block_count, from_planes, mixed, planes, runs, slices, texts, window_hashes
from .components import components

#: Parts in which linked sets agree, where k is at least LARGE_K; below, one.
SPARE, LARGE_K = 3, 24
#: Buckets of a sketch at least.
SKETCH = 128
#: Bytes of a signature that are sent to its block, which is chosen by the others.
SIGNATURE_BYTES = 4
#: Documents handled at a time, and how many of them make a signature hot when they share it.
SLICE, HOT = 2000, 24
#: Members of a list on one side of a unit of comparisons.
PIECE = 2048
#: Members of lists with one least node that go to one block, and pairs looked at in one go there.
LOAD, PAIRS = 1 << 17, 1 << 18
#: Cells of a table of members that is held at a time, and bytes of sets in a share.
CELLS, SET_BYTES = 1 << 25, 64 << 20
#: Nearest members that a member names.
NAMES = 2
#: Pairs of one node that are compared in one block.
SHARE = 256
_LOW = np.uint64(2**32 - 1)
_NO_ID = -(2**63)


def size_bands(percent: int, largest: int) -> list[tuple[int, int]]:
    """Bands [l, r] of set sizes with r = l * 100 / percent, from 1 up to the one that holds the largest size and one more."""
    bands, low = [], 1
    while len(bands) < 2 or bands[-2][1] < largest:
        bands.append((low, max(low, 100 * low // percent)))
        low = bands[-1][1] + 1
    return bands


def cells_of_parts(percent: int) -> tuple[int, int]:
    """(k2, n2): cells of a part that a signature leaves out, and its cells, for six n-grams a signature on average."""
    share = (100 - percent) / (100 + percent)
    for k2, n2 in ((1, 3), (2, 5), (3, 7)):
        if (k2 + 1) / (2 * share) * (n2 - k2) / n2 >= 5.9:
            return k2, n2
    return 3, 7


def band_parts(high: int, percent: int) -> int:
    """Parts in a band whose larger sets have up to high n-grams; 0 where only equal sets can link."""
    k = 2 * high * (100 - percent) // (100 + percent)
    return k // (cells_of_parts(percent)[0] + 1) + (SPARE if k >= LARGE_K else 1) if k else 0


class Sets:
    """Distinct n-grams of many texts, ASCII letters lowered: text number and hash of each, ordered; size, key and second hash of each text."""

    def __init__(self, contents: list[bytes | None], n: int):
        words = Words([t.lower() if t else t for t in contents])
        at, h = words.windows(n)
        count = np.maximum(words.n - n + 1, 0)
        start = np.cumsum(count) - count
        rows = []
        for i, (lo, size, few) in enumerate(zip(start.tolist(), count.tolist(), words.n.tolist(), strict=True)):
            if size:
                row = np.sort(h[lo : lo + size])
                rows.append(row[np.r_[True, row[1:] != row[:-1]]])
            else:
                a = int(words.start[i])
                rows.append(window_hashes(words.hash[a : a + few], few, seed=100 + few) if few else np.empty(0, np.uint64))
        self.rows = rows
        self.size = np.fromiter(map(len, rows), np.int64, len(rows))
        self.gram = np.concatenate(rows) if rows else np.empty(0, np.uint64)
        self.text = np.repeat(np.arange(len(rows)), self.size)
        some = np.flatnonzero(self.size)
        self.key, self.check = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        if len(some):
            first = (np.cumsum(self.size) - self.size)[some]
            self.key[some], self.check[some] = (mixed(np.add.reduceat(mixed(self.gram ^ np.uint64(seed)), first) + self.size[some].astype(np.uint64)).view(np.int64) for seed in (5, 11))

    def signatures(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Text number and signature, for the sets' own bands and the next ones."""
        if not len(self.gram):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        bands = size_bands(percent, int(self.size.max()))
        band = np.searchsorted([high for _, high in bands], self.size)
        parts = np.array([band_parts(high, percent) for _, high in bands])
        spare = np.array([SPARE if 2 * high * (100 - percent) // (100 + percent) >= LARGE_K else 1 for _, high in bands])
        k2, n2 = cells_of_parts(percent)
        kept = np.zeros((n2, math.comb(n2, k2)), bool)
        for i, cells in enumerate(combinations(range(n2), n2 - k2)):
            kept[list(cells), i] = True
        owners, found = [], []
        for up in (0, 1):
            own = np.minimum(band + up, len(bands) - 1)
            n1 = np.where(self.size > 0, parts[own], 0)
            cells = n2 * n1
            first = np.cumsum(cells) - cells
            used = n1[self.text] > 0
            gram, text = self.gram[used], self.text[used]
            cell = first[text] + (mixed(gram + np.uint64(99)) % cells[text].astype(np.uint64)).astype(np.int64)
            total = int(cells.sum())
            low, high = (np.bincount(cell, weights=v.astype(float), minlength=total).astype(np.uint64) for v in (gram & _LOW, gram >> np.uint64(32)))
            sums = mixed(low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xC2B2AE3D27D4EB4F)).reshape(-1, n2)
            held = np.bincount(cell, minlength=total).reshape(-1, n2)
            covered = np.column_stack([sums[:, kept[:, i]].sum(axis=1, dtype=np.uint64) for i in range(kept.shape[1])])
            bare = np.column_stack([held[:, kept[:, i]].sum(axis=1) == 0 for i in range(kept.shape[1])])
            owner = np.repeat(np.arange(len(n1)), n1)
            bare_parts = np.bincount(owner, weights=bare.any(axis=1), minlength=len(n1))
            stays = ~bare | (bare_parts >= spare[own])[owner][:, None]
            part = np.arange(len(owner)) - (first // n2)[owner]
            place = (((band[owner] + up).astype(np.uint64) << np.uint64(32)) | part.astype(np.uint64))[:, None] * np.uint64(64) + np.arange(kept.shape[1], dtype=np.uint64)
            signature = mixed(covered + mixed(place))
            owners.append(np.broadcast_to(owner[:, None], stays.shape)[stays])
            found.append(signature[stays])
        return np.concatenate(owners), np.concatenate(found)

    def sketches(self) -> list[bytes]:
        """Counts of each set's n-grams in its buckets, modulo 256."""
        width = buckets(self.size)
        end = np.cumsum(width)
        bucket = (end - width)[self.text] + (mixed(self.gram + np.uint64(3)) & (width - 1).astype(np.uint64)[self.text]).astype(np.int64)
        counts = np.bincount(bucket, minlength=int(width.sum())).astype(np.uint8).tobytes()
        return [counts[hi - n : hi] for n, hi in zip(width.tolist(), end.tolist(), strict=True)]


def buckets(size: np.ndarray) -> np.ndarray:
    """Buckets in the sketches of sets of these sizes: the least power of two over a quarter of the size, SKETCH at least.

    So many tell sets apart that share well under the bound; a fixed number would tell nothing of long texts.
    """
    return np.maximum(SKETCH, 1 << np.frexp(size // 4)[1].astype(np.int64))


class Sketched:
    """Sizes and sketches of nodes, which are named by their places here."""

    def __init__(self, size: np.ndarray, sketches: list[bytes]):
        self.size, self.width, self.tables = size, buckets(size), {}
        w = int(self.width.max(initial=SKETCH))
        held, table = np.empty(0, np.int64), np.empty((0, 2 * w), np.uint8)
        while w >= SKETCH:  # wider sketches are folded, as a bucket is a hash's lowest bits
            own = np.flatnonzero(self.width == w)
            fresh = np.frombuffer(b"".join([sketches[i] for i in own.tolist()]), np.uint8).reshape(-1, w)
            held, table = np.concatenate((held, own)), np.concatenate((table.reshape(len(held), 2, w).sum(axis=1, dtype=np.uint8), fresh))
            row = np.zeros(len(size), np.int64)
            row[held] = np.arange(len(held))
            self.tables[w] = row, table
            w //= 2

    def may_link(self, p: np.ndarray, q: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether sizes and sketches allow a link of each pair, and what its symmetric difference is at least."""
        may, apart = _sizes_allow(self.size[p], self.size[q], percent), np.zeros(len(p), np.int64)
        width = np.minimum(self.width[p], self.width[q])
        for w, (row, table) in sorted(self.tables.items()):
            at = np.flatnonzero(may & ((width == w) | (w == SKETCH)))
            for part in np.array_split(at, len(at) * w // (1 << 22) + 1):
                x, y = p[part], q[part]
                apart[part] = _apart_at_least(table[row[x]], table[row[y]])
                may[part] = (100 + percent) * apart[part] <= (100 - percent) * (self.size[x] + self.size[y])
        return may, apart


def _binary(column: pa.ChunkedArray | pa.Array) -> list:
    return column.cast(pa.large_binary()).to_pylist()


def _pairs(key: np.ndarray, other: np.ndarray, *more: tuple[str, pa.Array]) -> pa.Table:
    return pa.table({"a": pa.array(key, pa.int64()), "b": pa.array(other, pa.int64())} | dict(more))


class Joined:
    """What a self-join of documents has found: rows (doc_id, text_hash, node, n_shingles), one a document, and labels (node, root).

    A node is a distinct set; nodes without a label are linked with no other.
    """

    def __init__(self, rows: DataFrame, labels: DataFrame, scratch: Scratch):
        self.scratch = scratch
        self.rooted = rows.join(labels, "node", "left").select("doc_id", "text_hash", "n_shingles", F.coalesce("root", "node").alias("root"))

    def groups(self) -> DataFrame:
        """doc_id, n_shingles, component_id of each document."""
        least = self.scratch.stage(self.rooted.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
        own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
        return self.rooted.join(least, "root", "left").select("doc_id", "n_shingles", own.alias("component_id"))

    def keepers(self) -> DataFrame:
        """(doc_id, text_hash, n): the row of each group that stays, and how many rows are just like it. Empty sets have no group."""
        rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
        same = self.rooted.where("n_shingles > 0").groupBy("root", rank.alias("row")).agg(F.count(F.lit(1)).alias("n"))
        first = same.groupBy("root").agg(F.min(F.struct("row", "n")).alias("f"))
        return first.select(F.col("f.row.doc_id").alias("doc_id"), F.col("f.row.text_hash").alias("text_hash"), "f.n")


#: What gives the sets' text numbers and signatures; sets that link share one.
Signer = Callable[[Sets, int], tuple[np.ndarray, np.ndarray]]


def join_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", hash_blocks: int | None = None, signer: Signer = Sets.signatures) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id. See the module's description."""
    return _joined(docs, n, percent, id_col, text_col, hash_blocks, signer).groups()


def _joined(docs: DataFrame, n: int, percent: int, id_col: str = "doc_id", text_col: str = "text", hash_blocks: int | None = None, signer: Signer = Sets.signatures) -> Joined:
    scratch = Scratch(docs.sparkSession, "ngram-join")
    blocks = hash_blocks or block_count(docs)
    source = texts(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = scratch.stage(_grouped(source, n, percent, blocks, signer), "found")
    rows, lists = _resolved(found.where("kind = 'doc'"), found.where("kind = 'list'").select("list", "center", "members").dropDuplicates(["list", "members"]), scratch)
    lists = scratch.stage(lists, "lists")
    known = rows.where("n_shingles > 0").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("h"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch"))
    profiles = scratch.stage(known.select("node", F.col("h.doc_id").alias("holder"), F.col("h.text_hash").alias("holder_text"), "size", "sketch"), "profiles")

    rows = scratch.stage(rows.select("doc_id", "text_hash", "node", "n_shingles"), "rows")
    scratch.drop(found)

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sets link."""
        sets = scratch.stage(_wanted_sets(source, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), profiles, n), "sets")
        links = scratch.stage(_compared(pairs, sets.select("node", F.col("grams").alias("value")), blocks, lambda *p: _linking(*p, percent), "a long, b long", "a"), "links")
        scratch.drop(sets)
        return links

    stars = lists.select(F.col("center").alias("a"), F.explode("members").alias("b")).where("a <> b").distinct()
    described = profiles.select("node", F.concat(F.encode(F.lpad(F.hex("size"), 16, "0"), "UTF-8"), "sketch").alias("value"))
    tested = scratch.stage(_compared(stars, described, blocks, lambda *p: _alike(*p, percent), "a long, b long", "b"), "alike")
    labels = components(linked(tested.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")))
    rest = scratch.stage(_apart(tested, labels), "rest")
    if not rest.isEmpty():
        labels = _with_links(labels, linked(rest))
    sides = scratch.stage(_sides(_members(lists), labels, LOAD), "sides")
    near = scratch.stage(_nearest(sides, profiles, percent, NAMES, blocks), "near")
    new = scratch.stage(near.where("b IS NOT NULL").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "new")
    if not new.isEmpty():
        labels = _with_links(labels, linked(new))
    if near.where("more").isEmpty():
        return Joined(rows, labels, scratch)
    scratch.drop(sides)
    suspects = near.where("b IS NULL").select(F.col("a").alias("node")).distinct()
    mean = profiles.join(suspects, "node", "left_semi").agg(F.avg("size")).first()[0]
    load = max(2 * PIECE, SET_BYTES // (8 * int(mean)))
    sides = scratch.stage(_sides(_members(lists).join(suspects, "node", "left_semi"), labels, load), "sides")
    sets = scratch.stage(_wanted_sets(source, sides.select("node").distinct(), profiles, n), "sets")
    links = scratch.stage(_settled(sides, profiles.join(sets, "node"), percent, blocks), "links")
    scratch.drop(sides, sets)
    return Joined(rows, _with_links(labels, links), scratch)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in different components."""
    rooted = pairs
    for side in "ab":
        rooted = rooted.join(labels.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    return rooted.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components that labels and further links form together."""
    return components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def _resolved(docs: DataFrame, lists: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The documents with a node each, and the lists of nodes: where a key stands for two sets, which their second hash tells, each has its own."""
    twice = scratch.stage(docs.groupBy("key").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select("key", "low"), "twice")
    if twice.isEmpty():
        return docs.withColumnRenamed("key", "node"), lists
    other = F.when(F.col("low").isNull() | (F.col("check") == F.col("low")), F.col("key")).otherwise(F.xxhash64("key", "check"))
    docs = docs.join(twice, "key", "left").withColumn("node", other)
    nodes = scratch.stage(docs.where("low IS NOT NULL").select("key", "node").distinct(), "nodes")
    each = lists.select("list", F.explode("members").alias("key")).join(nodes, "key", "left").select("list", F.coalesce("node", "key").alias("node"))
    apart = nodes.select(F.format_string("key %d", "key").alias("list"), "node")
    return docs, each.union(apart).groupBy("list").agg(F.min("node").alias("center"), F.collect_set("node").alias("members"))


def _grouped(source: DataFrame, n: int, percent: int, blocks: int, signer: Signer) -> DataFrame:
    """Rows of kind doc (doc_id, text_hash, key, check, n_shingles, sketch) and of kind list (list, center, members)."""
    sent_as = (("part", pa.int32()), ("what", pa.string()), *((c, pa.binary()) for c in ("ids", "hashes", "keys", "checks", "sizes", "sketches", "signatures")))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part, turn = batch.slice(lo, SLICE), turn + 1
                sets = Sets(_binary(part.column("text")), n)
                ids, hashes = (part.column(c).fill_null(_NO_ID).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("doc_id", "text_hash"))
                none = [None] * 7
                out = [(turn % blocks, "doc", planes(ids), planes(hashes), planes(sets.key.view(np.uint64)), planes(sets.check.view(np.uint64)), planes(sets.size.view(np.uint64), 4), b"".join(sets.sketches()), None)]
                distinct = np.zeros(part.num_rows, bool)
                distinct[np.unique(np.column_stack((sets.key, sets.check)), axis=0, return_index=True)[1]] = True
                owner, signature = signer(sets, percent)
                order = np.flatnonzero(distinct[owner])
                order = order[np.argsort(signature[order], kind="stable")]
                owner, signature = owner[order], signature[order]
                first = runs(signature)
                times = np.diff(np.r_[first, len(signature)])
                hot = np.repeat(times >= HOT, times)
                block = ((signature >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
                marks = first[times >= HOT]
                for a, z in slices(block[marks][by_block := np.argsort(block[marks], kind="stable")]):
                    at = marks[by_block[a:z]]
                    out.append((int(block[at[0]]), "mark", *none[:6], planes(signature[at])))
                block[hot] = (block[hot] + 1 + turn) % blocks
                order = np.lexsort((owner, hot, block))
                for a, z in slices(block[order] * 2 + hot[order]):
                    at = order[a:z]
                    first = runs(owner[at])
                    times = np.diff(np.r_[first, len(at)]).astype(np.uint64)
                    what, width = ("hot", 8) if hot[at[0]] else ("signature", SIGNATURE_BYTES)
                    out.append((int(block[at[0]]), what, *none[:2], planes(sets.key[owner[at][first]].view(np.uint64)), None, planes(times, 4), None, planes(signature[at], width)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), sent_as, strict=True)], names=[name for name, _ in sent_as])

    def gather(table: pa.Table) -> pa.Table:
        what = np.array(table.column("what").to_pylist())
        cells = {c: table.column(c).to_pylist() for c in ("ids", "hashes", "keys", "checks", "sizes", "sketches", "signatures")}

        def read(column: str, rows: list[int], n_bytes: int = 8) -> np.ndarray:
            return np.concatenate([from_planes(cells[column][i], n_bytes) for i in rows] or [np.empty(0, np.uint64)])

        def signed(kind: str, width: int) -> tuple[np.ndarray, np.ndarray]:
            at = np.flatnonzero(what == kind).tolist()
            return read("signatures", at, width), np.repeat(read("keys", at).view(np.int64), read("sizes", at, 4).view(np.int64))

        docs = np.flatnonzero(what == "doc").tolist()
        ids, hashes, keys, checks, sizes = (read(c, docs, w).view(np.int64) for c, w in (("ids", 8), ("hashes", 8), ("keys", 8), ("checks", 8), ("sizes", 4)))
        width = buckets(sizes)
        end, together = np.cumsum(width), b"".join([cells["sketches"][i] for i in docs])
        sketches = [together[hi - n : hi] for n, hi in zip(width.tolist(), end.tolist(), strict=True)]
        marked = np.unique(read("signatures", np.flatnonzero(what == "mark").tolist()))
        names, members = (x + y for x, y in zip(_lists(*signed("signature", SIGNATURE_BYTES), marked), _hot_lists(*signed("hot", 8)), strict=True))
        no_doc, no_list = len(members), len(ids)
        column = lambda values, kind, before=0, after=0: pa.chunked_array([pa.nulls(before, kind), pa.array(values, kind), pa.nulls(after, kind)])
        return pa.table(
            {
                "kind": pa.array(["doc"] * len(ids) + ["list"] * len(members), pa.string()),
                "doc_id": column(pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.int64(), 0, no_doc),
                **{c: column(v, pa.int64(), 0, no_doc) for c, v in (("text_hash", hashes), ("key", keys), ("check", checks), ("n_shingles", sizes))},
                "sketch": column(sketches, pa.binary(), 0, no_doc),
                "list": column(names, pa.string(), no_list),
                "center": column([m.min() for m in members], pa.int64(), no_list),
                "members": column(members, pa.list_(pa.int64()), no_list),
            }
        )

    sent = source.mapInArrow(send, ", ".join(f"{c} {'int' if c == 'part' else 'string' if c == 'what' else 'binary'}" for c, _ in sent_as))
    return sent.groupBy("part").applyInArrow(gather, "kind string, doc_id long, text_hash long, key long, check long, n_shingles long, sketch binary, list string, center long, members array<long>")


def _by_signature(signature: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures and their distinct members in order, and where each signature's start and how many they are."""
    order = np.lexsort((member, signature))
    signature, member = signature[order], member[order]
    new = np.r_[True, (signature[1:] != signature[:-1]) | (member[1:] != member[:-1])] if len(member) else np.empty(0, bool)
    signature, member = signature[new], member[new]
    start = runs(signature)
    return signature, member, start, np.diff(np.r_[start, len(member)])


def _lists(signature: np.ndarray, member: np.ndarray, marked: np.ndarray) -> tuple[list[str], list[np.ndarray]]:
    """Names and members of the lists of a block: several members of a signature, or any of one that is marked as hot elsewhere."""
    signature, member, start, length = _by_signature(signature, member)
    if not len(member):
        return [], []
    hashed = [mixed(np.add.reduceat(mixed(member.view(np.uint64) ^ np.uint64(seed)), start) + length.astype(np.uint64)) for seed in (7, 13)]
    low = marked & np.uint64(2 ** (8 * SIGNATURE_BYTES) - 1)
    own = signature[start]
    plain = (length > 1) & ~np.isin(own, low)
    _, once = np.unique(np.column_stack([h[plain] for h in hashed]), axis=0, return_index=True)
    names, members = [], []
    for i in np.flatnonzero(plain)[once].tolist():
        names.append(f"{int(hashed[0][i]):016x}{int(hashed[1][i]):016x}")
        members.append(member[start[i] : start[i] + length[i]])
    for full, i in ((full, i) for full, short in zip(marked.tolist(), low, strict=True) for i in np.flatnonzero(own == short).tolist()):
        names.append(f"hot {full:016x}")
        members.append(member[start[i] : start[i] + length[i]])
    return names, members


def _hot_lists(signature: np.ndarray, member: np.ndarray) -> tuple[list[str], list[np.ndarray]]:
    """Names and members of the pieces of hot lists that came to a block."""
    signature, member, start, length = _by_signature(signature, member)
    return [f"hot {s:016x}" for s in signature[start].tolist()], [member[a : a + size] for a, size in zip(start.tolist(), length.tolist(), strict=True)]


def _compared(pairs: DataFrame, values: DataFrame, blocks: int, judge: Callable, schema: str, around: str) -> DataFrame:
    """What judge(a, b, values of a, values of b) keeps of the pairs (a, b), given as numbers and bytes.

    Pairs meet in the block of the node named by around, those of a node with more than SHARE pairs in several blocks, and a
    value is sent once to each block that needs it.
    """
    other = "b" if around == "a" else "a"
    many = pairs.groupBy(around).agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares")).where("shares > 1")
    share = F.pmod(F.xxhash64(other), F.coalesce("shares", F.lit(1)))
    asked = pairs.join(many, around, "left").select("a", "b", F.pmod(F.xxhash64(around, share), F.lit(blocks)).cast("int").alias("block"))
    nodes = asked.select(F.col("block").alias("held_in"), F.explode(F.array("a", "b")).alias("node")).distinct()
    sent = values.join(nodes, "node").select("held_in", "node", "value")

    def compare(held: pa.Table, asked: pa.Table) -> pa.Table:
        value = dict(zip(held.column("node").to_pylist(), held.column("value").to_pylist(), strict=True))
        wanted = sorted((x, y) for x, y in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist(), strict=True) if x in value and y in value)
        parts = [judge([x for x, _ in part], [y for _, y in part], [value[x] for x, _ in part], [value[y] for _, y in part]) for part in (wanted[i : i + 20_000] for i in range(0, len(wanted), 20_000))]
        return pa.concat_tables(parts or [_pairs(np.empty(0, np.int64), np.empty(0, np.int64))])

    return sent.groupBy("held_in").cogroup(asked.groupBy("block")).applyInArrow(compare, schema)


def _alike(a: list[int], b: list[int], x: list[bytes], y: list[bytes], percent: int) -> pa.Table:
    """Pairs that sizes and sketches, in this order in the values, do not rule out."""
    value = dict(zip(a, x, strict=True)) | dict(zip(b, y, strict=True))
    nodes = np.array(sorted(value), np.int64)
    known = Sketched(np.array([int(value[n][:16], 16) for n in nodes.tolist()], np.int64), [value[n][16:] for n in nodes.tolist()])
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    may, _ = known.may_link(np.searchsorted(nodes, a), np.searchsorted(nodes, b), percent)
    return _pairs(a[may], b[may])


def _linking(a: list[int], b: list[int], x: list[bytes], y: list[bytes], percent: int) -> pa.Table:
    """Pairs whose sets link."""
    holds, last, grams_a = np.zeros(len(a), bool), None, None
    for i, (u, v) in enumerate(zip(x, y, strict=True)):
        if a[i] != last:
            last, grams_a = a[i], from_planes(u)
        grams_b = from_planes(v)
        small, large = sorted((len(grams_a), len(grams_b)))
        if 100 * small >= percent * large:
            both = np.concatenate((grams_a, grams_b))
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            holds[i] = 100 * common >= percent * (small + large - common)
    return _pairs(np.array(a, np.int64)[holds], np.array(b, np.int64)[holds])


def _apart_at_least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the symmetric difference is at least, from sketches."""
    apart = np.abs(x.astype(np.int16) - y.astype(np.int16))
    return np.minimum(apart, 256 - apart).sum(axis=1).astype(np.int64)


def _sizes_allow(size_x: np.ndarray, size_y: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(size_x, size_y) >= percent * np.maximum(size_x, size_y)


def _wanted_sets(source: DataFrame, nodes: DataFrame, profiles: DataFrame, n: int) -> DataFrame:
    """(node, grams) of the nodes; each is built from one document, which its id and its text's hash name."""
    wanted = profiles.join(nodes, "node", "left_semi").select("node", "holder", "holder_text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                sets = Sets(_binary(part.column("text")), n)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([planes(row) for row in sets.rows], pa.binary())], names=["node", "grams"])

    held = source.join(wanted, source.doc_id.eqNullSafe(wanted.holder) & (source.text_hash == wanted.holder_text))
    return held.select("node", "text").mapInArrow(build, "node long, grams binary")


def _members(lists: DataFrame) -> DataFrame:
    """(list, node) of the lists that may hold a pair not compared yet; a list is told by a hash of its name."""
    return lists.where((F.size("members") > 2) | F.col("list").like("hot %") | F.col("list").like("key %")).select(F.xxhash64("list").alias("list"), F.explode("members").alias("node"))


def _sides(members: DataFrame, labels: DataFrame, load: int) -> DataFrame:
    """Members (share, unit, node, root, is_left) of the lists that hold several components; left: those outside the list's largest one.

    Lists are compared in units of some PIECE members a side, dealt by a hash of the member; unit names them. Units whose
    lists have the same least node have their share in common, one for each `load` members.
    """
    rooted = members.join(labels, "node", "left").select("list", "node", F.coalesce("root", "node").alias("root"))
    by_root = rooted.groupBy("list", "root").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"))
    mixed_lists = by_root.groupBy("list").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("largest"), F.sum("n").alias("total"), F.min("low").alias("low")).where("total > largest")
    shares = F.ceil(F.sum("total").over(Window.partitionBy("low")) / load)
    mixed_lists = mixed_lists.select("list", "main", "largest", "total", F.xxhash64("low", F.pmod("list", shares)).alias("deal"))
    outside = F.col("root") != F.col("main")
    count = lambda c: F.greatest(F.lit(1), F.ceil(c / PIECE)).cast("int")
    place = lambda pieces: F.pmod(F.xxhash64("node"), pieces).cast("int")
    sided = rooted.join(mixed_lists, "list").select("list", "deal", "node", "root", outside.alias("outside"), count(F.col("total") - F.col("largest")).alias("lefts"), count(F.col("total")).alias("rights"))
    left = sided.where("outside").select("list", "deal", "node", "root", place(F.col("lefts")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("j"), F.lit(True).alias("is_left"))
    right = sided.select("list", "deal", "node", "root", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("i"), place(F.col("rights")).alias("j"), F.lit(False).alias("is_left"))
    return left.union(right).select(F.xxhash64("deal", "i", "j").alias("share"), F.xxhash64("list", "i", "j").alias("unit"), "node", "root", "is_left")


class Block:
    """The nodes and sides of a block: `known` has sizes and sketches, `root` each node's component."""

    def __init__(self, held: pa.Table, sides: pa.Table, percent: int):
        nodes = held.column("node").to_numpy()
        self.by_node, self.percent = np.argsort(nodes), percent
        self.nodes = nodes[self.by_node]
        self.known = Sketched(held.column("size").to_numpy()[self.by_node], held.column("sketch").take(pa.array(self.by_node)).to_pylist())
        share, self.unit, node, root = (sides.column(c).to_numpy() for c in ("share", "unit", "node", "root"))
        self.is_left, self.at = np.asarray(sides.column("is_left")), np.searchsorted(self.nodes, node)
        self.root = self.nodes.copy()
        self.root[self.at] = root
        self.order = np.lexsort((self.unit, share))
        self.shares = slices(share[self.order])

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Left and right nodes (as places) of the pairs that meet in a unit, are in different components and may link, and what separates them at least.

        A pair comes once a share, however many of its units it meets in: a share's units are laid over each other in a table of
        left by right nodes, some rows at a time.
        """
        for lo, hi in self.shares:
            rows = self.order[lo:hi]
            left, right = (np.unique(self.at[rows[self.is_left[rows] == side]]) for side in (True, False))
            units = [(at[self.is_left[at]], at[~self.is_left[at]]) for at in (rows[a:z] for a, z in slices(self.unit[rows]))]
            places = [(np.searchsorted(left, self.at[x]), np.searchsorted(right, self.at[y])) for x, y in units if len(x) and len(y)]
            step = max(1, CELLS // max(1, len(right)))
            for first in range(0, len(left), step):
                some = left[first : first + step]
                meet = np.zeros((len(some), len(right)), bool)
                for x, y in places:
                    x = x[(x >= first) & (x < first + step)] - first
                    if len(x):
                        meet[np.ix_(x, y)] = True
                meet &= self.root[some][:, None] != self.root[right]
                p, q = np.nonzero(meet)
                for cut in range(0, len(p), PAIRS):
                    x, y = some[p[cut : cut + PAIRS]], right[q[cut : cut + PAIRS]]
                    apart_now = self.root[x] != self.root[y]
                    x, y = x[apart_now], y[apart_now]
                    may, apart = self.known.may_link(x, y, self.percent)
                    yield x[may], y[may], apart[may]


def _in_blocks(sides: DataFrame, profiles: DataFrame, blocks: int, columns: tuple[str, ...], work: Callable, schema: str) -> DataFrame:
    """work(what profiles have of a block's nodes, its sides) for each block of shares."""
    sides = sides.withColumn("block", F.pmod("share", F.lit(blocks)).cast("int"))
    wanted = sides.select(F.col("block").alias("held_in"), F.col("node").alias("wanted")).distinct()
    held = wanted.join(profiles, F.col("wanted") == profiles.node).select("held_in", profiles.node, *columns)
    return held.groupBy("held_in").cogroup(sides.groupBy("block")).applyInArrow(work, schema)


def _nearest(sides: DataFrame, profiles: DataFrame, percent: int, most: int, blocks: int) -> DataFrame:
    """Pairs (a, b), a < b, of members of one list whose components differ and whose sizes and sketches do not rule out a link.

    A left member names the `most` nearest of those it is held against in one go. Rows (a, null): a member that has such
    pairs; more: the block has such pairs that it does not name.
    """

    def name(held: pa.Table, sides: pa.Table) -> pa.Table:
        block = Block(held, sides, percent)
        found, seen, more = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)], False
        for p, q, apart in block.candidates():
            seen.append(np.unique(np.concatenate((p, q))))
            by = np.lexsort((q, apart, p))
            p, q = p[by], q[by]
            first = runs(p)
            rank = np.arange(len(p)) - np.repeat(first, np.diff(np.r_[first, len(p)]))
            found.append(np.unique(np.sort(np.column_stack((p, q))[rank < most], axis=1), axis=0))
            more |= bool((rank >= most).any())
        pairs, seen = np.unique(np.concatenate(found), axis=0), np.unique(np.concatenate(seen))
        a = np.concatenate((block.nodes[pairs[:, 0]], block.nodes[seen]))
        b = pa.concat_arrays([pa.array(block.nodes[pairs[:, 1]], pa.int64()), pa.nulls(len(seen), pa.int64())])
        return pa.table({"a": pa.array(a, pa.int64()), "b": b, "more": pa.array(np.full(len(a), more), pa.bool_())})

    return _in_blocks(sides, profiles, 4 * blocks, ("size", "sketch"), name, "a long, b long, more boolean")


def _settled(sides: DataFrame, profiles: DataFrame, percent: int, blocks: int) -> DataFrame:
    """Links (a, b) that join the components of each share's sides: every pair that may link is compared, until a link has joined its components."""

    def settle(held: pa.Table, sides: pa.Table) -> pa.Table:
        block = Block(held, sides, percent)
        sets = [from_planes(g) for g in held.column("grams").take(pa.array(block.by_node)).to_pylist()]
        size = block.known.size
        end = np.cumsum(size)
        gram = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)[1]
        del sets
        marked = np.zeros(len(gram) + 1, bool)
        joined = _Components(block.root)
        links = [[], []]
        for p, q, _ in block.candidates():
            for a, z in slices(p):
                x, y = int(p[a]), q[a:z]
                y = y[block.root[y] != block.root[x]]
                if not len(y):
                    continue
                own = gram[end[x] - size[x] : end[x]]
                marked[own] = True
                met = np.concatenate([marked[gram[end[i] - size[i] : end[i]]] for i in y.tolist()])
                marked[own] = False
                common = np.add.reduceat(met, np.r_[0, np.cumsum(size[y])[:-1]], dtype=np.int64)
                for i in y[100 * common >= percent * (size[x] + size[y] - common)].tolist():
                    if joined.join(x, i):
                        links[0].append(block.nodes[x])
                        links[1].append(block.nodes[i])
        return _pairs(*(np.array(side, np.int64) for side in links))

    return _in_blocks(sides, profiles, 4 * blocks, ("size", "sketch", "grams"), settle, "a long, b long")


class _Components:
    """Joins components, keeping `root`, an array of one number a node, up to date."""

    def __init__(self, root: np.ndarray):
        self.root = root
        by_root = np.argsort(root, kind="stable")
        self.members = {int(root[by_root[a]]): [by_root[a:z]] for a, z in slices(root[by_root])}

    def join(self, x: int, y: int) -> bool:
        a, b = int(self.root[x]), int(self.root[y])
        if a == b:
            return False
        if sum(map(len, self.members[a])) > sum(map(len, self.members[b])):
            a, b = b, a
        for part in self.members[a]:
            self.root[part] = b
        self.members[b] += self.members.pop(a)
        return True


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, that with the least doc_id (ties: of the text with the least hash), with all its columns.

    A row without an id stays only where no row of its group has one; rows without words link with nothing and all stay; of
    rows that repeat the one that stays, one stays; a null text has no words; an empty table gives no rows; extra columns may
    have any names.
    """
    joined = _joined(docs, n, percent)
    keepers = joined.scratch.stage(joined.keepers(), "keepers")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_text"), wordless.alias("wordless"))
    kept = rows.join(keepers, rows.own_id.eqNullSafe(keepers.doc_id) & (rows.own_text == keepers.text_hash) & ~rows.wordless, "left").where("wordless OR n IS NOT NULL")
    if keepers.where("n > 1").isEmpty():
        return kept.select("row.*")
    once, repeated = kept.where("wordless OR n = 1"), kept.where("NOT wordless AND n > 1").dropDuplicates(["own_id", "own_text"])
    return once.select("row.*").union(repeated.select("row.*"))
