"""The training-data operators against brute force, round trips and held-out accuracy, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import chat_format, decontamination, exact_dedup, ngram_join, packing, quality, secrets, substring_dedup, toxicity, warc
from tickloom.llm.common import Scratch, mixed, rolling_hashes
from tickloom.llm.components import components

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, block int, part int, key string, kept boolean, path string"  # with names the operators use inside


def table(spark, rows, schema=DOCS):
    return spark.createDataFrame([(i, t, 1, 2, "k", True, "p") for i, t in rows], schema)


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    long = " ".join(words(12_000, 1))
    base = words(60, 2)
    return [(1, None), (2, ""), (3, " \t\r\n\x0b\f"), (None, "null id " * 5), (4, long), (5, long), (6, "a b"), (6, "a b"), (7, " ".join(base)), (8, " ".join(base[30:] + base[:30])), (9, " ".join(base) + " x"), (10, "é 漢字 \U0001f600 ok")]


# 1 packing


def test_packing_holds_every_id_once(spark, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    for capacity in (64, 4096):
        got = packing.pack(table(spark, odd_rows), VOCABULARY, capacity).toPandas()
        expected = {}
        for doc_id, text in odd_rows:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
            expected.setdefault(doc_id, []).append(ids)
        for doc_id, kinds in expected.items():
            own = got[got.doc_id.isna() if doc_id is None else got.doc_id == doc_id]
            assert len({tuple(k) for k in kinds}) == 1  # repeated rows only
            ids = kinds[0]
            assert own.length.sum() == len(kinds) * len(ids) and set(own.doc_tokens) == {len(ids)}
            for p in own.itertuples():
                assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
        for _, window in got.groupby("sequence_id"):
            window = window.sort_values("offset")
            assert window.offset.tolist() == [0, *window.length.cumsum().tolist()[:-1]] and window.length.sum() <= capacity


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    window, offset, filled = packing.best_fit_decreasing(np.array(lengths), 50)
    room = []
    for n, w in zip(lengths, window, strict=True):  # plain best fit
        fits = [r for r in room if r >= n]
        best = min(fits) if fits else 50
        if not fits:
            room.append(50)
        room[room.index(best)] -= n
    assert sorted(50 - f for f in filled) == sorted(room)


def ids_of(encoder, texts):
    ids, bounds = encoder.encode(pa.array(texts))
    return [ids[a:z].tolist() for a, z in zip(bounds, bounds[1:], strict=False)]


def test_repacking_bounds_the_padding_of_many_splits(spark):
    """Windows are as few as one best-fit run over all pieces needs, up to a few a group, however the rows are split."""
    rng = random.Random(31)
    rows = [(i, " ".join(words(rng.choice((3, 20, 200, 900)), i))) for i in range(300)]
    one, many = (packing.pack(table(spark, rows).repartition(n), VOCABULARY, 1024).toPandas() for n in (1, 60))
    windows = [p.groupby("sequence_id").agg(total=("length", "sum"), padded=("padded_length", "max")) for p in (one, many)]
    for w in windows:
        power = w.total & (w.total - 1) == 0
        assert (w.total <= 1024).all() and (w.padded[power] == w.total[power]).all() and (w.padded[~power] == 1024).all()
        assert w.padded.sum() <= 1.1 * w.total.sum()
    assert windows[0].total.sum() == windows[1].total.sum() and len(windows[1]) <= len(windows[0]) + 4


def test_odd_words_are_encoded_as_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), packing.Encoder(VOCABULARY)
    rng = random.Random(32)
    letters = "abzAZ09'.,-_\"<|>éÉßİıǅʰªΣς漢ก\u0301\u0307\u200d\u00a0\x85\x1c\x00٣Ⅷ①😀"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(40)) for _ in range(300)]
    texts += ["", " ", "don't we'LL 's 'll'd x'sy", "<|endoftext|>a b<|startoftext|>", "a" * 300, "9" * 50]
    for text, ids in zip(texts, ids_of(encoder, texts), strict=True):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_encoded_as_whole_texts(spark):
    from tokenizers import Tokenizer

    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + ["<|endoftext|> a's Σ ΑΣ ΑΣ. \x85 x́ ́y I'LL ﬁ z", "\x1c a \xa0b"]
    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), packing.Encoder(VOCABULARY)
    for text, ids in zip(texts, ids_of(encoder, texts), strict=True):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_capitals_with_combining_marks_are_encoded_as_whole_texts(spark):
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), packing.Encoder(VOCABULARY)
    texts = ["H\u0331amza J\u030cim", "h\u0331amza j\u030cim", "T\u0308a W\u030aa Y\u030aa hamza HAMZA", "\u00c9COLE E\u0301COLE \u0130stanbul I\u0307 \u03a3\u0391\u03a3"]
    for text, ids in zip(texts, ids_of(encoder, texts), strict=True):
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


# 2 n-gram join


def plain_components(rows, n, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    return sorted(((d, len(s), min((x for x in ids[find(i)] if x is not None), default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_is_exact(spark, odd_rows, n, percent):
    rng = random.Random(5)
    rows = list(odd_rows)
    for group in range(6):
        base = words(rng.choice((5, 12, 40, 150, 400)), 50 + group)
        for k in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(("new", "other", "NEW"))
            rows.append((100 * group + k + 100, " ".join(copy)))
    rng.shuffle(rows)
    got = ngram_join.join_groups(table(spark, rows), n, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows, n, percent)


def test_ngram_join_of_large_groups_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIECE", 7)
    base = words(40, 9)
    rng = random.Random(9)
    rows = [(i, " ".join(w if rng.random() > 0.06 else "x%d" % rng.randrange(9) for w in base)) for i in range(60)]
    got = ngram_join.join_groups(table(spark, rows), 3, 70).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows, 3, 70)


def test_signatures_of_linked_sets_meet():
    rng = random.Random(2)
    for size in (10, 19, 40, 111, 800):
        base = words(size + 4, size)
        most = 2 * size // 19 // 2
        other = base[: size + 4 - most]
        sets = ngram_join.Sets([" ".join(base).encode(), " ".join(other).encode()], 3)
        a, b = (set(r.tolist()) for r in sets.rows)
        if 100 * len(a & b) >= 90 * len(a | b):
            owner, signature = sets.signatures(90)
            assert set(signature[owner == 0].tolist()) & set(signature[owner == 1].tolist())
    assert rng


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 130)} == {100}


# 3 toxicity, 9 quality


def auc(rows, label):
    ones, zeros = [r.score for r in rows if label[r.doc_id] == 1], [r.score for r in rows if label[r.doc_id] == 0]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize(("score", "name", "folds", "out", "least"), [(quality.score_quality, "quality", 3, 1, 0.95), (toxicity.score_toxicity, "toxic", 4, 2, 0.8)])
def test_scores_on_the_held_out_fold(spark, score, name, folds, out, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).collect()
    label = {r.doc_id: r[name] for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) for r in rows)
    assert auc([r for r in rows if r.held_out and r.doc_id in label], label) >= least


@pytest.mark.parametrize(("score", "name"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_scores_of_odd_rows(spark, odd_rows, score, name):
    docs = table(spark, odd_rows)
    none = spark.createDataFrame([], f"doc_id long, {name} int")
    one = spark.createDataFrame([(i, 1) for i in range(1, 11)] + [(None, 0), (3, None)], f"doc_id long, {name} int")
    for labels in (none, one):
        rows = score(docs, labels).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert score(docs.limit(0), none).count() == 0


def test_linear_time_score_equals_the_pairwise_sum():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=quality.BUCKETS + 3), rng.normal(size=(quality.BUCKETS + 3, 4)), np.zeros(3), np.ones(3))
    bucket, start, dense = np.array([5, 9, 77], np.uint16), np.array([0, 3]), rng.normal(size=(1, 3))
    x = np.r_[np.full(3, 3**-0.5), dense[0]]
    index = np.r_[bucket.astype(int), quality.BUCKETS + np.arange(3)]
    expected = 0.3 + x @ m.linear[index] + sum(m.factors[index[i]] @ m.factors[index[j]] * x[i] * x[j] for i in range(6) for j in range(i))
    assert np.allclose(m.forward(start, bucket, dense)[0], expected)


# 4 secrets


def test_secret_spans(spark, odd_rows):
    rng = random.Random(4)
    token = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(40))
    uuid, digest = "123e4567-e89b-12d3-a456-426614174000", hashlib.sha256(b"x").hexdigest().upper()
    text = f"é PASSWORD = 'hunter22' secret=short? password = token:abcdefg AKIA{'Z' * 16} AKIA12 {'0af' * 9} {token} {uuid} {digest} internationalization/of/the/documentation"
    rows = [*odd_rows, (50, text)]
    got = secrets.find_secrets(table(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}[50]
    values = [(s.kind, s.value) for s in found.secrets]
    assert values == [("assign", "PASSWORD = 'hunter22"), ("access", "AKIA" + "Z" * 16), ("hex", "0af" * 9), ("token", token)]
    assert (found.n_assign, found.n_access, found.n_hex) == (1, 1, 1)
    base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found.secrets if s.kind != "token")
    assert found.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and all(text[s.start : s.end] == s.value for s in found.secrets)


def test_secrets_in_paths_and_beside_base_spans(spark):
    rng = random.Random(44)
    alphabet = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"
    token = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    slashed = "/".join(token(21) for _ in range(4))
    hidden, second, alone, path = token(40), token(40), token(40), "internationalization/of/the/documentation/and/administration/guides"
    access = "AKIA" + "Z" * 16
    rows = [(1, f"x {slashed} y"), (2, f"see {path}/{hidden}/{path}"), (3, f"{access}/{second}"), (4, f"hooks.example.com/services/T012AB3CD/B045EF6GH/{alone}"), (5, f"{path} sha256-{'aB3/' * 10}a1B="), (6, f"documentation/internationalization/administration {token(10)}/{token(8)}")]
    got = {r.doc_id: [(s.kind, s.value) for s in r.secrets] for r in secrets.find_secrets(table(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    assert got[1] == [("token", slashed)] and got[2] == [("token", hidden)] and got[5] == []
    assert [k for k, _ in got[3]] == ["access", "token"] and got[3][0][1] == access and got[3][1][1].strip("/") == second
    assert len(got[4]) == 1 and got[4][0][1].endswith(alone)


# 5 WARC


def test_warc_round_trip(spark):
    rows = [(3, "http://b/ü?a%20b", "same"), (2, None, "same"), (1, "x", None), (4, "x", ""), (5, "y", "z" * 100_000), (None, "n", "same"), (6, "crlf\r\n: x", "a\r\n\r\nWARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(i, u, h, "k", "p") for i, u, h in rows], "page_id long, url string, html string, key string, path string")
    got = warc.read_archives(warc.write_archives(pages, archive_bytes=300)).collect()
    assert {r.kind for r in got} == {"record"} and len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, url, html in rows:
        data, r = (html or "").encode(), by[i]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), warc.base32_sha1(data), (url or "").strip())
        first = min(j for j, _, h in rows if j is not None and (h or "") == (html or ""))
        assert (r.record_type, r.refers_to) == (("response", None) if i == first else ("revisit", first))
        assert bytes(r.payload) == data if i == first else r.payload is None
    kept = warc.read_archives(warc.write_archives(pages, min_payload=5)).where("record_type = 'response'").count()
    assert kept == len(rows)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_salvage_skips_damage_and_logs_gaps(tmp_path):
    def member(data):
        packer = zlib.compressobj(6, wbits=31)
        return packer.compress(data) + packer.flush()

    records = [warc._record(i, "u", b"payload %d" % i * 50, None, "2026-01-01T00:00:00Z") for i in range(6)]
    parts = [member(records[0]), member(records[1])[:-20], b"junk WARC/1.0 \x1f\x8b\x08 junk", member(records[2]), records[3], records[4].replace(b"payload 4", b"Payload 4"), member(records[5]), b"\x1f\x8b"]

    class File:
        def __init__(self, data):
            self.data, self.at = data, 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            self.at += n
            return self.data[self.at - n : self.at]

    data = b"".join(parts)
    rows = list(warc.salvage(warc.Source(File(data), len(data))))
    assert [r["page_id"] for r in rows if r["kind"] == "record"] == [0, 2, 3, 5]
    offsets = np.cumsum([0, *map(len, parts)]).tolist()
    assert [(r["offset"], r["offset"] + r["length"]) for r in rows if r["kind"] == "gap"] == [(offsets[1], offsets[3]), (offsets[5], offsets[6]), (offsets[7], offsets[8])]
    assert sum(r["length"] for r in rows) == len(data)


# 6 exact dedup


def plain_dedup(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        _, no_id, keep = min(own := groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")])
        out.append((doc_id, None if no_id else keep, len(own)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [256, 2])
def test_exact_dedup_with_many_batches_and_weak_digests(spark, tmp_path, odd_rows, bits):
    rows = [*odd_rows, (20, "a b"), (21, "a  b"), (22, "ab"), (23, "a\nb "), (24, "A b")]
    table(spark, rows).repartition(5).write.parquet(str(tmp_path / "docs"))
    digest = exact_dedup.sha256_digest if bits == 256 else lambda t: F.substring(exact_dedup.sha256_digest(t), 1, 1)
    got = exact_dedup.exact_dedup(spark, str(tmp_path / "docs"), digest=digest, files_per_batch=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == plain_dedup(rows)
    texts = {re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows}
    assert sum(r.kept for r in got) == len(texts)


def test_exact_dedup_keeps_columns_and_takes_empty_tables(spark, odd_rows):
    docs = table(spark, odd_rows)
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len({re.sub(r"\s", "", t or "") for _, t in odd_rows})
    assert exact_dedup.kept_rows(docs.limit(0)).count() == 0


# 7 decontamination


def test_leaks(spark, odd_rows):
    item = words(30, 70)
    mixed_up = item[20:] + words(9, 71) + item[10:20] + ["x"] + item[:10]
    rows = [*odd_rows, (60, "a " + " ".join(item).upper() + ", b"), (61, " ".join(words(5000, 72) + mixed_up + words(50, 73))), (62, " ".join(item[:12] + words(40, 74))), (None, " ".join(item))]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "only four words here"), (3, None), (4, " ".join(words(20, 75))), (None, "")], "item_id long, text string")
    for most in (2_000_000, 0):  # in each task, and by a shuffle
        got = decontamination.find_leaks(table(spark, rows), benchmark, broadcast_tokens=most).collect()
        found = {(r.doc_id, r.item_id): r for r in got}
        assert set(found) == {(60, 1), (61, 1), (None, 1)}
        assert (found[61, 1].n_tiles, found[61, 1].matched_tokens, found[61, 1].coverage) == (3, 30, 1.0)
    docs = table(spark, rows)
    clean = decontamination.drop_leaking(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(rows) - 3
    assert decontamination.find_leaks(docs.limit(0), benchmark).count() == decontamination.find_leaks(docs, benchmark.limit(0)).count() == 0


def plain_tiles(text, item, least):
    """Plain greedy string tiling: the longest free match each time, ties by place in the item, then in the text."""
    free_t, free_i, plain = [True] * len(text), [True] * len(item), []
    while True:
        best, ahead = (0, 0, 0), {}
        for i in range(len(text) - 1, -1, -1):
            row = {}
            if free_t[i]:
                for j in range(len(item)):
                    if free_i[j] and text[i] == item[j]:
                        row[j] = k = ahead.get(j + 1, 0) + 1
                        best = max(best, (k, -j, -i))
            ahead = row
        if best[0] < least:
            return plain
        k, j, i = best[0], -best[1], -best[2]
        free_t[i : i + k], free_i[j : j + k] = [False] * k, [False] * k
        plain.append((i, j, k))


def test_tiles_are_the_greedy_ones():
    rng = random.Random(8)
    for _ in range(4000):
        letters = rng.choice((2, 3, 6))
        text, item = ([rng.randrange(1, letters + 1) for _ in range(n)] for n in (rng.randint(0, 40), rng.randint(1, 20)))
        least = rng.randint(1, 4)
        assert decontamination.tile(np.array(text, np.uint64), np.array(item, np.uint64), least) == plain_tiles(text, item, least)


def test_rolling_hashes_depend_on_the_run_alone():
    rng = np.random.default_rng(5)
    side = rng.integers(0, 3, 400).astype(np.uint64)
    for k in (1, 2, 5, 13):
        h, seen = rolling_hashes(side, k), {}
        assert len(h) == 400 - k + 1
        for i, x in enumerate(h.tolist()):
            seen.setdefault(tuple(side[i : i + k].tolist()), set()).add(x)
        assert all(len(x) == 1 for x in seen.values()) and len({x for s in seen.values() for x in s}) == len(seen)
    assert len(rolling_hashes(side[:3], 4)) == 0


def test_frequent_seeds_cost_no_leak(spark):
    """A phrase that every document has is one of the item's seeds, and may be the one that an item's leaks do without."""
    rng = random.Random(81)
    common, item = words(8, 82), words(22, 83)
    items = [(1, " ".join(common + item)), (2, " ".join(common)), (3, " ".join(item[:9] + common)), (None, " ".join(common + item))]
    docs = [(i, " ".join(words(10, 90 + i) + common + words(5, 190 + i) + item[: rng.randrange(22)] + words(5, 300 + i) + item[rng.randrange(22) :])) for i in range(40)]
    benchmark = table(spark, items).withColumnRenamed("doc_id", "item_id")
    near, far = (sorted(map(tuple, decontamination.find_leaks(table(spark, docs), benchmark, broadcast_tokens=most).collect()), key=str) for most in (10**6, -1))
    assert near == far and {r[1] for r in near} == {1, 2, 3, None}


# 8 substring dedup


def plain_repeats(rows):
    first = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = {k for i in range(len(w) - 12) if doc_id is not None and first[tuple(w[i : i + 13])] < doc_id for k in range(i, i + 13)}
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_substring_dedup_is_exact(spark, odd_rows):
    rng = random.Random(6)
    shared = [words(n, 80 + n) for n in (12, 13, 14, 20, 60)]
    rows = [*odd_rows, (None, " ".join(shared[4]))]
    for i in range(80):
        rows.append((rng.randrange(200, 260), " ".join(x for _ in range(4) for x in (words(rng.randint(0, 25), i * 7 + _) + rng.choice(shared)))))
    rows += [(300 + i, "x y " * 40) for i in range(5)]
    for blocks in (1, 7):
        got = substring_dedup.remove_repeats(table(spark, rows), doc_blocks=blocks, hash_blocks=3).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == plain_repeats(rows)
        assert all(r.kept_sha256 == hashlib.sha256(r.kept_text.encode()).hexdigest() for r in got)
    assert substring_dedup.remove_repeats(table(spark, [])).count() == 0


def test_the_cover_aligns_any_two_positions():
    for p in range(substring_dedup.PERIOD):
        for q in range(substring_dedup.PERIOD):
            assert any((p + s) % 7 in substring_dedup.COVER and (q + s) % 7 in substring_dedup.COVER for s in range(7))


# 10 chat formatting


def test_chat_round_trip(spark):
    texts = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<|user|>", "a|>b<|", "</\\s>", "[INST\\]", "é\n\U0001f600", "<\\|x", "||>>", "<|>"]
    rows = [(i, k, role, t) for i, role in enumerate(("user", "assistant", "", None, "we|>ird\n<|")) for k, t in enumerate(texts)]
    rng = random.Random(1)
    shuffled = rng.sample(rows, len(rows))
    messages = spark.createDataFrame([(*r, "x", "y") for r in shuffled], "conv_id long, turn long, role string, text string, parts string, formatted string")
    formatted = chat_format.format_conversations(messages)
    back = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    for r in formatted.collect():
        own = [(role or "", t or "") for i, _, role, t in rows if i == r.conv_id]
        assert [(t.role, t.text) for t in back[r.conv_id].turns] == own
        assert back[r.conv_id].loss_text == "".join(t for role, t in own if role == "assistant")
        assert not re.search(r"\[/?INST\]|</?s>", r.formatted[3:-4].replace("</s><|", "<|")) or r.conv_id == 4


def test_chat_parts_become_placeholders(spark):
    part = lambda kind, text=None, ref=None, size=None: (kind, text, ref, size)
    rows = [
        (1, 0, "user", [part("text", "see "), part("image", ref="a.png", size=576.0), part("text", " and <s>"), part("audio", ref="b.wav", size=2.5)]),
        (1, 1, "assistant", [part("text", "ok"), part("document", ref="c.pdf", size=2.0), part("video", ref="d")]),
        (2, 0, "user", []),
        (None, 0, "user", None),
    ]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content {chat_format.PARTS}")
    got = {r.conv_id: r for r in chat_format.format_conversations(messages, content=F.col("content")).collect()}
    assert got[1].formatted == "<s><|user|>see <|image:1|> and <\\s><|audio:2|></s><|assistant|>ok<|document:3|><|video:4|></s>"
    assert [(a.number, a.type, a.ref, a.tokens) for a in got[1].attachments] == [(1, "image", "a.png", 576), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 2048), (4, "video", "d", 1)]
    span = got[1].loss_spans[0]
    assert got[1].formatted[span.start : span.start + span.length] == "ok<|document:3|><|video:4|>"
    assert got[2].formatted == got[None].formatted == "<s><|user|></s>"
    assert chat_format.format_conversations(messages.limit(0), content=F.col("content")).count() == 0


def test_both_ways_of_decontamination_agree(spark):
    """Null and shared ids, words of punctuation only, and repeated rows."""
    passage = words(20, 61)
    items = [(1, "a - b c d"), (None, " ".join(passage)), (None, " ".join(words(12, 62))), (3, "- -- ..."), (4, None), (1, "a - b c d")]
    docs = [(1, "x A b, c d y"), (None, "z " + " ".join(passage)), (None, "a clean text without anything"), (2, "clean"), (2, "q " + " ".join(passage)), (7, None), (None, "a b c"), (8, "x A b, c d y"), (8, "x A b, c d y")]
    benchmark = table(spark, items).withColumnRenamed("doc_id", "item_id")
    frame = table(spark, docs)
    near, far = (sorted(map(tuple, decontamination.find_leaks(frame, benchmark, broadcast_tokens=most).collect()), key=str) for most in (10**6, -1))
    assert near == far and len(near) == 8 and {r[1] for r in near} == {1, None} and {r[0] for r in near} == {None, 1, 2, 8}
    kept = [sorted(((r.doc_id, r.text) for r in decontamination.drop_leaking(frame, benchmark, broadcast_tokens=most).collect()), key=str) for most in (10**6, -1)]
    assert kept[0] == kept[1] == sorted([docs[2], docs[3], docs[5], docs[6]], key=str)


# every operator on next to nothing, and on columns with the names that operators use inside


NEXT_TO_NOTHING = {
    "none": [],
    "empty": [(1, ""), (2, None), (None, " "), (None, None)],
    "short": [(1, "a"), (2, "b c")],
    "one": [(5, "one two three")],
    "unrelated": [(1, " ".join(words(60, 401))), (2, " ".join(words(80, 402))), (3, None), (None, " ".join(words(30, 403)))],
}


@pytest.mark.parametrize("name", NEXT_TO_NOTHING)
def test_operators_on_next_to_nothing(spark, name):
    rows = NEXT_TO_NOTHING[name]
    docs = table(spark, rows).repartition(3)
    items = spark.createDataFrame([(1, "a text of the benchmark that no document has")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    same = lambda got: sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert sorted((tuple(r) for r in ngram_join.join_groups(docs, 3, 90).collect()), key=str) == plain_components(rows, 3, 90)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs).collect()), key=str) == plain_repeats(rows)
    assert packing.pack(docs, VOCABULARY).count() == len(rows)
    assert secrets.find_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == len(rows)
    assert same(quality.keep_good(docs, labels, threshold=0.0)) == sorted(rows, key=str)
    for most in (10**6, -1):
        assert decontamination.find_leaks(docs, items, broadcast_tokens=most).count() == 0
        assert same(decontamination.drop_leaking(docs, items, broadcast_tokens=most)) == sorted(rows, key=str)


def test_keeping_rows_with_clashing_names_and_repeats(spark):
    base = words(50, 410)
    rows = [(3, " ".join(base)), (3, " ".join(base)), (2, " ".join([*base, "x"])), (None, " ".join([*base, "y"])), (None, " ".join(words(9, 411))), (None, " ".join(words(9, 411))), (4, ""), (4, ""), (None, None), (5, " ".join(words(40, 412)))]
    names = ("stays", "leaking", "row", "own_id", "own_text", "own_key", "doc_key", "text_hash", "n", "wordless", "at_file", "at_row", "file_path", "row_index", "_at_file")
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    items = spark.createDataFrame([(1, " ".join(words(40, 412)))], "item_id long, text string")
    same = lambda got: sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns and same(kept) == sorted([rows[2], rows[4], rows[6], rows[7], rows[8], rows[9]], key=str)
    once = exact_dedup.kept_rows(docs)
    assert once.columns == docs.columns and len(same(once)) == 6
    for most in (10**6, -1):
        clean = decontamination.drop_leaking(docs, items, broadcast_tokens=most)
        assert clean.columns == docs.columns and same(clean) == sorted(rows[:-1], key=str)
    good = quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int"), threshold=0.0)
    assert good.columns == docs.columns and same(good) == sorted(rows, key=str)


# 2 once more: signatures that many documents share, and sets that share a key


def test_hot_signatures_are_dealt_out(spark, monkeypatch):
    rng = random.Random(12)
    common, base = words(60, 420), words(40, 421)
    rows = [(i, " ".join(w if rng.random() > 0.05 else "x%d" % rng.randrange(9) for w in base)) for i in range(70)]
    rows += [(100 + i, " ".join(common + words(20, 500 + i))) for i in range(60)] + [(200 + i, " ".join(common + words(20, 500 + i) + ["z"])) for i in range(9)]
    rng.shuffle(rows)
    monkeypatch.setattr(ngram_join, "PIECE", 11)
    monkeypatch.setattr(ngram_join, "HOT", 4)
    got = ngram_join.join_groups(table(spark, rows).repartition(3), 3, 80).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows, 3, 80)


def test_sets_that_share_a_key_are_told_apart(spark, tmp_path):
    docs = spark.createDataFrame([(1, 11, 7, 70, 5, b"s"), (2, 12, 7, 71, 5, b"s"), (3, 13, 8, 80, 5, b"s"), (4, 14, 7, 70, 5, b"s")], "doc_id long, text_hash long, key long, check long, n_shingles long, sketch binary")
    lists = spark.createDataFrame([("l", 7, [7, 8])], "list string, center long, members array<long>")
    scratch = Scratch(spark, "test")
    rows, found = ngram_join._resolved(docs, lists, scratch)
    node = {r.doc_id: r.node for r in rows.collect()}
    assert node[1] == node[4] == 7 and node[2] not in (7, 8) and node[3] == 8
    got = {r.list: set(r.members) for r in found.collect()}
    assert got == {"l": {7, 8, node[2]}, "key 7": {7, node[2]}}


def test_word_hashes_of_many_and_long_words(monkeypatch):
    from tickloom.llm import common

    monkeypatch.setattr(common, "WORD_TABLE_ENTRIES", 9_000)
    table_, rng = common.WordTable(), random.Random(1)
    for n in (5000, 3, 20_000, 10):
        ws = [b"%d" % rng.randrange(10**6) + b"x" * (70 * (rng.random() < 0.01)) for _ in range(n)]
        assert table_.of(ws).tolist() == [list(common._halves(w)) for w in ws]
    assert table_.of([]).shape == (0, 2)


# 3 and 9: features against plain versions


def test_toxicity_features_equal_plain_ones():
    lexicon = {"grok": 3.0, "grok*": 2.5, "blarg*": 2.2, "sni*": 9.0, "moron": 4.5}
    rng = random.Random(33)
    vocabulary = ["you", "Grok!", "groks", "blarging", "MORON", "idiot,", "clean", "wa11ow", "sooooo", "w.o", "42", "(tu)", "é", "fine.", "n0pe"]
    punctuation = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    for _ in range(200):
        text = rng.choice((" ", "\n")).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))
        ws = text.split()
        bare = [w.strip(punctuation).lower() for w in ws]
        known = [[t for t in [b, *(b[:k] + "*" for k in (4, 5, 6, 7) if len(b) > k)] if t in lexicon] for b in bare]
        odds = [max([4.0 * (b in toxicity.INSULTS), *(lexicon[t] for t in k)], default=0.0) for b, k in zip(bare, known, strict=True)]
        odd = [bool(re.search(r"[^\W\d_]+[\d@$!*#%&+|]+[^\W\d_]+|(.)\1\1\1", w)) and not w.isalnum() for w in ws]
        people = [i for i, b in enumerate(bare) if b in toxicity.SECOND_PERSON]
        hits = [i for i, o in enumerate(odds) if o]
        near = sum(any(abs(i - p) <= toxicity.NEAR for p in people) for i in hits)
        n, data = max(len(ws), 1), text.encode()
        size = max(len(data), 1)
        expected = dict(
            fixed=1000 * sum(b in toxicity.INSULTS for b in bare) / n, words=1000 * sum(t[-1] != "*" for k in known for t in k) / n, stems=1000 * sum(t[-1] == "*" for k in known for t in k) / n, odds=1000 * sum(odds) / n, top=max(odds, default=0),
            near=1000 * near / n, any_near=float(near > 0), capitals=sum(65 <= c <= 90 for c in data) / size, capital_words=sum(w.isupper() for w in ws) / n, exclaim=text.count("!") / n,
            marks=sum(33 <= c < 127 and not chr(c).isalnum() for c in data) / size, digits=sum(48 <= c <= 57 for c in data) / size, obfuscated=1000 * sum(odd) / n, obfuscated_hits=1000 * sum(o and i in hits for i, o in enumerate(odd)) / n,
            length=np.log1p(len(ws)), hits=np.log1p(len(hits)), share_hit=len(hits) / n, long_stems=1000 * sum(t[-1] == "*" and len(t) > 6 for k in known for t in k) / n,
        )
        got = dict(zip(toxicity.NAMES, toxicity.features(text, toxicity.Judged(lexicon)), strict=True))
        assert set(got) == set(expected) and all(np.isclose(got[k], expected[k]) for k in got), (text, got, expected)


def test_quality_inputs_equal_plain_ones():
    from tickloom.llm.common import _halves

    texts_ = [b"", None, b"A b  a\nB\nA b  a", "é 漢字 ok".encode(), b" \n\n ", b"x" * 500]
    start, bucket, stats = quality.inputs(texts_)
    lowered = [(t or b"").lower() for t in texts_]
    for i, t in enumerate(lowered):
        own = {int(mixed(np.array([_halves(w)[0]], np.uint64))[0]) % quality.BUCKETS for w in t.split()}
        assert sorted(own) == bucket[start[i] : start[i + 1]].tolist()
    for i, t in enumerate(t or b"" for t in texts_):
        ws, lines = t.split(), t.split(b"\n")
        n = max(len(ws), 1)
        upper, lower = (sum(a <= c <= z for c in t) / max(len(t), 1) for a, z in ((65, 90), (97, 122)))
        more = [np.log1p(len(t)), np.log1p(len(ws)), len(t) / n, len({w.lower() for w in ws}) / n, upper / max(upper + lower, 1e-6), len(set(lines)) / len(lines) if t else 0, np.log1p(n / len(lines)) if t else 0]
        assert np.allclose(stats[i, -7:], np.array(more) * bool(t), rtol=1e-5), (t, stats[i, -7:], more)


# 4 once more: an independent scan


WORD_LIKE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


def scanned(text):
    """Base spans by walking over the characters."""
    spans = []

    def value_end(at):
        end = at
        while end < len(text) and (text[end] in WORD_LIKE or text[end] in "+/_.=-"):
            end += 1
        return end

    def assignment(at):
        """(start of the value, its end), or None."""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[at : at + 8])
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not low.startswith(name):
                continue
            for quote in (1, 0):
                i = at + len(name)
                if quote and not (i < len(text) and text[i] in "\"'"):
                    continue
                i += quote
                while i < len(text) and text[i] == " ":
                    i += 1
                if not (i < len(text) and text[i] in ":="):
                    continue
                i += 1
                while i < len(text) and text[i] == " ":
                    i += 1
                for quoted in (1, 0):
                    if quoted and not (i < len(text) and text[i] in "\"'"):
                        continue
                    if value_end(i + quoted) > i + quoted:
                        return i + quoted, value_end(i + quoted)
        return None

    at = 0
    while at < len(text):
        if found := assignment(at):
            if found[1] - found[0] >= 6:
                spans.append((at, 0, found[1]))
            at = found[1]
        else:
            at += 1
    at = 0
    while at < len(text):
        end = at + 4
        if text[at:end] == "AKIA":
            while end < len(text) and text[end] in WORD_LIKE and not text[end].islower():
                end += 1
            if end > at + 4:
                if end - at >= 20:
                    spans.append((at, 1, end))
                at = end
                continue
        at += 1
    at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in "0123456789abcdef":
            end += 1
        if end - at >= 24:
            spans.append((at, 2, end))
        at = max(end, at + 1)
    return sorted(spans)


def test_secrets_against_a_plain_scan(spark):
    rng = random.Random(45)
    parts = ["password", "PassWD", "secret", "TOKEN", "api_key", "apikey", "API", "_key", "pass", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "ABCDEFGH01234567", "Z9", "x", "hunter2", "deadbeef", "0123456789abcdef" * 2, "0af", "é", "\n", "/", "-", "aB3/", "K7qPz2LmX9vRt4WsYb8NcD1f"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(600)] + [(1000, "password=" * 3000 + " " + "aB3/K7qPz2Lm" * 2000), (1001, "token=abcdef AKIA" + "A" * 20 + " ") , (1002, ("token=abcdef" + "0af" * 9 + " ") * 4000)]
    got = {r.doc_id: r for r in secrets.find_secrets(table(spark, rows), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    for doc_id, text in rows:
        base, r = scanned(text), got[doc_id]
        said = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), text
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3))
        spans = [(int(x.split(":")[1]), secrets.KINDS.index(x.split(":")[0]), int(x.split(":")[2])) for x in r.spans.split(",") if x]
        assert spans == sorted(spans) and set(base) <= set(spans)
        more = [(s, e) for s, k, e in spans if k == 3]
        covered = np.zeros(len(text) + 1, bool)
        for s, _, e in base:
            covered[s:e] = True
        assert all(e - s >= 20 and not covered[s:e].any() for s, e in more) and all(a[1] <= b[0] for a, b in zip(more, more[1:], strict=False))


# 10 once more: a long conversation


def test_long_conversations(spark):
    n = 3000
    messages = spark.range(n).selectExpr("CAST(1 AS BIGINT) conv_id", "id turn", "IF(id % 2 = 0, 'user', 'assistant') role", "concat('m<s>', id) text")
    formatted = chat_format.format_conversations(messages)
    back = chat_format.read_back(formatted).first()
    texts_ = [f"m<s>{i}" for i in range(n)]
    assert [t.text for t in back.turns] == texts_ and back.loss_text == "".join(texts_[1::2])
