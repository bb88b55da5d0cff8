"""op12: alignment of two tokenizers against whole texts through both, and its edge cases."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tickloom.llm import alignment

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, words binary, seg long, segment string, a int, number int"


def plain(texts):
    """What align returns but for doc_id, from whole texts and plain walks over byte offsets."""
    whole = Tokenizer.from_file(BYTES)
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    found, pairs = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        ids = whole.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        cells = [bytes(letters[c] for c in whole.id_to_token(i)) for i in ids[0]], [bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if any(b"".join(c) != (" " + text).encode() for c in cells):
            continue
        ends = []
        for side, cell in zip(ids, cells, strict=True):
            at, of_end = 0, {}
            for i, c in zip(side, cell, strict=True):
                at += len(c)
                of_end[at] = i
            ends.append(of_end)
        cuts, groups, links = sorted(ends[0].keys() & ends[1].keys()), [], []
        walks = [iter(e.items()) for e in ends]
        for cut in cuts:
            sides = []
            for walk in walks:
                side = []
                for end, i in walk:
                    side.append(str(i))
                    if end == cut:
                        break
                sides.append(side)
            groups.append(",".join(sides[0]) + "|" + ",".join(sides[1]))
            links.append((ends[0][cut], ends[1][cut]))
        pairs.update(links)
        found[-1] = len(ids[0]), len(ids[1]), links, hashlib.sha256(";".join(groups).encode()).hexdigest()
    highest = {}
    for (_, b), n in pairs.items():
        highest[b] = max(n, highest.get(b, 0))
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), len(f[2]), sum(pairs[x] == highest[x[1]] for x in f[2]), sum(pairs[x] for x in f[2]), f[3]) for f in found]


def odd_texts(n, seed):
    rng = random.Random(seed)
    some = ["the", "Cat", "'s", "don't", "naïve", "漢字", "\U0001f600", "<s>", "</s>", "<0x41>", "<|endoftext|>", "12345", "....", "é", "é", "　", "\n", "\t", "  ", " ", " ", "\x1c", "\x85", "x" * 40, "-", "▁", "﻿", "\r\n"]
    return ["".join(rng.choice(some) + rng.choice(["", " ", " ", "  ", "\n"]) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def rows_of(spark, texts):
    docs = spark.createDataFrame([(None if i == 3 else i, t, 1, b"w", 2, "s", 3, 4) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = alignment.align(docs, BYTES, PIECES, public_tokenizers.PATTERN).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r))


def test_alignment_equals_whole_texts(spark):
    texts = [None, "", " ", "a", "a b", "a b", "▁ marks", "plain words and more words, and words.", "x" * 30_000, "word " * 20_000, " lead", "trail ", *odd_texts(150, 4)]
    expected = sorted(((None if i == 3 else i, *row) for i, row in enumerate(plain(texts))), key=lambda r: (r[0] is None, r[0] or 0, r))
    assert rows_of(spark, texts) == expected
    assert sum(r[-1] == "" for r in expected) > 3 and sum(r[-1] != "" for r in expected) > 50  # both kinds are there


def test_alignment_of_small_blocks():
    """Blocks and strings of any size cut a text alike."""
    a, b = alignment._cutters(BYTES, PIECES, public_tokenizers.PATTERN)
    assert a.ends_at_blanks and b.ends_at_blanks
    for text in odd_texts(300, 9):
        numbers = alignment.Numbers()
        words = alignment._numbered(text, numbers, True)
        segments = list(numbers)
        assert " ".join(segments[i] for i in words) == text
        sizes = alignment.np.array([len(s.encode()) + 1 for s in segments])
        for cutter in (a, b):
            ids, start, count, fine = cutter.tokens(segments, sizes)
            joined = [i for w in words for i in ids[start[w] : start[w] + count[w]].tolist()]
            if fine[words].all():
                assert joined == list(cutter.encode(" " + text))
            else:
                assert b"".join(cutter.bytes[i] for i in cutter.encode(" " + text)) != (" " + text).encode()


def test_alignment_of_nothing(spark):
    assert rows_of(spark, []) == []
    assert [r[1:] for r in rows_of(spark, [None, ""])] == [(0, 0, 0, 0, 0, 0, "")] * 2
