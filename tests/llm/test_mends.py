"""Cases that once broke: control strings across parts, long words, texts of repeated words, and a column named _metadata."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import chat_format, decontamination, exact_dedup, toxicity


def test_control_strings_across_parts_are_read_back(spark):
    rng = random.Random(8)
    cuts = [(c[:i], c[i:]) for c in chat_format.CONTROL for i in range(1, len(c))]
    texts = [[("text", "a" + a), ("text", b + "b")] for a, b in cuts] + [[("text", a), ("text", ""), ("text", b)] for a, b in cuts] + [[("text", a), ("image", None), ("text", b)] for a, b in cuts]
    texts += [[("text", "".join(rng.choice(["<", "/", "s", ">", "|", "[", "INST", "]", "\\", "x", "\n"]) for _ in range(rng.randint(0, 5)))) for _ in range(rng.randint(1, 5))] for _ in range(200)]
    rows = [(i, t, role, [(kind, text, None, None) for kind, text in parts]) for i, parts in enumerate(texts) for t, role in ((0, "user"), (1, "assistant"))]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(messages, content=F.col("parts"))).collect()}
    for i, parts in enumerate(texts):
        if all(kind == "text" for kind, _ in parts):
            whole = "".join(text for _, text in parts)
            assert [(t.role, t.text) for t in got[i].turns] == [("user", whole), ("assistant", whole)], parts
        assert len(got[i].turns) == 2


def test_one_very_long_word_takes_time_in_proportion():
    word = "".join(chr(97 + i * 7 % 26) for i in range(1_000_000))
    began = time.time()
    assert not toxicity._OBFUSCATED.search(word + ".") and toxicity._OBFUSCATED.search(word + "@" + word) and toxicity._OBFUSCATED.search("$" * 100_000)
    assert time.time() - began < 20


def plain_tiles(text, item, least):
    """Greedy tiling by looking at all pairs of places, longest first, then by place in the item."""
    free, open_, tiles = [True] * len(text), [True] * len(item), set()
    while True:
        best = None
        for j in range(len(item)):
            for i in range(len(text)):
                n = 0
                while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and free[i + n] and open_[j + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = n, i, j
        if best is None:
            return sum(open_ is False for open_ in open_)
        n, i, j = best
        free[i : i + n], open_[j : j + n] = [False] * n, [False] * n


def test_tiles_of_few_different_tokens():
    rng = np.random.default_rng(3)
    for _ in range(300):
        text, item = (rng.integers(0, 3, n).astype(np.uint64) for n in (rng.integers(1, 40), rng.integers(1, 20)))
        tiles = decontamination.tile(text, item, 3)
        assert sum(n for *_, n in tiles) == plain_tiles(text.tolist(), item.tolist(), 3)
        assert all(np.array_equal(text[i : i + n], item[j : j + n]) for i, j, n in tiles)


def test_tiles_of_repeated_words_take_little():
    text, item = np.full(100_000, 7, np.uint64), np.full(500, 7, np.uint64)
    item[250] = 9
    began = time.time()
    assert sorted(n for *_, n in decontamination.tile(text, item, 13)) == [249, 250] and time.time() - began < 30


def test_a_column_named_metadata(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "ab", "y"), (3, "c", "z")], "doc_id long, text string, _metadata string")
    assert sorted(tuple(r) for r in exact_dedup.kept_rows(docs).collect()) == [(1, "a b", "x"), (3, "c", "z")]
    docs.write.parquet(f"{tmp_path}/docs")
    got = exact_dedup.exact_dedup(spark, f"{tmp_path}/docs").collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False), (3, 3, True)]
    assert corpus_pipeline.distinct_documents(spark, docs, "").columns == docs.columns
