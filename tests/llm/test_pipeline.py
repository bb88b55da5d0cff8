"""Every stage of the pipeline against a plain version, each on what its predecessor kept."""

import os
import re
import shutil
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import decontamination, quality
from tickloom.llm.common import staged

sys.path.insert(0, os.path.dirname(__file__))
from test_operators import plain_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def leaks_plainly(text, item, least):
    """Greedy tiling over plain lists: the longest free match each time, and the share of the item that is covered."""
    trim = lambda t: [w.decode().lower() for w in (x.strip(decontamination._TRIM) for x in t.encode().split()) if w]
    a, b = trim(text), trim(item)
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    places = {}
    for i in range(len(a) - 4):
        places.setdefault(tuple(a[i : i + 5]), []).append(i)
    while True:
        best = (0, 0, 0)
        for j in range(len(b) - 4):
            for i in places.get(tuple(b[j : j + 5]), []):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                best = max(best, (k, i, j))
        k, i, j = best
        if k < 5:
            return covered >= least * len(b)
        free_a[i : i + k], free_b[j : j + k], covered = [False] * k, [False] * k, covered + k


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    machine = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"))
    score = machine.score(*quality.inputs([t.encode() for _, t in rows]))
    good = [r for r, s in zip(rows, score, strict=True) if s >= 0.5]
    first = {}
    for doc_id, text in sorted(good, key=lambda r: (-len(r[1]), r[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), (doc_id, text))
    distinct = sorted(first.values())
    roots = {d: c for d, _, c in plain_components(distinct, 5, 80)}
    unlike = [r for r in distinct if roots[r[0]] == r[0]]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in unlike if not any(leaks_plainly(r[1], item, decontamination.COVERAGE) for item in items)]
    assert len(good) < len(rows) and len(clean) < len(unlike) < len(good)
    for (name, stage), expected in zip(corpus_pipeline.STAGES, (good, distinct, unlike, clean, None), strict=True):
        result = staged(stage(spark, docs, SF), name)
        if expected is None:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in clean}
            got = result.toPandas()
            assert got.groupby("doc_id").length.sum().to_dict() == lengths and got.groupby("sequence_id").length.sum().max() <= 4096
        else:
            assert result.columns == docs.columns
            assert sorted((r.doc_id, r.text) for r in result.collect()) == sorted(expected), name
        docs = result if expected is not None else docs


@pytest.mark.parametrize("drop", [False, True])
def test_the_entry_stands_without_the_operators(tmp_path, drop):
    import subprocess

    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(top, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    if drop:
        for path in ("tickloom/llm", "tests/llm"):
            shutil.rmtree(tmp_path / "repo" / path)
        os.remove(tmp_path / "repo" / "corpus_pipeline.py")
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    n, pipeline, sql = said.stdout.split()
    assert int(n) >= 40 and pipeline == str(not drop) and sql == "True"
