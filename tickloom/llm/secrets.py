"""Secrets in texts: assignments, access keys, long hex runs, and random strings by a token-efficiency test.

The last looks at runs of 20 or more characters of the base64 alphabets. A vocabulary learned from text needs few tokens for
words and many for random strings, so a low number of characters per token under a tiktoken vocabulary marks a secret. Known
digests (hex of a usual length, integrity values) and identifiers (UUIDs, numbers, runs of one letter case) are left out
first. What base spans leave of a run is tested, so nothing is named twice; and as "/" is a base64 character and joins paths,
too, a run that does not pass as a whole is tested again between its slashes. Every text is scanned whole, a batch at a time; nothing is
shuffled.

Defined results: a null or empty text has no spans; repeated rows are scanned once a row; a null id is carried; an empty
table gives no rows; other columns are not read. Spans count code points, their end exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SEGMENT = re.compile(r"[^/]{20,}")
LEAST_RUN = 20
KINDS = ("assign", "access", "hex", "token")
#: Characters per token at or below which a run counts as random.
MAX_CHARS_PER_TOKEN = 2.1
#: Usual lengths of digests in hexadecimal digits.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_INTEGRITY = re.compile(r"sha(1|256|384|512)-[A-Za-z0-9+/]+=*")
_HEX_ANY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, secrets array<struct<kind string, start int, end int, value string>>"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind as listed, end) of the three fixed kinds. An assignment whose value is too short is dropped, yet used up."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def is_named(run: str) -> bool:
    """Whether a run is a digest or a UUID."""
    return bool(_UUID.fullmatch(run) or _INTEGRITY.fullmatch(run) or _HEX_ANY.fullmatch(run) and len(run) in DIGEST_LENGTHS)


def is_known(run: str) -> bool:
    """Whether a run is a digest or an identifier, and so no secret by its looks alone."""
    classes = any(c.islower() for c in run) + any(c.isupper() for c in run) + any(c.isdigit() for c in run)
    return classes < 2 or len(set(run)) < 8 or is_named(run)


def token_spans(text: str, base: list[tuple[int, int, str]], inefficient: Callable[[str], bool]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the random strings: in each run, what base spans leave of it as a whole, or else between slashes."""
    taken: list[list[int]] = []  # base spans, those that touch as one
    for s, _, e in base:
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    spans, before = [], 0
    for m in RUN.finditer(text):
        while before < len(taken) and taken[before][1] <= m.start():
            before += 1
        if is_named(m[0]):
            continue
        start, pieces, at = m.start(), [], before
        while at < len(taken) and taken[at][0] < m.end():
            pieces.append((start, taken[at][0]))
            start, at = taken[at][1], at + 1
        for a, z in (*pieces, (start, m.end())):
            if z - a < LEAST_RUN:
                continue
            piece = text[a:z]
            if is_named(piece):
                continue
            if not is_known(piece) and inefficient(piece):
                spans.append((a, 3, z))
            elif "/" in piece:
                spans += [(a + p.start(), 3, a + p.end()) for p in SEGMENT.finditer(piece) if not is_known(p[0]) and inefficient(p[0])]
    return spans


def find_secrets(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row a document: counts, digest of the base spans, all spans, and the secrets with their values."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(vocabulary_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encoding = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        def inefficient(run: str) -> bool:
            return len(run) / len(encoding.encode_ordinary(run)) <= max_chars_per_token

        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base = base_spans(text)
                spans = sorted(base + token_spans(text, base, inefficient))
                said = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((doc_id, *counts, hashlib.sha256(said(base).encode()).hexdigest(), said(spans), [{"kind": KINDS[k], "start": s, "end": e, "value": text[s:e]} for s, k, e in spans]))
            secret = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), secret)
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "secrets"])

    return texts(docs, id_col, text_col).mapInArrow(task, RESULT)
