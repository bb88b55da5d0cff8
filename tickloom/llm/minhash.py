"""Near-duplicate documents by circulant MinHash: signatures of two permutations, bands, and exact Jaccard similarities.

A set's n-grams are places in a circle of 2^32. One permutation scatters them; a second gives them ranks, and shifting it round
the circle by one place more for each coordinate gives all coordinates: coordinate k is the least rank of the scattered places
plus k. Two sets agree in a coordinate with a probability that is their Jaccard similarity. Consecutive coordinates are cut
into bands; sets that agree in a whole band are candidates. Rows and bands follow from the bound: as many rows as let
COORDINATES suffice for a chance of at most MISS that a pair just at the bound shares no band.

Candidates go the way of `ngram_join`: lists of the sets that share a band, stars, nearest members and blocks of sets, in which
every pair that could join two components is compared by its full sets. The only chance is in the bands.

Defined results: as in `ngram_join`; in addition `kept` is true where a document has its component's id, and where both are
null.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed
from .ngram_join import Sets, join_groups

#: Coordinates at most, and the chance at most that a pair just at the bound is no candidate.
COORDINATES, MISS = 512, 1e-9
#: N-grams whose coordinates are taken at a time.
AT_ONCE = 1 << 15
#: Odd factors of the two permutations.
_SCATTER, _RANK = (0x9E3779B1, 0x85EBCA77), (0xC2B2AE3D, 0x27D4EB2F)


def bands(percent: int) -> tuple[int, int]:
    """(bands, rows of a band) for a bound in percent."""
    best = (math.ceil(math.log(MISS) / math.log(1 - percent / 100)), 1) if percent < 100 else (1, 1)
    for rows in range(2, 64):
        share = (percent / 100) ** rows
        number = math.ceil(math.log(MISS) / math.log1p(-share)) if share < 1 else 1
        if number * rows > COORDINATES:
            break
        best = number, rows
    return best


def _permute(places: np.ndarray, factors: tuple[int, int], spare: np.ndarray) -> np.ndarray:
    """A permutation of 0 .. 2^32 - 1, in place."""
    for factor, shift in zip(factors, (15, 13), strict=True):
        np.right_shift(places, np.uint32(shift + 1), out=spare)
        np.bitwise_xor(places, spare, out=places)
        np.multiply(places, np.uint32(factor), out=places)
    np.right_shift(places, np.uint32(16), out=spare)
    return np.bitwise_xor(places, spare, out=places)


def coordinates(gram: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """n coordinates (columns) of each set; sets lie end to end in gram, from `start` on, none empty."""
    out = np.empty((len(start), n), np.uint32)
    ends = np.r_[start[1:], len(gram)]
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(ends, start[lo] + AT_ONCE, side="right")))
        places = (gram[start[lo] : ends[hi - 1]] >> np.uint64(32)).astype(np.uint32)
        spare, ranks = np.empty_like(places), np.empty_like(places)
        _permute(places, _SCATTER, spare)
        first = start[lo:hi] - start[lo]
        for k in range(n):
            np.add(places, np.uint32(k), out=ranks)
            out[lo:hi, k] = np.minimum.reduceat(_permute(ranks, _RANK, spare), first)
        lo = hi
    return out


def band_signatures(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and signature of every band of the sets that have n-grams."""
    number, rows = bands(percent)
    some = np.flatnonzero(sets.size)
    if not len(some):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    start = (np.cumsum(sets.size) - sets.size)[some]
    cells = coordinates(sets.gram, start, number * rows).reshape(len(some), number, rows).astype(np.uint64)
    signature = np.broadcast_to(mixed(np.arange(number, dtype=np.uint64) + np.uint64(1)), (len(some), number)).copy()
    for i in range(rows):
        signature = mixed(signature * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, i])
    return np.repeat(some, number), signature.ravel()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept. See the module's description."""
    groups = join_groups(docs, n, percent, id_col, text_col, signer=band_signatures)
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
