"""op13: circulant MinHash against brute force, its coordinates, and groups just at the bound."""

import random

import numpy as np
import pytest

from tickloom.llm import minhash, ngram_join
from tickloom.llm.ngram_join import Sets

SCHEMA = "doc_id long, text string, node long, kept boolean, list string"


def brute(rows, n, percent):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 5, False, "l") for i, t in rows], SCHEMA)


def changed(base, times, rng):
    out = list(base)
    for i in rng.sample(range(len(out)), times):
        out[i] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    base = [[f"v{rng.randrange(300)}" for _ in range(rng.choice([2, 5, 30, 120]))] for _ in range(25)]
    rows = [(i, changed(b, rng.randint(0, max(1, len(b) // 12)), rng)) for i in range(200) for b in [rng.choice(base)]]
    rows += [(None, "no id here"), (None, "no id here"), (500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "é É"), (506, " ".join(map(str, range(30_000)))), (507, " ".join(map(str, range(29_000)))), (3, rows[3][1])]
    for n, percent in ((2, 80), (5, 80), (3, 90)):
        got = minhash.near_duplicates(table(spark, rows), n, percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, n, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(table(spark, [])).isEmpty()


def test_bands_leave_next_to_no_chance():
    for percent in (50, 80, 90, 100):
        number, rows = minhash.bands(percent)
        assert (1 - (percent / 100) ** rows) ** number <= minhash.MISS * 1.001 and number * rows <= minhash.COORDINATES


def test_coordinates_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    both, own = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, (2, 200)).astype(np.uint64)
    sets = [np.concatenate((both, o)) for o in own]
    got = minhash.coordinates(np.concatenate(sets), np.array([0, 800]), 4096)
    assert abs((got[0] == got[1]).mean() - 0.6) < 0.03
    places = np.arange(1 << 20, dtype=np.uint32)
    assert len(np.unique(minhash._permute(places.copy(), minhash._RANK, np.empty_like(places)))) == 1 << 20
    whole = minhash.coordinates(sets[0], np.array([0]), 64)  # a coordinate is the least rank of the shifted places
    scattered = minhash._permute((sets[0] >> np.uint64(32)).astype(np.uint32), minhash._SCATTER, np.empty(800, np.uint32))
    for k in (0, 1, 63):
        assert whole[0, k] == minhash._permute(scattered + np.uint32(k), minhash._RANK, np.empty(800, np.uint32)).min()


@pytest.mark.parametrize("signer", [Sets.signatures, minhash.band_signatures])
def test_groups_just_at_the_bound(spark, signer, monkeypatch):
    """Sets that mostly just miss each other: few rounds, rows in proportion, exact groups; also in small pieces."""
    rng = random.Random(7)
    base = [f"v{rng.randrange(10**5)}" for _ in range(300)]
    rows = [(i, changed(base, 7, rng)) for i in range(150)]
    expected = brute(rows, 3, 80)
    for piece in (ngram_join.PIECE, 16):
        monkeypatch.setattr(ngram_join, "PIECE", piece)
        got = ngram_join.join_groups(table(spark, rows), 3, 80, signer=signer).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == expected
    assert 1 < len({c for _, _, c in expected}) < 150
