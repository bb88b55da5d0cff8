"""op11: the source audit against a plain count, and its edge cases."""

import random
from collections import Counter, defaultdict

from tickloom.llm.divergence import audit_sources

SCHEMA = "doc_id long, text string, lang string, source string, shard int, term string, n long, part string, value long, rank int"


def plain(rows, least, top):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        text, group = text or "", (lang or "", source or "")
        groups.add(group)
        lowered = "".join(c.lower() if c.isascii() else c for c in text)
        terms = "".join(c if not c.isascii() or c.isalpha() else " " for c in lowered).split(" ")
        terms = [t for t in terms if t]
        count[group].update(terms)
        docs[group[0]].update(set(terms))
    out = set()
    for lang in {lang for lang, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        own = {s: shares(count[lang, s]) for s in sources}
        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(whole[t] - own[s][t], t.encode(), t) for t in kept if count[lang, s][t] and own[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out |= {(lang, s, part, name, -v, i) for i, (v, _, name) in enumerate(sorted(found)[:most], 1)}
    return out


def test_audit_equals_a_plain_count(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß漢Z") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rows = [(i, rng.choice(" .,_\n5").join(rng.choices(vocabulary, k=rng.randint(0, 40))), rng.choice(["en", "de", None, ""]), "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", None])) for i in range(300)]
    rows += [(None, None, "fr", "only"), (7, "", "fr", None), (8, "rare words", "fr", "only"), (8, "rare words", "fr", "only"), (9, "q" * 200_000 + " " + "long " * 5000, "en", "a")]
    docs = spark.createDataFrame([(*r, 1, "t", 2, "p", 3, 4) for r in rows], SCHEMA)
    for least, top, shards in ((30, 50, None), (3, 4, 7), (1, 1000, 1)):
        got = {tuple(r) for r in audit_sources(docs, least, top, shards).collect()}
        assert got == plain(rows, least, top)


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audit_sources(empty).columns == ["lang", "source", "part", "item", "value", "rank"] and audit_sources(empty).isEmpty()
    one = spark.createDataFrame([(1, "a", "en", "x", 1, "t", 2, "p", 3, 4)], SCHEMA)
    assert audit_sources(one).isEmpty()  # no other source and no kept term
