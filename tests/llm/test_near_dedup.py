import random
import re

import numpy as np

from tessera.llm import near_dedup
from tessera.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def _brute(rows, percent=75):
    """Components of ids, over all pairs of rows; rows with the same id are one document."""
    parent = {d: d for d, _ in rows if d is not None}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    sets = [(d, _set(t)) for d, t in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    out = []
    for d, s in sets:
        c = d if d is None or not s else find(d)
        out.append((d, len(s), c, d == c))
    return sorted(out, key=str)


def _got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()), key=str)


def test_awkward_rows(make_docs, awkward):
    assert _got(near_dedup.near_duplicates(make_docs(awkward).repartition(3))) == _brute(awkward)


def test_nothing(make_docs):
    assert near_dedup.near_duplicates(make_docs([])).collect() == []
    assert _got(near_dedup.near_duplicates(make_docs([(1, ""), (None, "a b c d e f")]))) == [(1, 0, 1, True), (None, 2, None, True)]


def test_groups_of_near_copies(make_docs, monkeypatch):
    """Copies of copies, large groups of near copies around no centre, and boilerplate; small blocks and both verification joins."""
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    rows = []
    base = [word() for _ in range(140)]
    for k in range(90):  # each changes some words of the base: pairs lie around the threshold
        text = list(base)
        for at in rng.sample(range(140), rng.choice((1, 2, 4))):
            text[at] = word()
        rows.append((1000 - k, " ".join(text)))
    text = [word() for _ in range(120)]
    for k in range(30):  # a chain: each is near the one before only
        rows.append((2000 + (k * 7) % 30, " ".join(text)))
        text[(k * 4) % 120] = word()
    passage = " ".join(word() for _ in range(60))
    rows += [(3000 + k, passage + " " + " ".join(word() for _ in range(60))) for k in range(40)]
    rows += [(4000 + k, rows[5][1].upper()) for k in range(20)]
    want = _brute(rows)
    assert len({c for _, _, c, _ in want}) > 40
    monkeypatch.setattr(near_dedup, "_BLOCK", 8)
    assert _got(near_dedup.near_duplicates(make_docs(rows).repartition(4))) == want
    monkeypatch.setattr(near_dedup, "SMALL_PAIRS", 0)
    assert _got(near_dedup.near_duplicates(make_docs(rows).repartition(2))) == want


def test_sequential_test_keeps_similar_pairs():
    needed = near_dedup.least_matches(0.75)
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 32, (4000, near_dedup.HASHES), np.uint32)
    for similarity, least, most in ((0.75, 3990, 4000), (0.9, 4000, 4000), (0.3, 0, 5)):
        b = np.where(rng.random(a.shape) < similarity, a, a + 1)
        alive, matches = near_dedup.bayes_filter(a, b, needed)
        assert least <= len(alive) <= most
        assert (matches == (a[alive] == b[alive]).sum(1)).all()


def test_signatures_estimate_similarity():
    from tessera.llm.substring_dedup import WordHashes

    cache = WordHashes()
    words = [f"w{i}" for i in range(1200)]
    sets = [near_dedup.shingles(" ".join(words[i:i + 1000]).encode(), cache) for i in (0, 100)]
    sig = near_dedup.signatures(sets)
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.12


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (10, 9), (9, 11), (7, 7)] + [(100 + i, 101 + i) for i in range(40)] + [(500, 501 + i) for i in range(50)]
    got = {r.v: r.c for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[v] for v in (2, 3, 4, 5)} == {2} and {got[v] for v in (9, 10, 11)} == {9}
    assert {got[100 + i] for i in range(41)} == {100} and {got[500 + i] for i in range(51)} == {500}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
