"""Brute-force versions of the text operators on awkward rows."""
import hashlib
import re
import textwrap
import time
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.llm import decontaminate, exact_dedup, license_scan, substring_dedup

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def _key(rows):
    return sorted(rows, key=str)


def test_removed_words(make_docs, awkward):
    window = 50
    starts = defaultdict(set)
    for doc, text in awkward:
        words = SPACE.findall(text or "")
        for i in range(len(words) - window + 1):
            if doc is not None:
                starts[tuple(words[i:i + window])].add(doc)
    want = []
    for doc, text in awkward:
        words = SPACE.findall(text or "")
        gone = {j for i in range(len(words) - window + 1) if doc is not None and min(starts[tuple(words[i:i + window])]) < doc for j in range(i, i + window)}
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    for chunk in (1_000_000, 100):
        got = substring_dedup.remove_repeats(make_docs(awkward).repartition(3), chunk_words=chunk).collect()
        assert _key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == _key(want)
        assert any(r.n_removed for r in got)
        for r in got:
            assert sum(i.end - i.begin for i in r.removed) == r.n_removed
            assert all(a.end < b.begin for a, b in zip(r.removed, r.removed[1:]))
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_removal_by_periodic_text_and_short_window(make_docs):
    rows = [(3, "a b " * 40), (1, "a b a b c"), (2, "b a b"), (4, "z " * 10)]
    starts = defaultdict(set)
    for doc, text in rows:
        w = text.split()
        for i in range(len(w) - 2):
            starts[tuple(w[i:i + 3])].add(doc)
    want = {}
    for doc, text in rows:
        w = text.split()
        want[doc] = len({j for i in range(len(w) - 2) if min(starts[tuple(w[i:i + 3])]) < doc for j in range(i, i + 3)})
    got = substring_dedup.remove_repeats(make_docs(rows), window=3).collect()
    assert {r.doc_id: r.n_removed for r in got} == want


def test_removal_of_nothing(make_docs):
    assert substring_dedup.remove_repeats(make_docs([])).collect() == []


def test_equal_texts(make_docs, awkward):
    groups = defaultdict(list)
    for doc, text in awkward:
        groups[text or ""].append(doc)
    want = []
    for doc, text in awkward:
        same = [d for d in groups[text or ""] if d is not None]
        want.append((doc, max(same, default=None), len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    got = exact_dedup.exact_groups(make_docs(awkward).repartition(3), block_bytes=16).collect()
    assert _key((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == _key(want)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_weak_block_keys_are_found_out(make_docs):
    from pyspark.sql import functions as F

    def weak(block, salt):
        """All blocks share a key at the first salt."""
        k = F.lit(0).cast("long") if salt == 0 else F.xxhash64(F.lit(salt), block)
        return F.struct(k.alias("k1"), F.lit(0).cast("long").alias("k2"))

    got = exact_dedup.exact_groups(make_docs([(1, "ab"), (2, "cd"), (3, "ab")]), key=weak).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


def test_equal_texts_of_nothing(make_docs):
    assert exact_dedup.exact_groups(make_docs([])).collect() == []


ITEMS = [(10, "Shared0 SHARED1, shared2 shared3 shared4 shared5 shared6 shared7 shared8 shared9 shared10 shared11"), (2, "one two"), (3, "one, TWO!"),
         (None, "three"), (4, None), (5, "..."), (2, "one two"), (7, "longword1 w2 longword2 w3 longword3 w4 longword4 w5 longword5 w6")]


def _brute_hits(text, items, n=10):
    words, hit, ids = ALNUM.findall(_lower(text)), set(), set()
    for item, raw in items:
        w = ALNUM.findall(_lower(raw))
        size = min(n, len(w))
        for i in range(max(0, len(w) - size + 1) if w else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == w[i:i + size]:
                    hit.update(range(j, j + size))
                    ids.add(item)
    named = sorted((i for i in ids if i is not None), key=str)
    return len(words), len(hit), named, hashlib.sha256(",".join(map(str, named)).encode()).hexdigest()


def test_benchmark_hits(spark, make_docs, awkward):
    items = spark.createDataFrame([("e", t, i) for i, t in ITEMS], "extra string, text string, item_id long")
    want = _key((d, *_brute_hits(t, ITEMS)) for d, t in awkward if t is None or len(t) < 50_000)
    for block_chars in (4_000_000, 60):  # one automaton, and many
        got = decontaminate.benchmark_hits(make_docs(awkward), items, block_chars=block_chars).collect()
        assert len(got) == len(awkward)
        assert _key((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.items_sha256) for r in got if r.n_words < 20_000) == want
        assert next(r for r in got if r.n_words > 20_000).item_ids == [7]
        clean = decontaminate.uncontaminated(make_docs(awkward), items, block_chars=block_chars)
        assert clean.columns == make_docs([]).columns
        assert clean.count() == sum(r.n_hit == 0 for r in got)


def test_spans_point_into_the_original(spark, make_docs):
    items = spark.createDataFrame([(1, "über den fluss")], "item_id long, text string")
    text = "Ärger — ÜBER? nein: über DEN\n(Fluss), über den Fluss hinaus"
    row = decontaminate.benchmark_hits(make_docs([(1, text)]), items).first()
    assert [text[s.start:s.end] for s in row.spans] == ["über DEN\n(Fluss), über den Fluss"] and row.n_hit == 6


def test_no_benchmark_and_no_documents(spark, make_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.benchmark_hits(make_docs([(1, "a b")]), empty).first().n_hit == 0
    assert decontaminate.benchmark_hits(make_docs([]), empty).collect() == []
    assert decontaminate.uncontaminated(make_docs([]), empty).collect() == []


LICENSED = [(20, "The MIT License, mit license\nApache\nLicense"), (21, "mit\nlicensed General Public License general public LICENSE"),
            (22, " ".join(f"filler{i}" for i in range(300)) + " Licensed under CC BY-NC 4.0. " + " ".join(f"more{i}" for i in range(200))),
            (23, "you may not use this file except in compliance with the License; obtain a copy of the License"), (24, "license"), (25, "Licensed under CC")]


def _brute_blocks(text):
    out = []
    for line in _lower(text).split("\n"):
        words = ALNUM.findall(line)
        runs = [words] if len(words) <= 128 else [words[i:i + 128] for i in range(0, len(words) - 64, 64)]
        for run in runs:
            for label, template in license_scan.TEMPLATES:
                wanted = set(ALNUM.findall(_lower(template)))
                share = len(wanted & set(run)) / len(wanted)
                if len(wanted & set(run)) >= 0.8 * len(wanted) - 1e-9:
                    out.append((label, share))
    return sorted(out)


def _brute_phrases(text):
    words = ALNUM.findall(_lower(text))
    return sorted((i, label) for p, label in license_scan.PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split())


def test_license_blocks(make_docs, awkward):
    rows = awkward + LICENSED
    got = license_scan.scan(make_docs(rows)).collect()
    want = _key((d, len(ALNUM.findall(_lower(t))), _brute_phrases(t), _brute_blocks(t)) for d, t in rows)
    assert _key((r.doc_id, r.n_words, sorted((b.first_word, b.label) for b in r.base), sorted((b.label, b.containment) for b in r.blocks)) for r in got) == want
    assert sum(len(r.blocks) for r in got) >= 3


def _brute_windows(text, templates):
    """Every 2 n words from each n-th word on, as long as the window before did not reach the end."""
    words, out = ALNUM.findall(_lower(text)), []
    for label, template in templates:
        needed = ALNUM.findall(_lower(template))
        for at in range(0, max(1, len(words) - len(needed)), len(needed)):
            shared = len(set(needed) & set(words[at:at + 2 * len(needed)]))
            if shared >= (0.8 if len(set(needed)) >= 15 else 1) * len(set(needed)) - 1e-9 and shared:
                out.append((at, min(2 * len(needed), len(words) - at), label, shared / len(set(needed))))
    return sorted(out)


def test_license_text_over_lines(make_docs, awkward):
    """A header wrapped at 75 columns, far into a document, and a template longer than any run of a line."""
    header = dict(license_scan.TEMPLATES)["apache-2.0-text"]
    long = " ".join(f"clause{i}" for i in range(300))
    templates = [*(t for t in license_scan.TEMPLATES if len(set(ALNUM.findall(_lower(t[1])))) >= 10), ("long", long)]
    before = " ".join(f"filler{i}" for i in range(333))
    rows = awkward + LICENSED + [(30, before + "\n" + textwrap.fill(header, 75) + "\n" + before), (31, textwrap.fill(before + " " + long, 75)), (32, long)]
    rows += [(40 + i, textwrap.fill(text, 40)) for i, (_, text) in enumerate(templates)]
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan(make_docs(rows), templates=templates).collect()}
    for d, text in rows:
        r = got[d, len(ALNUM.findall(_lower(text)))]
        assert sorted(map(tuple, r.windows)) == _brute_windows(text, templates)
    labels = {d: {w.label for w in r.windows} for (d, _), r in got.items()}
    assert "apache-2.0-text" in labels[30] and "long" in labels[31] & labels[32]
    assert all(label in labels[40 + i] for i, (label, _) in enumerate(templates))


def test_short_notices_need_their_naming_words(make_docs):
    others = ["Released under the Apache License, Version 2.0.", "Released under the GPL license", "Licensed under CC BY 4.0.",
              "This work is licensed under the GNU General Public License, version 2.", "released under the old license of the house"]
    notices = [(label, text) for label, text in license_scan.TEMPLATES if label.endswith("-notice")]
    got = {r.doc_id: r for r in license_scan.scan(make_docs(list(enumerate(others + [text for _, text in notices])))).collect()}
    for i in range(len(others)):
        assert not got[i].blocks and not got[i].windows
    for i, (label, _) in enumerate(notices, len(others)):
        assert [(b.label, b.containment) for b in got[i].blocks] == [(w.label, w.containment) for w in got[i].windows] == [(label, 1.0)]


def test_license_scan_of_nothing(make_docs):
    assert license_scan.scan(make_docs([])).collect() == []
    assert license_scan.scan(make_docs([(1, "mit license")]), templates=[("empty", "...")]).first().blocks == []


def test_texts_need_their_naming_words(make_docs):
    rows = [(1, "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0."),
            (2, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
            (3, "This program is free software: you can redistribute it and/or modify it under the terms of the ACME "
                "License as published by the Free Software Foundation")]
    got = {r.doc_id: ({b.label for b in r.blocks}, {w.label for w in r.windows}) for r in license_scan.scan(make_docs(rows)).collect()}
    assert got == {1: (set(), set()), 2: ({"mpl-2.0-text"}, {"mpl-2.0-text"}), 3: (set(), set())}
    other = license_scan.scan(make_docs(rows), naming={}, thresholds={"mpl-2.0-text": 0.9}).collect()
    assert {r.doc_id for r in other if "mpl-2.0-text" in {b.label for b in r.blocks}} == {1, 2}


def test_a_million_words_with_many_hits_take_seconds(make_docs):
    text = " ".join("mit license" if i % 5 == 0 else f"w{i % 997} license" for i in range(500_000))
    begun = time.time()
    row = license_scan.scan(make_docs([(1, text)])).first()
    assert row.n_words == 1_000_000 and len(row.base) == 100_000 and time.time() - begun < 60


def test_license_sql_tells_lines_windows_and_names_apart(make_docs):
    """Rows on which lines alone, or one threshold for all templates, would give other labels."""
    header = textwrap.fill(dict(license_scan.TEMPLATES)["apache-2.0-text"], 40)
    rows = [(1, header), (2, "x " * 400 + "\n" + textwrap.fill(dict(license_scan.TEMPLATES)["gpl-text"], 30) + "\n" + "y " * 500),
            (3, "Released under the GPL license"), (4, "Licensed under CC BY 4.0."), (5, None), (6, ""),
            (7, "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0.")] + LICENSED
    got = make_docs(rows)
    import duckdb
    import pandas as pd
    from tessera.llm import oracle, queries
    documents = pd.DataFrame({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    con = duckdb.connect()
    con.register("documents", documents)
    want = {r[0]: r[1:] for r in con.sql("SELECT doc_id, n_base, base_labels, labels, round(score, 9) FROM (" + oracle.SQL["op5_license_scan"] + ")").fetchall()}
    real, queries.table = queries.table, lambda *_: got
    try:
        mine = {r.doc_id: (r.n_base, r.base_labels, r.labels, round(r.score, 9)) for r in queries.op5_license_scan(got.sparkSession, "").collect()}
    finally:
        queries.table = real
    assert mine == want
    assert mine[1][2] == "apache-2.0-text" and mine[2][2] == "gpl,gpl-text" and mine[3][2] == mine[4][2] == mine[7][2] == ""


def _removed(docs, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, **kw).collect()), key=str)


def test_a_hot_passage_gives_its_range_one_entry_a_chunk(spark, make_docs):
    """Positions already known to repeat go to the documents' groups, so no range's input grows with the holders."""
    passage = " ".join(f"hot{i}" for i in range(50))
    for holders in (300, 1200):
        rows = [(i, f"own{i} " * 3 + (passage if i % 3 == 0 else " ".join(f"w{i}x{j}" for j in range(60)))) for i in range(3 * holders)]
        docs = make_docs(rows).select("doc_id", "text", F.lit(0).cast("long").alias("tag")).repartition(1)
        entries = docs.mapInArrow(substring_dedup._map_chunks(50, 64, 64, 10**9), substring_dedup._ENTRIES).toPandas()
        ranges = entries[entries.bucket < substring_dedup._DIRECT]
        assert ranges.groupby("bucket").size().max() == 1
        windows = [len(substring_dedup._unplanes(r["at"], "<u4")) for _, r in ranges.iterrows()]
        distinct = len({w for _, t in rows for w in zip(*[t.split()[k:] for k in range(50)])})
        assert sum(windows) == distinct                     # each distinct window of the chunk once
        direct = entries[entries.bucket >= substring_dedup._DIRECT]
        assert len(direct) > 40 and direct["at"].map(len).max() < 200  # spread over the groups of documents
    got = _removed(make_docs(rows))
    assert sum(r[2] for r in got) == 50 * (holders - 1)


def test_two_levels_of_ranges_remove_the_same(make_docs, awkward, monkeypatch):
    shared = " ".join(f"p{i}" for i in range(70))
    rows = awkward + [(100 + i, f"a{i} " * (i % 7) + shared + f" z{i}" * (i % 5) + " " + " ".join(f"q{i % 4}r{j}" for j in range(80))) for i in range(40)]
    docs = make_docs(rows).repartition(5)
    one = _removed(docs, chunk_words=400)
    monkeypatch.setattr(substring_dedup, "FAN", 3)
    assert _removed(docs, chunk_words=400) == one == _removed(docs, chunk_words=10**7)
